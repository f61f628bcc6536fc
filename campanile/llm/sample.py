"""Bounded samples of labelled rows for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def crc(column: str = "doc_id") -> F.Column:
    """crc32 of the id as text, the number that deals documents to folds."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def bounded(labelled: DataFrame, bound: int, key: str = "doc_id") -> DataFrame:
    """All rows if they are at most ``bound``, else a share of about ``bound`` rows, chosen by a hash of ``key``."""
    total = labelled.count()
    if total <= bound:
        return labelled
    return labelled.filter(F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 30)) < int(bound / total * (1 << 30)))
