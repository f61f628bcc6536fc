"""First and repeated records per key.

A key may hold a large share of all rows, so rows are never gathered per key.
The earliest position of each key is an aggregate, combined before the shuffle;
rows are then matched on key *and* position, which spreads any key evenly.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegralType

KEY_SEPARATOR = ":"
#: Rows of a file that a compact position can tell apart, and files whose list is still small enough to join, some 10 MB.
FILE_ROWS, MAX_FILES = 1 << 40, 50_000


def file_position() -> Column:
    """Place of a row in a file scan: stable, unique, in arrival order."""
    return F.struct("_metadata.file_path", "_metadata.row_index")


def with_position(scan: DataFrame, name: str, max_files: int = MAX_FILES) -> DataFrame:
    """Add the place of each row of a Parquet scan, as one number: files in order of their names, rows as they lie.

    The least number of a key is found by a hash aggregation, where the least of a structure with a text would sort.  With more
    than ``max_files`` files, whose list would grow too large to send to every task, places are structures.
    """
    if len(scan.inputFiles()) > max_files:
        return scan.select("*", file_position().alias(name))
    # Names as rows have them, which may be spelled otherwise than in the list of files; this pass reads no column.
    paths = sorted(r[0] for r in scan.select("_metadata.file_path").distinct().collect())
    number = scan.sparkSession.createDataFrame(list(enumerate(paths)), "_file bigint, _path string")
    placed = scan.select("*", F.col("_metadata.file_path").alias("_of"), F.col("_metadata.row_index").alias("_row"))
    joined = placed.join(number, F.col("_of") == F.col("_path"))
    return joined.select(*scan.columns, (F.col("_file") * FILE_ROWS + F.col("_row")).alias(name))


def with_record_key(df: DataFrame, *fields: str) -> DataFrame:
    """Add ``record_key``, the trimmed fields joined by a colon.

    Rows with a missing or blank field have no key and are skipped.
    """
    trimmed = [F.trim(F.col(f).cast("string")) for f in fields]
    usable = df.filter(reduce(and_, [t != "" for t in trimmed]))
    return usable.withColumn("record_key", F.concat_ws(KEY_SEPARATOR, *trimmed))


def _whole(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


def first_positions(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(order).alias(order))


def flag_repeats(
    df: DataFrame, keys: Sequence[str], order: str, flag: str = "is_repeat", among: Column | None = None,
) -> DataFrame:
    """Mark every row that is not the first of its key.

    ``order`` must be unique within a key.  With ``among``, only rows meeting
    the condition compete; the others are never marked.  Nor are rows with a
    NULL in the key: as in a uniqueness constraint, NULL equals nothing.
    """
    competing = df if among is None else df.filter(among)
    firsts = first_positions(competing, keys, order).withColumn("_first", F.lit(True))
    repeat = F.col("_first").isNull() & _whole(keys)
    if among is not None:
        repeat = among & repeat
    return df.join(firsts, [*keys, order], "left").withColumn(flag, repeat).drop("_first")


def repeated_records(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Second and later rows of each key; rows with a NULL in the key have none."""
    return df.filter(_whole(keys)).join(first_positions(df, keys, order), [*keys, order], "left_anti")


def first_records(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """First row of each key, whole; ``order`` is unique within a key.

    Where ``order`` is a number, rows are matched with the first numbers: a hash aggregation and a join that is
    spread by the number.  Any other order is found with its row, which sorts.
    """
    others = [c for c in df.columns if c not in (*keys, order)]
    if not isinstance(df.schema[order].dataType, IntegralType):
        picked = df.groupBy(*keys).agg(F.min_by(F.struct(*others, order), F.col(order)).alias("_r"))
        return picked.select(*keys, "_r.*")
    firsts = first_positions(df, keys, order)
    firsts = firsts.select(*[F.col(c).alias(f"_first_{i}") for i, c in enumerate([*keys, order])])
    met = reduce(and_, [df[c].eqNullSafe(firsts[f"_first_{i}"]) for i, c in enumerate(keys)], df[order] == firsts[f"_first_{len(keys)}"])
    return df.join(firsts, met, "left_semi").select(*keys, *others, order)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys breaking a uniqueness constraint, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter("row_count > 1")
