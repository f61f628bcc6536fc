"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from campanile.session import scratch_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new Parquet folder below ``spark.checkpoint.dir`` and read it again.

    The table cuts the lineage: a lost executor costs a read, not the work before it, and
    the next join knows the real size.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
