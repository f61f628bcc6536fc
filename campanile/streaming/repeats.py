"""Repeated keys across the batches of a stream.

The state is one counter per key, held by Spark's state store; counters are
combined before the shuffle, so a frequent key costs no more than a rare one.
An exact history grows with the number of distinct keys.  To bound it, give an
event-time column and a watermark: repeats further apart are then not found.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def key_counts(records: DataFrame, key: str = "record_key") -> DataFrame:
    """Running number of records per key."""
    return records.groupBy(key).agg(F.count("*").alias("record_count"))


def repeats_by_batch(versions: DataFrame, key: str = "record_key") -> DataFrame:
    """How often each key was repeated in each batch, from the stored versions.

    A key has at most one version per batch.  Its first record ever is not a
    repeat; all others are.
    """
    earlier = F.lag("record_count", 1, 1).over(Window.partitionBy(key).orderBy("batch_id"))
    counted = versions.withColumn("repeats", F.col("record_count") - earlier)
    return counted.filter("repeats > 0").select("batch_id", key, "repeats")


def first_within(records: DataFrame, key: str, time_col: str, watermark: str) -> DataFrame:
    """First record per key; state of a key is dropped after the watermark delay."""
    return records.withWatermark(time_col, watermark).dropDuplicatesWithinWatermark([key])
