"""Distinct counts that can be merged: any range of windows is counted from stored parts, without the rows.

Whole-number ids are kept as bitmaps, 4 KB for each 32,768 neighbouring ids that occur, which count exactly.  Sketches beside them
take some KB whatever the number of ids and count within a few percent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def distinct_parts(rows: DataFrame, keys: Sequence[str], user: str) -> DataFrame:
    """A bitmap of the ids per key and range of ids; rows without an id are left out."""
    known = rows.filter(F.col(user).isNotNull()).withColumn("_id", F.col(user).cast("bigint"))
    return known.groupBy(*keys, F.bitmap_bucket_number("_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("ids"))


def merged_distinct(parts: DataFrame, keys: Sequence[str], name: str = "distinct_users") -> DataFrame:
    """Exact number of distinct ids per key, over all windows among the parts."""
    whole = parts.groupBy(*keys, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("ids")).alias("n"))
    return whole.groupBy(*keys).agg(F.sum("n").alias(name))


def sketch_parts(rows: DataFrame, keys: Sequence[str], user: str, precision: int = 12) -> DataFrame:
    """A sketch of the ids per key."""
    return rows.filter(F.col(user).isNotNull()).groupBy(*keys).agg(
        F.hll_sketch_agg(F.col(user).cast("bigint"), precision).alias("sketch"))


def merged_estimate(parts: DataFrame, keys: Sequence[str], name: str = "distinct_users") -> DataFrame:
    """Estimated number of distinct ids per key, over all windows among the parts."""
    return parts.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))
