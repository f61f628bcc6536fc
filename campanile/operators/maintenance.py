"""Changes to stored tables, expressed as new tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from campanile.operators.dedupe import first_records

# Assumed cost per impression, and days statistics are kept.
COST_PER_IMPRESSION = "0.05"
RETENTION_DAYS = 90


def _stamp(updated_at: Column | None) -> Column:
    return F.current_timestamp() if updated_at is None else updated_at


def merge_additive(base: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add counts and spend of ``delta`` to ``base`` where keys meet.

    Only right for deltas that cover disjoint events, such as a back-fill.
    """
    both = base.unionByName(delta)
    return both.groupBy(*keys).agg(
        F.sum("event_count").alias("event_count"),
        F.sum("total_bid_amount").cast("decimal(18,6)").alias("total_bid_amount"),
        F.max("updated_at").alias("updated_at"),
    )


def insert_ignore(base: DataFrame, new: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Add rows whose key is not there yet; of equal new keys the first wins."""
    candidates = first_records(new, keys, order).select(*new.columns).drop(order)
    fresh = candidates.join(base.select(*keys), list(keys), "left_anti")
    return base.unionByName(fresh)


def backfill_impression_bids(
    stats: DataFrame, cost: str = COST_PER_IMPRESSION, updated_at: Column | None = None,
) -> DataFrame:
    """Give impressions without spend an assumed cost, and stamp changed rows."""
    hit = (F.col("event_type") == "impression") & (F.col("total_bid_amount") == 0)
    assumed = (F.col("event_count") * F.lit(cost).cast("decimal(9,6)")).cast("decimal(18,6)")
    changed = {"total_bid_amount": F.when(hit, assumed).otherwise(F.col("total_bid_amount"))}
    if "updated_at" in stats.columns:
        changed["updated_at"] = F.when(hit, _stamp(updated_at)).otherwise(F.col("updated_at"))
    return stats.withColumns(changed)


def retention_limit(as_of, days: int = RETENTION_DAYS) -> Column:
    return F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days))


def apply_retention(stats: DataFrame, as_of, days: int = RETENTION_DAYS) -> DataFrame:
    """Rows that stay; a row exactly at the limit stays."""
    return stats.filter(F.col("window_start_time") >= retention_limit(as_of, days))


def expired_rows(stats: DataFrame, as_of, days: int = RETENTION_DAYS) -> DataFrame:
    """Number of rows retention removes."""
    return stats.filter(F.col("window_start_time") < retention_limit(as_of, days)).agg(
        F.count("*").alias("deleted_rows")
    )
