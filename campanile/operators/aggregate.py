"""Windowed and running aggregation of events.

All aggregates are sums and counts, so Spark combines them before the shuffle;
a campaign that holds a third of all events still sends one row per window and
map task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from campanile.functions import from_micros, pivot_count, ratio, sum_money

NO_DATA_SECONDS = 9999


def aggregate_events(
    events: DataFrame, window: str = "1 minute", watermark: str | None = None,
    dims: Sequence[str] = (), sales: bool = False, time_col: str = "event_timestamp",
) -> DataFrame:
    """Count and spend per tumbling window, campaign, event type and ``dims``.

    Works on batch and streaming frames; a stream needs a ``watermark``.  Rows
    without time, campaign or type cannot be keyed and are left out: quarantine
    them first if they must be reported.  ``dims`` become part of the key.
    """
    keyed = events.filter(reduce(and_, [F.col(c).isNotNull() for c in (time_col, "campaign_id", "event_type")]))
    if watermark:
        keyed = keyed.withWatermark(time_col, watermark)
    sums = {"total_bid_amount": "total_bid_amount"}
    if sales:
        sums["sales_amount_euro"] = "total_sales_amount_euro"
    totals = (
        keyed.groupBy(F.window(time_col, window).alias("w"), "campaign_id", "event_type", *dims)
        .agg(
            F.count("*").alias("event_count"),
            *[sum_money(c).alias(name) for c, name in sums.items()],
        )
    )
    return totals.select(
        "campaign_id",
        "event_type",
        F.col("w.start").alias("window_start_time"),
        F.col("w.end").alias("window_end_time"),
        *dims,
        "event_count",
        *[from_micros(F.col(name)).alias(name) for name in sums.values()],
    )


def running_totals(events: DataFrame) -> DataFrame:
    """Totals per campaign and type since the beginning; absent bids count as 0."""
    keyed = events.filter(F.col("campaign_id").isNotNull() & F.col("event_type").isNotNull())
    return keyed.groupBy("campaign_id", "event_type").agg(
        F.count("*").alias("event_count"),
        from_micros(sum_money("total_bid_amount")).alias("total_bid_amount"),
    )


def campaign_summary(stats: DataFrame, refreshed_at: Column | None = None) -> DataFrame:
    """Summary per campaign and type over all windows."""
    per_event = ratio("total_bid_amount", "event_count")
    summary = stats.groupBy("campaign_id", "event_type").agg(
        F.sum("event_count").alias("total_events"),
        F.sum("total_bid_amount").cast("decimal(38,6)").alias("total_bid_amount"),
        # Averaged as decimals, so the result does not depend on row order.
        ratio(F.sum(per_event.cast("decimal(28,12)")), F.count(per_event)).alias("avg_bid_per_event"),
        F.min("window_start_time").alias("first_event_time"),
        F.max("window_end_time").alias("last_event_time"),
        F.count("*").alias("total_windows"),
    )
    return summary.withColumn("last_refreshed", refreshed_at) if refreshed_at is not None else summary


def totals_by(stats: DataFrame, *keys: str) -> DataFrame:
    """Counts by type and spend per key; one zero row when there are no keys."""
    aggregates = [
        F.coalesce(pivot_count(kind), F.lit(0)).alias(name)
        for kind, name in (("impression", "impressions"), ("click", "clicks"), ("conversion", "conversions"))
    ] + [F.coalesce(F.sum("total_bid_amount"), F.lit(0)).cast("decimal(38,6)").alias("spend_usd")]
    return stats.groupBy(*keys).agg(*aggregates)


def totals_by_day(stats: DataFrame) -> DataFrame:
    return totals_by(stats.withColumn("day", F.to_date("window_start_time")), "day")


def data_freshness(stats: DataFrame, as_of: Column) -> DataFrame:
    """Latest window and its age in whole seconds; a constant when there is none."""
    return stats.agg(F.max("window_start_time").alias("latest_ts")).select(
        "latest_ts",
        F.coalesce(
            F.unix_seconds(as_of) - F.unix_seconds("latest_ts"), F.lit(NO_DATA_SECONDS)
        ).cast("bigint").alias("data_freshness_seconds"),
    )


def record_counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("record_count"))


def distinct_count(df: DataFrame, key: str, approximate: bool = False) -> DataFrame:
    """Number of distinct keys; ``approximate`` trades exactness for no key shuffle."""
    counter = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(counter(F.col(key)).alias("unique_records"))


def lowest_day(daily: DataFrame, value: str, *carry: str) -> DataFrame:
    """The day with the lowest value, the earliest on ties."""
    row = F.struct("day", value, *carry)
    lowest = daily.agg(F.min_by(row, F.struct(value, "day")).alias("r"))
    return lowest.filter("r is not null").select("r.*")

