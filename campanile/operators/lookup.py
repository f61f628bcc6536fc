"""Lookups by campaign, time and metadata.

Joins carry no broadcast hint: Spark broadcasts the metadata side when its
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise
sorts and merges, splitting skewed partitions at run time.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from campanile.functions import pivot_count, safe_div
from campanile.operators.views import stats_records

# By time; the rest of the key splits a busy instant over several sort tasks.
SERIES_ORDER = ("window_start_time", "campaign_id", "event_type")


def _instant(value: datetime | str) -> Column:
    return F.lit(value).cast("timestamp")


def _check_range(start: datetime | str | None, end: datetime | str | None) -> None:
    if start is not None and end is not None and datetime.fromisoformat(str(start)) > datetime.fromisoformat(str(end)):
        raise ValueError("start of the time range is after its end")


def in_window(df: DataFrame, start=None, end=None, column: str = "window_start_time") -> DataFrame:
    """Half-open time range, open where a bound is None; compares the raw column, so it reaches the scan."""
    _check_range(start, end)
    if start is not None:
        df = df.filter(F.col(column) >= _instant(start))
    return df if end is None else df.filter(F.col(column) < _instant(end))


def newer_than(df: DataFrame, as_of, days: int, column: str = "window_start_time") -> DataFrame:
    """Rows of the last ``days`` days, boundary excluded."""
    return df.filter(F.col(column) > _instant(as_of) - F.make_dt_interval(F.lit(days)))


def stats_for_campaign(stats: DataFrame, campaign_id: str, start, end) -> DataFrame:
    """Series of one campaign, oldest window first."""
    found = in_window(stats, start, end).filter(F.col("campaign_id") == campaign_id)
    return stats_records(found).orderBy(*SERIES_ORDER)


def stats_in_range(stats: DataFrame, start, end) -> DataFrame:
    """Windows lying wholly inside the range, both ends included."""
    _check_range(start, end)
    return stats.filter(
        (F.col("window_start_time") >= _instant(start)) & (F.col("window_end_time") <= _instant(end))
    )


def stats_where(stats: DataFrame, **equals) -> DataFrame:
    """Rows whose columns equal the given values."""
    for column, value in equals.items():
        stats = stats.filter(F.col(column) == value)
    return stats


def active_campaigns(metadata: DataFrame, as_of: str | None = None) -> DataFrame:
    """Campaigns switched on and not ended on the day ``as_of`` (default today)."""
    day = F.lit(as_of).cast("date") if as_of else F.current_date()
    return metadata.filter(F.col("is_active") & (F.col("end_date").isNull() | (F.col("end_date") >= day)))


def advertiser_campaigns(metadata: DataFrame, advertiser_id: str | None = None, as_of: str | None = None) -> DataFrame:
    """Active campaigns, of one advertiser when given, by priority and name."""
    found = active_campaigns(metadata, as_of)
    if advertiser_id is not None:
        found = found.filter(F.col("advertiser_id") == advertiser_id)
    return found.select("advertiser_id", "campaign_id", "campaign_name", "priority").orderBy(
        "priority", "campaign_name"
    )


def stats_with_metadata(
    stats: DataFrame, metadata: DataFrame, start, end, campaign_id: str | None = None, as_of: str | None = None,
) -> DataFrame:
    """Statistics of active campaigns in a time range, oldest window first."""
    found = in_window(stats, start, end)
    if campaign_id is not None:
        found = found.filter(F.col("campaign_id") == campaign_id)
    active = active_campaigns(metadata, as_of).select("campaign_id")
    return stats_records(found.join(active, "campaign_id", "inner")).orderBy(*SERIES_ORDER)


def campaign_performance_summary(
    stats: DataFrame, metadata: DataFrame, start, end, campaign_id: str | None = None,
) -> DataFrame:
    """Metadata with totals of a time range, next to targets and budget.

    A campaign without statistics keeps one row of zeros; a campaign without
    metadata gives none.  Statistics are summed before the join, so each side
    has at most one row per campaign.
    """
    if campaign_id is not None:
        metadata = metadata.filter(F.col("campaign_id") == campaign_id)
        stats = stats.filter(F.col("campaign_id") == campaign_id)
    totals = in_window(stats, start, end).groupBy("campaign_id").agg(
        pivot_count("impression").alias("impressions"),
        pivot_count("click").alias("clicks"),
        pivot_count("conversion").alias("conversions"),
        F.sum("total_bid_amount").alias("spend"),
    )
    joined = metadata.join(totals, "campaign_id", "left")
    spend = F.coalesce(F.col("spend"), F.lit(0)).cast("decimal(38,6)")
    filled = joined.select(
        "campaign_id", "campaign_name", "advertiser_name", "industry_category",
        *[F.col(c).cast("double").alias(c) for c in ("budget_usd", "target_ctr", "target_cpa")],
        *[F.coalesce(c, F.lit(0)).alias(f"total_{c}") for c in ("impressions", "clicks", "conversions")],
        spend.cast("double").alias("total_spend"),
    )
    rated = filled.withColumns({
        "actual_ctr": safe_div("total_clicks", "total_impressions"),
        "actual_cpa": safe_div("total_spend", "total_conversions"),
        "conversion_rate": safe_div("total_conversions", "total_clicks"),
    })
    return rated.withColumns({
        "meets_target_ctr": F.col("actual_ctr") >= F.col("target_ctr"),
        "meets_target_cpa": (F.col("total_conversions") > 0) & (F.col("actual_cpa") <= F.col("target_cpa")),
        "budget_used": safe_div("total_spend", "budget_usd"),
    })
