"""Reports over campaign statistics.

Every report takes any frame with the statistics columns it names: the stored
table, a view of it, or statistics derived on the spot.  Groups are reduced
before the shuffle, top-k reports keep only k rows per task, and totals used by
every row come from a scalar subquery, not from a join or a single-task window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from campanile.functions import (
    in_percent, in_thousands, pivot_count, pivot_count_or_null, quadrant, ratio, rounded_ratio, safe_div,
)
from campanile.operators.lookup import newer_than

# Fixed value: assumed revenue of one conversion.
REVENUE_PER_CONVERSION = 50
UNKNOWN = "Unknown"

IMPRESSIONS, CLICKS, CONVERSIONS = "impressions", "clicks", "conversions"


def _counts() -> list[Column]:
    return [
        F.coalesce(pivot_count(kind), F.lit(0)).alias(name)
        for kind, name in (("impression", "impressions"), ("click", "clicks"), ("conversion", "conversions"))
    ]


def _total(column: str) -> Column:
    """Exact sum, 0 when nothing is there to sum."""
    return F.expr(f"coalesce(CAST(sum({column}) AS DECIMAL(38,6)), CAST(0 AS DECIMAL(38,6)))")


def _total_of(value: Column) -> Column:
    """The same of an expression."""
    return F.coalesce(F.sum(value).cast("decimal(38,6)"), F.lit(0).cast("decimal(38,6)"))


def _double(*columns: str) -> list[Column]:
    return [F.col(c).cast("double").alias(c) for c in columns]


def _top(df: DataFrame, by: str, key: str, k: int | None) -> DataFrame:
    """Sort by a value, NULL first as highest; ties by key, so a cut is stable."""
    ordered = df.orderBy(F.col(by).desc_nulls_first(), F.col(key).asc())
    return ordered if k is None else ordered.limit(k)


# --- platform -----------------------------------------------------------------------------------


def platform_kpis(stats: DataFrame, scale: float = 1) -> DataFrame:
    """One row of platform figures; ``scale=100`` gives the click rate in percent."""
    totals = stats.agg(
        *_counts(), _total("spend_usd").alias("spend_usd"), _total("total_sales_amount_euro").alias("revenue_euro")
    )
    return totals.select(
        "impressions", "clicks", "conversions", *_double("spend_usd", "revenue_euro"),
        safe_div(CLICKS, IMPRESSIONS, scale).alias("ctr"),
        safe_div("revenue_euro", "spend_usd").alias("roas"),
        safe_div("spend_usd", CONVERSIONS).alias("cpa"),
        safe_div(CONVERSIONS, CLICKS).alias("conversion_rate"),
    )


def dashboard_kpis(stats: DataFrame) -> DataFrame:
    """Counts, click rate in percent, spend, and spend as displayed in thousands."""
    return platform_kpis(stats, scale=100).select(
        "impressions", "clicks", "conversions", "ctr", "spend_usd",
        in_thousands(F.col("spend_usd")).alias("spend_thousands"),
    )


def basic_kpis(stats: DataFrame) -> DataFrame:
    """Counts and bids only."""
    return stats.agg(*_counts(), _total("total_bid_amount").cast("double").alias("spend_usd"))


def advertiser_metrics(stats: DataFrame) -> DataFrame:
    """Cost per acquisition, return on spend and conversion rate in percent."""
    kpis = platform_kpis(stats)
    return kpis.select("cpa", "roas", safe_div(CONVERSIONS, CLICKS, 100).alias("conversion_rate"))


# --- daily return -------------------------------------------------------------------------------


def _daily(stats: DataFrame) -> DataFrame:
    return stats.withColumn("day", F.to_date("window_start_time"))


def roi_trend(stats: DataFrame, as_of=None, days: int = 90, fallback_all: bool = False) -> DataFrame:
    """Return on spend by day, of all days or of the last ``days`` before ``as_of``.

    With ``fallback_all`` an empty range gives all days instead.
    """
    if as_of is None or not fallback_all:
        found = stats if as_of is None else newer_than(stats, as_of, days)
        daily = _daily(found).groupBy("day").agg(_total("total_sales_amount_euro").alias("revenue"), _total("spend_usd").alias("spend"))
        return daily.select("day", safe_div("revenue", "spend").alias("roi")).orderBy("day")
    # One pass over the statistics sums each day twice, with and without the rows before the limit.
    recent = F.col("window_start_time") > F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days))
    sums = {"revenue": F.col("total_sales_amount_euro"), "spend": F.col("spend_usd")}
    daily = _daily(stats).groupBy("day").agg(
        F.count_if(recent).alias("recent_rows"),
        *[_total_of(c).alias(n) for n, c in sums.items()],
        *[_total_of(F.when(recent, c)).alias(f"recent_{n}") for n, c in sums.items()],
    )
    # Days are few, some hundred a year, so one task may see them all; which of the sums count follows from them.
    any_recent = F.col("any_recent")
    spread = daily.withColumn("any_recent", F.max("recent_rows").over(Window.partitionBy(F.lit(0))) > 0)
    chosen = spread.filter(~any_recent | (F.col("recent_rows") > 0)).select(
        "day", *[F.when(any_recent, F.col(f"recent_{n}")).otherwise(F.col(n)).alias(n) for n in sums])
    return chosen.select("day", safe_div("revenue", "spend").alias("roi")).orderBy("day")


def roi_trend_rounded(stats: DataFrame) -> DataFrame:
    """Daily return as served: text day, four places."""
    return roi_trend(stats).select(
        F.col("day").cast("string").alias("window_start_time"),
        F.round(F.col("roi").cast("decimal(28,12)"), 4).cast("double").alias("roi"),
    )


def roi_trend_bid(stats: DataFrame) -> DataFrame:
    """Conversion bids over impression bids by day; NULL without impression bids."""
    def bids(kind: str) -> Column:
        return F.sum(F.when(F.col("event_type") == kind, F.col("total_bid_amount")).otherwise(F.lit(0)))

    return (
        _daily(stats).groupBy("day")
        .agg(ratio(bids("conversion"), bids("impression")).alias("roi"))
        .orderBy("day")
    )


# --- campaigns ----------------------------------------------------------------------------------


def campaign_performance(stats: DataFrame) -> DataFrame:
    """All campaigns, click rate in percent with two places.

    A campaign with impressions but no click row has a NULL rate.
    """
    clicks, impressions = pivot_count_or_null("click"), pivot_count_or_null("impression")
    rate = rounded_ratio(clicks * F.lit(100), impressions, 2)
    return stats.groupBy("campaign_id").agg(
        *_counts(),
        _total("total_bid_amount").cast("double").alias("spend_usd"),
        F.when(impressions > 0, rate).otherwise(F.lit(0.0)).alias("ctr"),
    )


def top_campaigns_by_spend(stats: DataFrame, top: int | None = 15) -> DataFrame:
    """Campaigns with the highest spend, click rate in percent; all, unsorted, without ``top``."""
    totals = stats.groupBy("campaign_id").agg(*_counts(), _total("spend_usd").alias("spend_usd"))
    chosen = totals if top is None else _top(totals, "spend_usd", "campaign_id", top)
    return chosen.select(
        "campaign_id", "impressions", "clicks", "conversions", *_double("spend_usd"),
        safe_div(CLICKS, IMPRESSIONS, 100).alias("ctr"),
    )


def top_stats_rows(stats: DataFrame, top: int = 10) -> DataFrame:
    """Stored rows with the highest spend."""
    return stats.orderBy(
        F.col("spend_usd").desc_nulls_first(), "campaign_id", "event_type", "window_start_time"
    ).limit(top)


def campaign_efficiency(stats: DataFrame, top: int = 20) -> DataFrame:
    """Spend, return, conversions and rates in percent of the biggest spenders."""
    totals = stats.groupBy("campaign_id").agg(
        *_counts(), _total("spend_usd").alias("spend"), _total("total_sales_amount_euro").alias("revenue")
    )
    roi = safe_div("revenue", "spend")
    return _top(totals.filter("spend > 0"), "spend", "campaign_id", top).select(
        "campaign_id", *_double("spend"), roi.alias("roi"), in_percent(roi).alias("roi_percent"), "conversions",
        safe_div(CLICKS, IMPRESSIONS, 100).alias("ctr"),
        safe_div(CONVERSIONS, CLICKS, 100).alias("conversion_rate"),
    )


def _assumed_return(revenue_per_conversion: float) -> Column:
    spend = F.col("spend_usd")
    quotient = ratio(F.col(CONVERSIONS) * F.lit(revenue_per_conversion), spend)
    return F.coalesce(quotient, F.lit(0.0))


def campaign_quadrants(performance: DataFrame, revenue_per_conversion: float = REVENUE_PER_CONVERSION) -> DataFrame:
    """Campaigns classed by spend and return against the means of both.

    Only campaigns with spend and return take part, in the means as well.
    """
    rated = performance.select(
        "campaign_id", F.col("spend_usd").alias("spend"), _assumed_return(revenue_per_conversion).alias("roi")
    ).filter("spend > 0 AND roi > 0")

    def mean(column: str) -> Column:
        exact = F.sum(F.col(column).cast("decimal(28,10)"))
        return rated.agg(ratio(exact, F.count("*")).alias("mean")).scalar()

    # The means become columns of their own, so each subquery appears once.
    compared = rated.withColumns({"mean_spend": mean("spend"), "mean_roi": mean("roi")})
    return compared.withColumn(
        "quadrant", quadrant(F.col("spend"), F.col("roi"), F.col("mean_spend"), F.col("mean_roi"))
    )


def campaign_roas(
    performance: DataFrame, revenue_per_conversion: float = REVENUE_PER_CONVERSION, top: int = 15,
) -> DataFrame:
    """Campaigns with the highest assumed return on spend."""
    rated = performance.select(
        "campaign_id", "conversions", "spend_usd", _assumed_return(revenue_per_conversion).alias("roas")
    )
    return _top(rated, "roas", "campaign_id", top)


def cpa_ctr_map(performance: DataFrame) -> DataFrame:
    """Cost per acquisition against click rate, where both are positive."""
    cpa = F.coalesce(ratio("spend_usd", CONVERSIONS), F.lit(0.0))
    return performance.select("campaign_id", cpa.alias("cpa"), "ctr", F.col("spend_usd").alias("spend")).filter(
        "cpa > 0 AND ctr > 0"
    )


def converting_campaigns(performance: DataFrame) -> DataFrame:
    return performance.filter(F.col(CONVERSIONS) > 0).select("campaign_id", "conversions")


# --- dimensions ---------------------------------------------------------------------------------


def _grouped(stats: DataFrame, dim: str, unknown: str | None) -> DataFrame:
    """Rows to group: without missing values, or with them under one label."""
    if unknown is None:
        return stats.filter(F.col(dim).isNotNull())
    return stats.withColumn(dim, F.coalesce(F.col(dim), F.lit(unknown)))


def revenue_by(stats: DataFrame, dim: str, top: int | None = None, unknown: str | None = None) -> DataFrame:
    """Revenue per value of a dimension, highest first."""
    totals = _grouped(stats, dim, unknown).groupBy(dim).agg(_total("total_sales_amount_euro").alias("total_revenue"))
    return _top(totals, "total_revenue", dim, top).select(dim, *_double("total_revenue"))


def performance_by_device(stats: DataFrame) -> DataFrame:
    """Revenue and conversion rate (fraction) by device, highest revenue first.

    The rate is NULL when there are clicks but no conversion row.
    """
    clicks, conversions = pivot_count_or_null("click"), pivot_count_or_null("conversion")
    totals = _grouped(stats, "device_type", None).groupBy("device_type").agg(
        _total("total_sales_amount_euro").alias("total_revenue"),
        F.when(clicks > 0, ratio(conversions, clicks)).otherwise(F.lit(0.0)).alias("conversion_rate"),
    )
    return _top(totals, "total_revenue", "device_type", None).select(
        "device_type", *_double("total_revenue"), "conversion_rate"
    )


def dashboard_by_device(stats: DataFrame) -> DataFrame:
    """Revenue and conversion rate (percent) by device, missing ones as Unknown."""
    totals = _grouped(stats, "device_type", UNKNOWN).groupBy("device_type").agg(
        *_counts(), _total("total_sales_amount_euro").alias("total_revenue")
    )
    return _top(totals, "total_revenue", "device_type", None).select(
        "device_type", *_double("total_revenue"), safe_div(CONVERSIONS, CLICKS, 100).alias("conversion_rate")
    )


def dashboard_by_age_group(stats: DataFrame) -> DataFrame:
    """Revenue and click rate (percent) by age group, in order of the group."""
    totals = _grouped(stats, "product_age_group", UNKNOWN).groupBy("product_age_group").agg(
        *_counts(), _total("total_sales_amount_euro").alias("total_revenue")
    )
    return totals.select(
        "product_age_group", *_double("total_revenue"), safe_div(CLICKS, IMPRESSIONS, 100).alias("ctr")
    ).orderBy("product_age_group")


def with_share(df: DataFrame, column: str) -> DataFrame:
    """Share of each row in the total of a column, 0 when the total is 0."""
    total = df.agg(F.sum(F.col(column).cast("decimal(38,6)")).cast("double").alias("total")).scalar()
    totalled = df.withColumn("_total", total)
    return totalled.withColumn("share", safe_div(F.col(column), F.col("_total"))).drop("_total")
