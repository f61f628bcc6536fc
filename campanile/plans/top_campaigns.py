"""The best campaigns of each country in a time range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from campanile.functions import ctr_tier, performance_score, rounded_ratio
from campanile.operators.lookup import in_window

UNKNOWN_COUNTRY = "UNKNOWN"
MIN_IMPRESSIONS = 100
TOP_PER_COUNTRY = 3


def _rate(numerator: str, denominator: str, places: int) -> Column:
    """Quotient with a fixed number of places, 0 for a zero denominator."""
    return F.coalesce(rounded_ratio(F.col(numerator), F.col(denominator), places), F.lit(0.0))


def _percent(fraction: str) -> Column:
    return F.round((F.col(fraction) * F.lit(100.0)).cast("decimal(28,10)"), 4).cast("double")


def campaign_totals(hourly: DataFrame, start=None, end=None) -> DataFrame:
    """Sums per campaign and country; campaigns without impressions are left out.

    Rows with NULL or negative impressions do not count.
    """
    usable = in_window(hourly, start, end, "hour_timestamp").filter(
        F.col("campaign_id").isNotNull() & (F.col("impressions") >= 0)
    )
    country = F.coalesce("country_code", F.lit(UNKNOWN_COUNTRY)).alias("country_code")
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(f"total_{c}") for c in ("impressions", "clicks", "conversions")]
    return (
        usable.groupBy("campaign_id", country)
        .agg(
            *sums,
            F.coalesce(F.sum("spend_usd"), F.lit(0)).cast("decimal(38,6)").alias("total_spend_usd"),
            F.count("*").alias("hourly_records_count"),
        )
        .filter("total_impressions > 0")
    )


def top_campaigns(
    hourly: DataFrame, start=None, end=None, k: int = TOP_PER_COUNTRY, min_impressions: int = MIN_IMPRESSIONS,
    report_date: str | None = None, stamp: bool = False,
) -> DataFrame:
    """Campaigns ranked by click rate, conversion rate, spend and volume; of all time without ``start`` and ``end``.

    The campaign id breaks remaining ties.  The rank filter lets Spark keep only
    the first ``k`` rows per country in every task before they are shuffled, so
    a country with most of the campaigns does not load one task.
    """
    rated = campaign_totals(hourly, start, end).filter(F.col("total_impressions") >= min_impressions).withColumns({
        "ctr": _rate("total_clicks", "total_impressions", 6),
        "conversion_rate": _rate("total_conversions", "total_clicks", 6),
        "cost_per_conversion": _rate("total_spend_usd", "total_conversions", 2),
    })
    best_first = Window.partitionBy("country_code").orderBy(
        *[F.col(c).desc() for c in ("ctr", "conversion_rate", "total_spend_usd", "total_impressions")],
        F.col("campaign_id").asc(),
    )
    ranked = rated.withColumn("rank_in_country", F.row_number().over(best_first)).filter(
        F.col("rank_in_country") <= k
    )
    score = performance_score(
        F.col("ctr"), F.col("conversion_rate"), F.col("total_spend_usd"), F.col("total_conversions")
    )
    report = ranked.select(
        "country_code",
        "campaign_id",
        "rank_in_country",
        _percent("ctr").alias("ctr_percentage"),
        _percent("conversion_rate").alias("conversion_rate_percentage"),
        "cost_per_conversion",
        "total_impressions",
        "total_clicks",
        "total_conversions",
        F.round("total_spend_usd", 2).cast("double").alias("total_spend_usd"),
        score.alias("performance_score"),
        "hourly_records_count",
        ctr_tier(F.col("ctr")).alias("ctr_performance_tier"),
        F.lit(report_date or (None if start is None else str(start)[:10])).cast("string").alias("report_date"),
    )
    if stamp:
        report = report.withColumn("report_generated_at", F.current_timestamp())
    return report.orderBy("country_code", "rank_in_country")
