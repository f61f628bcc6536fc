"""Health of the processing runs, and its relation to the return on spend."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from campanile.functions import ratio
from campanile.operators.aggregate import data_freshness, lowest_day
from campanile.operators.lookup import newer_than

LAST_POINTS = 6


def _mean(column: str) -> Column:
    """Mean of a decimal column, summed exactly."""
    return ratio(F.sum(column), F.count(column))


def _success_rate() -> Column:
    return ratio(F.count_if(F.col("status") == "success"), F.count("*")) * F.lit(100.0)


def run_health(runs: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Daily run figures of the last days; freshness in whole hours."""
    recent = newer_than(runs, as_of, days, "process_time")
    return recent.groupBy(F.to_date("process_time").alias("day")).agg(
        _mean("processing_time_sec").alias("avg_processing_time"),
        F.count("*").alias("job_count"),
        _success_rate().alias("success_rate"),
        F.expr("max(data_freshness_minutes) div 60").alias("data_freshness_hours"),
        _mean("quality_score").alias("quality_score"),
    ).orderBy("day")


def health_summary(stats: DataFrame, runs: DataFrame, as_of) -> DataFrame:
    """Data age in seconds, share of successful runs and mean quality, one row."""
    rates = runs.agg(_success_rate().alias("success_rate"), _mean("quality_score").alias("quality"))
    fresh = data_freshness(stats, F.lit(as_of).cast("timestamp"))
    return fresh.select("data_freshness_seconds").withColumns({
        "etl_success_rate": rates.select("success_rate").scalar(),
        "data_quality_score": rates.select("quality").scalar(),
    })


def last_points(daily: DataFrame, n: int = LAST_POINTS) -> DataFrame:
    return daily.orderBy(F.col("day").desc()).limit(n)


def health_vs_roi(health: DataFrame, roi: DataFrame, n: int = LAST_POINTS) -> DataFrame:
    """The last days of the health series with the return of the same dates."""
    return last_points(health, n).join(roi.select("day", "roi"), "day", "left").orderBy("day")


def root_cause_point(health: DataFrame, roi: DataFrame, n: int = LAST_POINTS) -> DataFrame:
    """The day with the lowest success rate among the last days, with its return."""
    return lowest_day(
        health_vs_roi(health, roi, n), "success_rate", "data_freshness_hours", "quality_score", "roi"
    )
