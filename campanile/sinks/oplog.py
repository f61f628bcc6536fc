"""Operational log and the stored summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from campanile import schemas
from campanile.operators.aggregate import campaign_summary

SUMMARY_NAME = "campaign_stats_summary"
# Event types that readers of the log know.
REFRESHED, REFRESH_FAILED, CLEANED = "materialized_view_refresh", "materialized_view_refresh_error", "data_cleanup"


def operational_event(spark: SparkSession, event_type: str, payload: dict) -> DataFrame:
    """One log row; the payload is stored as JSON."""
    fields = [F.lit(value).alias(name) for name, value in payload.items()]
    return spark.range(1).select(
        F.lit(event_type).alias("event_type"),
        F.to_json(F.struct(*fields)).alias("event_data"),
        F.current_timestamp().alias("created_at"),
    )


def log_event(spark: SparkSession, path: str, event_type: str, payload: dict) -> None:
    operational_event(spark, event_type, payload).write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The log with its payload as a queryable variant."""
    log = spark.read.schema(schemas.OPERATIONAL_EVENT).parquet(path)
    return log.withColumn("event_data", F.parse_json("event_data"))


def refresh_summary(spark: SparkSession, stats: DataFrame, path: str, log_path: str) -> None:
    """Recompute the stored summary; log success, or log the error and raise it."""
    try:
        campaign_summary(stats, F.current_timestamp()).write.mode("overwrite").parquet(path)
    except Exception as error:
        log_event(spark, log_path, REFRESH_FAILED, {"view": SUMMARY_NAME, "error": str(error)})
        raise
    log_event(spark, log_path, REFRESHED, {"view": SUMMARY_NAME, "status": "completed"})


def log_cleanup(spark: SparkSession, log_path: str, table: str, deleted_rows: int) -> None:
    log_event(spark, log_path, CLEANED, {"table": table, "deleted_rows": deleted_rows})
