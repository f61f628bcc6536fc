"""Batch metrics of running streams, as rows for the health reports."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS_SCHEMA = (
    "process_time timestamp, pipeline_name string, job_id string, status string, "
    "processing_time_sec decimal(10,3), records_processed bigint, errors_count bigint, "
    "late_rows bigint, state_rows bigint, state_bytes bigint"
)


def progress_record(progress: dict, observation: str = "quality") -> dict:
    """One metrics record from the JSON form of a progress report.

    ``late_rows`` counts aggregated rows, so it indicates lateness only.
    """
    state = progress.get("stateOperators") or []
    seen = (progress.get("observedMetrics") or {}).get(observation) or {}
    return {
        "process_time": progress["timestamp"],
        "pipeline_name": progress.get("name") or progress["id"],
        "job_id": f"{progress['runId']}-{progress['batchId']}",
        "status": "success",
        "processing_time_sec": progress.get("batchDuration", 0) / 1000,
        "records_processed": progress.get("numInputRows", 0),
        "errors_count": seen.get("failed", 0),
        "late_rows": sum(s.get("numRowsDroppedByWatermark", 0) for s in state),
        "state_rows": sum(s.get("numRowsTotal", 0) for s in state),
        "state_bytes": sum(s.get("memoryUsedBytes", 0) for s in state),
    }


def progress_rows(spark: SparkSession, progresses: Iterable[dict]) -> DataFrame:
    """Progress reports (a few hundred bytes per batch) as a frame."""
    lines = [(json.dumps(progress_record(p)),) for p in progresses]
    raw = spark.createDataFrame(lines, "value string")
    return raw.select(F.from_json("value", PROGRESS_SCHEMA).alias("p")).select("p.*")


def query_metrics(query: StreamingQuery) -> DataFrame:
    """Metrics of the recent batches of one query."""
    return progress_rows(SparkSession.active(), [json.loads(p.json) for p in query.recentProgress])


class MetricsListener(StreamingQueryListener):
    """Append the metrics of every batch of every stream to a table."""

    def __init__(self, path: str):
        self.path = path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        spark = SparkSession.active()
        rows = progress_rows(spark, [json.loads(event.progress.json)])
        rows.write.mode("append").parquet(self.path)

    def onQueryTerminated(self, event) -> None:
        pass
