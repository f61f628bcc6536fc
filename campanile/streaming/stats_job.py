"""The streaming job: messages to windowed statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from campanile.functions import from_micros
from campanile.operators.aggregate import aggregate_events
from campanile.operators.ingest import enrich_events
from campanile.operators.quality import accepted, observe_quality, quarantine_events, rejected
from campanile.sinks.stats_table import stats_writer
from campanile.sinks.versioned import VersionedTable

WINDOW = "1 minute"
WATERMARK = "1 minute"
TRIGGER = "1 minute"


def event_stats(
    messages: DataFrame, window: str = WINDOW, watermark: str = WATERMARK, dims: Sequence[str] = (), sales: bool = False,
) -> DataFrame:
    """Validate, parse, enrich and aggregate a stream of messages, with dimensions and revenue if wanted."""
    checked = observe_quality(quarantine_events(messages))
    return aggregate_events(enrich_events(accepted(checked)), window, watermark, dims, sales)


def trigger(processing_time: str | None) -> dict:
    return {"processingTime": processing_time} if processing_time else {"availableNow": True}


def start_stats_stream(
    stats: DataFrame, path: str, checkpoint: str, name: str, processing_time: str | None = TRIGGER,
    date_col: str | None = "window_start_time", writer_options: dict | None = None,
) -> StreamingQuery:
    """Start writing running totals; return the active query when it runs already.

    Without ``processing_time`` the query drains what is available and stops.
    Checkpoint and table folder belong together.
    """
    for active in stats.sparkSession.streams.active:
        if active.name == name:
            return active
    return (
        stats.writeStream.queryName(name)
        .outputMode("update")
        .trigger(**trigger(processing_time))
        .option("checkpointLocation", checkpoint)
        .foreachBatch(stats_writer(path, date_col=date_col, **(writer_options or {})))
        .start()
    )


def start_table_stream(
    stats: DataFrame, table: VersionedTable, checkpoint: str, name: str, processing_time: str | None = TRIGGER, **options,
) -> StreamingQuery:
    """Start writing running totals into a versioned table; return the active query when it runs already."""
    for active in stats.sparkSession.streams.active:
        if active.name == name:
            return active
    return (
        stats.writeStream.queryName(name)
        .outputMode("update")
        .trigger(**trigger(processing_time))
        .option("checkpointLocation", checkpoint)
        .foreachBatch(table.writer(**options))
        .start()
    )


def start_reject_stream(
    messages: DataFrame, path: str, checkpoint: str, name: str, processing_time: str | None = TRIGGER,
) -> StreamingQuery:
    """Keep rejected messages with their reason, in a folder of their own."""
    rejects = rejected(quarantine_events(messages)).select("value", "reject_reason")
    return (
        rejects.writeStream.queryName(name)
        .outputMode("append")
        .trigger(**trigger(processing_time))
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .format("parquet")
        .start()
    )


def stop_stream(query: StreamingQuery, timeout: float | None = None) -> None:
    """Finish the work at hand, stop, and surface a failure."""
    if query.isActive:
        query.stop()
    query.awaitTermination(timeout) if timeout else query.awaitTermination()


def state_totals(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Count and spend of each window still open in the state of a stopped statistics stream.

    Windows that the watermark closed are in the table only.
    """
    state = spark.read.format("statestore").load(checkpoint)
    key, count, spend = (state.schema[n].dataType.names for n in ("key", "value", "value"))
    return state.select(
        F.col("key")["campaign_id"].alias("campaign_id"), F.col("key")["event_type"].alias("event_type"),
        F.col("key")[key[0]]["start"].alias("window_start_time"),
        F.col("value")[count[-2]].alias("state_count"), from_micros(F.col("value")[spend[-1]]).alias("state_bid_amount"))
