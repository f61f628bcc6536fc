"""Late rows of a stream as data.

Spark drops rows whose window had ended before the watermark and reports no more than a number.  A side stream over the same
source keeps them: each micro-batch is compared with the watermark that the micro-batches before it left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from campanile.sinks import files
from campanile.sinks.stats_table import persistently
from campanile.streaming.stats_job import WATERMARK, WINDOW, trigger


def newest_before(spark: SparkSession, path: str, batch_id: int) -> int | None:
    """The latest event time, in microseconds, of all micro-batches before this one."""
    earlier = [int(n) for n in files.names(spark, f"{path}/newest") if n.isdigit() and int(n) < batch_id]
    return int(files.read_text(spark, f"{path}/newest/{max(earlier)}")) if earlier else None


def _note_newest(spark: SparkSession, path: str, batch_id: int, newest: int) -> None:
    place = f"{path}/newest"
    files.delete(spark, f"{place}/{batch_id}")
    files.publish_text(spark, f"{place}/{batch_id}", str(newest))
    # The note before this one serves a replay of this micro-batch.
    for number in sorted(int(n) for n in files.names(spark, place) if n.isdigit())[:-2]:
        files.delete(spark, f"{place}/{number}")


def late_writer(path: str, time_col: str = "event_timestamp", window: str = WINDOW, watermark: str = WATERMARK) -> Callable[[DataFrame, int], None]:
    """Callback for ``foreachBatch``: late rows go to ``<path>/rows/batch=<n>``, with the watermark that they missed.

    A row is late if its window had ended by the watermark, the latest time of earlier micro-batches less the delay.
    Rows without a time aren't.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = newest_before(spark, path, batch_id)
        mark = (F.timestamp_micros(F.lit(before)) - F.expr(f"INTERVAL {watermark}")) if before is not None else F.lit(None).cast("timestamp")
        newest = batch.agg(F.max(F.unix_micros(time_col))).first()[0]  # reads the one column
        # A window of its own name: the columns of the rows may have any.
        late = batch.withColumn("late_window", F.window(time_col, window)).filter(F.col("late_window.end") <= mark)
        out = late.withColumn("watermark", mark).withColumn("window_end_time", F.col("late_window.end")).drop("late_window")
        persistently(lambda: out.write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}"))
        found = [t for t in (newest, before) if t is not None]
        if found:
            _note_newest(spark, path, batch_id, max(found))

    return write


def start_late_stream(
    events: DataFrame, path: str, checkpoint: str, name: str, processing_time: str | None = None, **options: str,
) -> StreamingQuery:
    """Start keeping the late rows of a stream of typed events."""
    for active in events.sparkSession.streams.active:
        if active.name == name:
            return active
    return (
        events.writeStream.queryName(name)
        .trigger(**trigger(processing_time))
        .option("checkpointLocation", checkpoint)
        .foreachBatch(late_writer(path, **options))
        .start()
    )


def read_late_rows(spark: SparkSession, path: str, schema) -> DataFrame:
    """All late rows so far, with their micro-batch, the watermark and the end of their window."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return spark.read.schema(f"{columns}, watermark timestamp, window_end_time timestamp, batch bigint").parquet(f"{path}/rows")
