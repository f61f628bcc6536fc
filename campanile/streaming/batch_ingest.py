"""Ingest rules over a stream of event batches, with a ledger of the batch ids taken so far.

The ledger is a versioned table in buckets of the id's hash.  A micro-batch reads the buckets that its own ids fall into and
only entries of earlier micro-batches, so running one again gives what it gave before.  An id is taken by the earliest
batch that passes all other rules; a rejected batch doesn't take it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from campanile.operators.dedupe import flag_repeats
from campanile.operators.quality import MAX_BATCH_BYTES, MAX_BATCH_EVENTS, check_batches, with_batch_verdict
from campanile.sinks.stats_table import persistently
from campanile.sinks.versioned import VersionedTable
from campanile.streaming.stats_job import trigger

BUCKETS = 64
#: Micro-batches of the ledger that are folded at once.
FOLD_EVERY = 32


def batch_ledger(spark: SparkSession, path: str, buckets: int = BUCKETS) -> VersionedTable:
    """Taken batch ids; its number of buckets stays as it was first."""
    schema = spark.createDataFrame([], "batch_id string").schema
    bucket = F.lpad(F.pmod(F.xxhash64("batch_id"), F.lit(buckets)).cast("string"), len(str(buckets - 1)), "0")
    return VersionedTable(spark, path, schema, ("batch_id",), "bucket", bucket, order=("batch_id",), bloom=("batch_id",))


def judge_batch(messages: DataFrame, batch_id: int, ledger: VersionedTable, order: str, **limits: int) -> DataFrame:
    """Rows of one micro-batch with their verdict, against the ids that earlier ones took."""
    checked = check_batches(messages, **limits)
    sound = F.col("bad").isNull()
    touched = [r[0] for r in checked.filter(sound).select(ledger.part_of.alias("b")).distinct().collect()]  # at most BUCKETS names
    taken = ledger.current(parts=touched, before=batch_id).select(F.col("batch_id").alias("taken_id"))
    known = checked.join(taken, F.col("batch_id") == F.col("taken_id"), "left")
    judged = flag_repeats(known, ["batch_id"], order, "_again", among=sound & F.col("taken_id").isNull())
    repeat = sound & (F.col("taken_id").isNotNull() | F.col("_again"))
    return with_batch_verdict(judged.withColumn("_repeat", repeat).drop("_again", "taken_id"), "_repeat")


def ingest_writer(path: str, ledger: VersionedTable, order: str, fold_every: int = FOLD_EVERY, **limits: int) -> Callable[[DataFrame, int], None]:
    """Callback for ``foreachBatch``: judged rows go to ``<path>/batch=<n>``, ids taken by them into the ledger."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id and batch_id % fold_every == 0:
            ledger.compact(before=batch_id)
        place = f"{path}/batch={batch_id}"
        judged = judge_batch(batch, batch_id, ledger, order, **limits)
        persistently(lambda: judged.write.mode("overwrite").parquet(place))
        # Read back rather than judged twice.
        accepted = spark.read.schema(judged.schema).parquet(place).filter("reject_reason IS NULL")
        ledger.write_batch(accepted.select("batch_id"), batch_id)

    return write


def start_ingest_stream(
    messages: DataFrame, path: str, ledger: VersionedTable, checkpoint: str, name: str, order: str, processing_time: str | None = None,
    fold_every: int = FOLD_EVERY, **limits: int,
) -> StreamingQuery:
    """Start judging a stream of messages with a column ``value`` and the arrival position ``order``.

    Positions are unique and comparable within a micro-batch; between micro-batches the stream's order counts.
    """
    for active in messages.sparkSession.streams.active:
        if active.name == name:
            return active
    return (
        messages.writeStream.queryName(name)
        .trigger(**trigger(processing_time))
        .option("checkpointLocation", checkpoint)
        .foreachBatch(ingest_writer(path, ledger, order, fold_every, **limits))
        .start()
    )
