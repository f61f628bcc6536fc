"""Replay-safe statistics table on plain Parquet.

Every micro-batch replaces the folder of its own id, so replaying a batch leaves
the table as it was.  A stream in update mode emits running totals, so readers
take the value of the newest batch per key; values are never added up.

Layout: ``<path>/batch_id=<n>/stats_date=<day>/*.parquet``.  A new checkpoint
numbers its batches from 0 again and therefore needs a new folder.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from campanile.operators.maintenance import RETENTION_DAYS
from campanile.schemas import STATS_KEYS

MAX_ATTEMPTS = 3
BACKOFF_SECONDS = 2.0


def persistently(write: Callable[[], None], attempts: int = MAX_ATTEMPTS, backoff: float = BACKOFF_SECONDS) -> None:
    """Try a write again after a pause; its last failure is raised."""
    for attempt in range(1, attempts + 1):
        try:
            return write()
        except Exception:
            if attempt == attempts:
                raise
            time.sleep(backoff * attempt)


def upsert_stats(
    batch: DataFrame, batch_id: int, path: str, date_col: str | None = "window_start_time",
    attempts: int = MAX_ATTEMPTS, backoff: float = BACKOFF_SECONDS,
) -> None:
    """Write one micro-batch from the executors; the last failure is raised.

    Raising leaves the batch unfinished in the checkpoint, so it is run again
    on restart instead of being lost.  Rebalancing gathers the output of many
    state partitions into few files, and splits what is large.
    """
    stamped = batch.withColumn("updated_at", F.current_timestamp())
    if date_col:
        stamped = stamped.withColumn("stats_date", F.to_date(date_col))
    writer = stamped.hint("rebalance", *(["stats_date"] if date_col else [])).write.mode("overwrite")
    if date_col:
        writer = writer.partitionBy("stats_date")
    persistently(lambda: writer.parquet(f"{path}/batch_id={batch_id}"), attempts, backoff)


def stats_writer(path: str, **options) -> Callable[[DataFrame, int], None]:
    """Callback for ``foreachBatch``."""
    return lambda batch, batch_id: upsert_stats(batch, batch_id, path, **options)


def read_versions(spark: SparkSession, path: str, schema) -> DataFrame:
    """All written versions, with their batch id."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return spark.read.schema(f"{columns}, updated_at timestamp, batch_id bigint, stats_date date").parquet(path)


def latest_stats(versions: DataFrame, keys: Sequence[str] = STATS_KEYS) -> DataFrame:
    """Current value per key.

    Columns are picked one by one: fixed-width buffers keep this a hash
    aggregation, where picking a struct would sort.
    """
    values = [c for c in versions.columns if c not in (*keys, "batch_id", "stats_date")]
    return versions.groupBy(*keys).agg(*[F.max_by(c, "batch_id").alias(c) for c in values])


def compact_stats(spark: SparkSession, path: str, schema, out_path: str, keys: Sequence[str] = STATS_KEYS) -> int:
    """Rewrite the current values, one version per key; the newest batch id in them.

    Partitioned by day and sorted by campaign, so time ranges prune folders and
    campaign filters prune row groups.  Rebalancing splits large days over
    several files and gathers small ones.
    """
    versions = read_versions(spark, path, schema)
    through = versions.agg(F.max("batch_id")).first()[0]
    settled = versions.filter(F.col("batch_id") <= F.lit(-1 if through is None else through))
    dated = latest_stats(settled, keys).withColumn("stats_date", F.to_date("window_start_time"))
    (
        dated.hint("rebalance", "stats_date")
        .sortWithinPartitions("stats_date", "campaign_id", "window_start_time")
        .write.mode("overwrite").partitionBy("stats_date").parquet(out_path)
    )
    return -1 if through is None else through


def current_stats(
    spark: SparkSession, path: str, schema, compacted: str, through: int, keys: Sequence[str] = STATS_KEYS,
) -> DataFrame:
    """Current values from a compacted table and the batches written after it.

    Only folders of batches newer than ``through`` are read.
    """
    newer = read_versions(spark, path, schema).filter(F.col("batch_id") > through)
    base = spark.read.parquet(compacted).withColumn("batch_id", F.lit(through).cast("bigint"))
    return latest_stats(base.select(*newer.columns).unionByName(newer), keys)


def purge_expired(spark: SparkSession, path: str, as_of: str, days: int = RETENTION_DAYS) -> int:
    """Delete rows older than the limit from a compacted table; their number.

    Whole expired days are dropped as folders.  Only the day the limit falls
    into is rewritten.
    """
    table = spark.read.parquet(path)
    limit = F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days))
    old = (F.col("stats_date") <= F.to_date(limit)) & (F.col("window_start_time") < limit)
    counts = table.filter(old).agg(F.count("*").alias("n"), F.to_date(F.any_value(limit)).alias("day")).first()
    if not counts["n"]:
        return 0
    boundary = counts["day"]
    kept = table.filter((F.col("stats_date") == F.lit(boundary)) & (F.col("window_start_time") >= limit))
    boundary_kept = not kept.isEmpty()
    # Dynamic overwrite replaces just the folders it writes, after the job is done.
    (
        kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("stats_date").parquet(path)
    )
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    root = hadoop(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("stats_date="):
            day = name.removeprefix("stats_date=")
            if day < str(boundary) or (day == str(boundary) and not boundary_kept):
                fs.delete(status.getPath(), True)
    spark.catalog.refreshByPath(path)
    return counts["n"]
