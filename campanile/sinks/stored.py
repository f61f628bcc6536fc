"""The statistics table of a long-running stream, and the summary that is kept up with it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from campanile import schemas
from campanile.functions import ratio
from campanile.operators.maintenance import RETENTION_DAYS
from campanile.sinks.versioned import Snapshots, VersionedTable

DAY = "stats_date"


def stats_table(spark: SparkSession, path: str, dims: Sequence[str] = (), sales: bool = False) -> VersionedTable:
    """Statistics by day, sorted by campaign with a Bloom filter on it; dimensions are part of the key."""
    return VersionedTable(
        spark, path, schemas.stats(dims, sales), schemas.stats_keys(dims), DAY, F.to_date("window_start_time"),
        order=("campaign_id", "window_start_time"), bloom=("campaign_id",), kept_by="window_start_time",
    )


def stats_between(table: VersionedTable, start: str, end: str) -> DataFrame:
    """Current statistics of windows that start in a half-open range; other days aren't read."""
    rows = table.current(start[:10], end[:10])
    inside = (F.col("window_start_time") >= F.lit(start).cast("timestamp")) & (F.col("window_start_time") < F.lit(end).cast("timestamp"))
    return rows.filter(inside)


def purge_expired(table: VersionedTable, as_of: str, days: int = RETENTION_DAYS) -> int:
    """Drop statistics older than the limit for good; their number.  A row exactly at the limit stays."""
    limit = table.spark.range(1).select(
        F.date_format(F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days)), "yyyy-MM-dd HH:mm:ss")).first()[0]
    return table.purge(limit)


# --- summary kept up with the table --------------------------------------------------------------

_PARTIAL = "campaign_id string, event_type string, events bigint, bid decimal(38,6), per_event decimal(38,12), priced bigint, " \
           "first_event_time timestamp, last_event_time timestamp, windows bigint"


def daily_partials(stats: DataFrame) -> DataFrame:
    """Mergeable parts of the summary, by day, campaign and type."""
    per_event = ratio("total_bid_amount", "event_count").cast("decimal(28,12)")
    return stats.groupBy(DAY, "campaign_id", "event_type").agg(
        F.sum("event_count").alias("events"), F.sum("total_bid_amount").cast("decimal(38,6)").alias("bid"),
        F.sum(per_event).cast("decimal(38,12)").alias("per_event"), F.count(per_event).alias("priced"),
        F.min("window_start_time").alias("first_event_time"), F.max("window_end_time").alias("last_event_time"),
        F.count("*").alias("windows"))


def summary_of(partials: DataFrame) -> DataFrame:
    """The summary per campaign and type, merged from days; equal to one over all windows."""
    return partials.groupBy("campaign_id", "event_type").agg(
        F.sum("events").alias("total_events"), F.sum("bid").cast("decimal(38,6)").alias("total_bid_amount"),
        ratio(F.sum("per_event"), F.sum("priced")).alias("avg_bid_per_event"),
        F.min("first_event_time").alias("first_event_time"), F.max("last_event_time").alias("last_event_time"),
        F.sum("windows").alias("total_windows"))


class KeptSummary:
    """Partial sums of a statistics table by day, kept up by redoing the days that changed.

    The table's values are replaced, not added, and rows may be purged, so differences can't be added to a sum; a
    changed day is summed anew.  What each day was summed from is noted in the manifest, with the sums.
    """

    def __init__(self, table: VersionedTable, path: str):
        schema = table.spark.createDataFrame([], _PARTIAL).schema
        self.table, self.partials = table, Snapshots(table.spark, path, schema, DAY, order=("campaign_id",))

    def refresh(self) -> list[str]:
        """Redo the days whose rows may have changed since the last refresh; these days."""
        manifest, states = self.partials.manifest(), self.table.states()
        summed = manifest.notes.get("states", {})
        changed = sorted(day for day in {*states, *summed} if states.get(day) != summed.get(day))
        if changed:
            rows = daily_partials(self.table.current(parts=changed))
            self.partials.publish(rows.select(*self.partials.schema.names, DAY), changed, manifest, states=states)
        return changed

    def summary(self) -> DataFrame:
        return summary_of(self.partials.read())
