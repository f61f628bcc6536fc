from __future__ import annotations

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from campanile import schemas
from campanile.operators import aggregate, dedupe, ingest, quality
from campanile.plans import registry
from campanile.sinks import stats_table
from campanile.sources import derived, events as sources
from campanile.streaming import arrival, progress, repeats, stats_job
from tests.helpers import rows, table

KEYS = ("campaign_id", "event_type", "window_start_time")
VALUES = (*KEYS, "window_end_time", "event_count", "total_bid_amount")


def event(time_text, kind="click", campaign="c", spend=1.0, **more):
    return json.dumps({"timestamp": f"2024-01-01T{time_text}Z", "campaign_id": campaign, "event_type": kind,
                       "spend_usd": spend, **more})


class Feed:
    """A folder of JSON files, drained file by file."""

    def __init__(self, spark, folder, name="q"):
        self.spark, self.folder, self.name = spark, folder, name
        self.files = 0
        os.makedirs(f"{folder}/in")

    def add(self, *lines):
        path = f"{self.folder}/in/{self.files:04d}.json"
        with open(path, "w") as f:
            f.write("\n".join(lines))
        os.utime(path, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        self.files += 1
        return self

    def messages(self):
        return sources.read_event_stream(self.spark, "text", {"maxFilesPerTrigger": "1"}, f"{self.folder}/in")

    def drain(self, stats=None, **options):
        stats = stats_job.event_stats(self.messages()) if stats is None else stats
        query = stats_job.start_stats_stream(
            stats, f"{self.folder}/table", f"{self.folder}/checkpoint", self.name, processing_time=None, **options)
        query.awaitTermination()
        return query

    def versions(self, schema=schemas.STATS):
        return stats_table.read_versions(self.spark, f"{self.folder}/table", schema)

    def current(self):
        return table(stats_table.latest_stats(self.versions()), *VALUES)

    def batch(self):
        parsed = ingest.parse_events(self.spark.read.text(f"{self.folder}/in"))
        return table(aggregate.aggregate_events(ingest.enrich_events(parsed)), *VALUES)


@pytest.fixture()
def feed(spark, folder):
    return Feed(spark, folder, f"q{abs(hash(folder))}")


def test_window_over_two_triggers_is_replaced_not_added(feed):
    feed.add(event("10:00:01"), event("10:00:02")).add(event("10:00:03"), event("10:01:03"))
    feed.drain()
    assert feed.current() == feed.batch()
    assert [r[4] for r in feed.current()] == [3, 1]
    assert table(feed.versions().filter("window_start_time < '2024-01-01 10:01:00'"), "batch_id", "event_count") == [
        (0, 2), (1, 3),
    ]


def test_restart_goes_on_where_it_stopped(feed):
    feed.add(event("10:00:01")).drain()
    feed.add(event("10:00:30")).drain()
    assert feed.current() == feed.batch() and feed.current()[0][4] == 2


def test_crash_after_write_is_replayed_without_effect(feed):
    feed.add(event("10:00:01")).drain()
    feed.add(event("10:00:30")).drain()
    before = feed.current()
    # Forget that the last batch was committed: it runs again on restart.
    newest = max(int(n) for n in os.listdir(f"{feed.folder}/checkpoint/commits") if n.isdigit())
    for name in (str(newest), f".{newest}.crc"):
        os.remove(f"{feed.folder}/checkpoint/commits/{name}")
    feed.drain()
    assert feed.current() == before


def test_failing_sink_stops_the_query_and_loses_nothing(feed):
    feed.add(event("10:00:01"))
    blocked = f"{feed.folder}/table"
    with open(blocked, "w") as f:
        f.write("a file where the table folder should be")
    with pytest.raises(Exception):
        feed.drain(writer_options={"attempts": 1})
    os.remove(blocked)
    feed.drain()
    assert feed.current() == feed.batch()


def test_late_rows_are_dropped_after_the_watermark(feed):
    feed.add(event("10:00:01")).add(event("10:10:00"))
    # A window stays open until the batch after the watermark passed it.
    feed.add(event("10:00:02"), event("10:09:30")).add(event("10:10:10"), event("10:00:03"))
    query = feed.drain()
    counts = {str(r[2])[11:]: r[4] for r in feed.current()}
    assert counts == {"10:00:00": 2, "10:09:00": 1, "10:10:00": 2}
    late = [progress.progress_record(json.loads(p.json))["late_rows"] for p in query.recentProgress]
    assert sum(late) > 0


def test_rejects_do_not_reach_the_table(feed):
    feed.add(event("10:00:01"), "{broken", event("10:00:02", campaign=None), event("10:00:03").replace("1.0", "NaN"))
    query = feed.drain()
    assert [r[4] for r in feed.current()] == [1]
    seen = [json.loads(p.json)["observedMetrics"]["quality"] for p in query.recentProgress if p.numInputRows]
    assert seen == [{"processed": 1, "failed": 3}]
    rejects = stats_job.start_reject_stream(
        feed.messages(), f"{feed.folder}/rejects", f"{feed.folder}/rejects-checkpoint", feed.name + "r", None)
    rejects.awaitTermination()
    stored = feed.spark.read.parquet(f"{feed.folder}/rejects")
    assert table(stored, "reject_reason") == [("amount out of range",), ("malformed json",), ("null campaign_id",)]


def test_stream_equals_batch_on_the_event_table(spark, feed):
    lines = derived.event_messages(derived.ad_events(spark, "/root/testdata/sf0.001")).orderBy("event_id").collect()
    step = len(lines) // 4 + 1
    for i in range(0, len(lines), step):
        feed.add(*[r["value"] for r in lines[i:i + step]])
    feed.drain()
    assert feed.current() == feed.batch()


@pytest.mark.parametrize("name", ["stream_minute_stats", "stream_stats_with_rejects", "stream_arrival_totals", "stream_repeats"])
def test_streams_read_a_table_of_several_part_files(spark, folder, name):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(f"{folder}/events.parquet")
    query = registry.all_queries()[name]
    got, wanted = (table(query(spark, place).drop("batch_id"), "*") for place in (folder, "/root/testdata/sf0.001"))
    assert got == wanted != []


def test_start_is_idempotent_and_stop_is_clean(feed):
    feed.add(event("10:00:01"))
    stats = stats_job.event_stats(feed.messages())
    start = lambda: stats_job.start_stats_stream(
        stats, f"{feed.folder}/table", f"{feed.folder}/checkpoint", feed.name, processing_time="1 second")
    first = start()
    assert start().id == first.id
    first.processAllAvailable()
    stats_job.stop_stream(first)
    assert not first.isActive and feed.current()[0][4] == 1


def test_arrival_slots_hold_every_event(feed):
    feed.add(event("10:00:01"), event("23:59:00")).add(event("03:00:00"))
    parsed = ingest.enrich_events(ingest.parse_events(feed.messages()))
    feed.drain(arrival.aggregate_by_arrival(parsed))
    slots = stats_table.latest_stats(feed.versions())
    assert rows(slots.agg(F.sum("event_count"), F.sum("total_bid_amount"))) == [(3, 3)]
    assert slots.filter("window_start_time < '2025-01-01'").count() == 0


def keyed(feed):
    raw = feed.messages().select(F.from_json("value", "id string, type string").alias("r")).select("r.*")
    return dedupe.with_record_key(raw, "id", "type")


def record(i, kind):
    return json.dumps({"id": i, "type": kind})


def test_repeats_across_batches(feed):
    feed.add(record("S01", "X"), record("S02", "Y"), record("S02", " Y "))
    feed.add(record("S01", "X"), record("S03", "Z"), record("S01", "X"), record("", "Z")).add(record("S02", "Y"))
    counts = repeats.key_counts(keyed(feed))
    feed.drain(counts, date_col=None)
    versions = feed.versions(counts.schema)
    assert table(repeats.repeats_by_batch(versions)) == [(0, "S02:Y", 1), (1, "S01:X", 2), (2, "S02:Y", 1)]
    current = stats_table.latest_stats(versions, ["record_key"])
    assert table(current, "record_key", "record_count") == [("S01:X", 3), ("S02:Y", 3), ("S03:Z", 1)]


def test_first_within_watermark(spark, feed):
    feed.add(event("10:00:01", user_id="u"), event("10:00:02", user_id="u")).add(event("10:00:03", user_id="u"))
    parsed = ingest.parse_events(feed.messages())
    firsts = repeats.first_within(parsed, "user_id", "event_timestamp", "1 hour")
    query = (firsts.writeStream.format("parquet").option("path", f"{feed.folder}/firsts").outputMode("append")
             .option("checkpointLocation", f"{feed.folder}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    assert spark.read.parquet(f"{feed.folder}/firsts").count() == 1


def test_progress_becomes_metrics_rows(spark, feed):
    feed.add(event("10:00:01"), "{broken")
    listener = progress.MetricsListener(f"{feed.folder}/metrics")
    spark.streams.addListener(listener)
    try:
        query = feed.drain()
        found = progress.query_metrics(query).filter("records_processed > 0")
        assert rows(found, "pipeline_name", "status", "records_processed", "errors_count") == [
            (feed.name, "success", 2, 1)]
        assert found.first()["processing_time_sec"] > 0
        deadline = time.time() + 30
        while not os.path.isdir(f"{feed.folder}/metrics/") and time.time() < deadline:
            time.sleep(0.2)
        time.sleep(2)
        kept = spark.read.parquet(f"{feed.folder}/metrics").filter("records_processed > 0")
        assert rows(kept, "records_processed", "errors_count") == [(2, 1)]
        # The metrics have the columns the health report reads.
        broken = quality.constraint_violations(kept, {"status_known": quality.RUN_RULES["status_known"]})
        assert broken.count() == 0
    finally:
        spark.streams.removeListener(listener)
