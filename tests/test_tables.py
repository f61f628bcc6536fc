"""Table maintenance and sinks."""

from __future__ import annotations

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from campanile import schemas, session
from campanile.operators import maintenance
from campanile.sinks import messages, oplog, stats_table
from tests.helpers import at, rows, stats_frame, stats_row, table

KEYS = ["campaign_id", "event_type", "window_start_time"]


def stored(spark, *facts):
    return stats_frame(spark, *facts).select(*schemas.STATS.names)


def stamped(df, when):
    return df.select(*KEYS, "event_count", "total_bid_amount").withColumn("updated_at", F.lit(when).cast("timestamp"))


def test_merge_adds_disjoint_deltas(spark):
    base = stamped(stored(spark, stats_row("a", "click", 2, 1), stats_row("b", "click", 1, 1)), "2024-01-01")
    delta = stamped(stored(spark, stats_row("a", "click", 3, 2.5)), "2024-01-02")
    got = maintenance.merge_additive(base, delta, KEYS)
    assert table(got, "campaign_id", "event_count", "total_bid_amount", "updated_at") == [
        ("a", 5, Decimal("3.500000"), at("2024-01-02")), ("b", 1, Decimal("1.000000"), at("2024-01-01")),
    ]


def test_insert_ignore(spark):
    base = spark.createDataFrame([("a", "old")], "k string, v string")
    new = spark.createDataFrame([(1, "a", "new"), (3, "b", "second"), (2, "b", "first")], "seq int, k string, v string")
    got = maintenance.insert_ignore(base, new.select("k", "v", "seq"), ["k"], "seq")
    assert table(got) == [("a", "old"), ("b", "first")]
    again = maintenance.insert_ignore(got, new.select("k", "v", "seq"), ["k"], "seq")
    assert table(again) == table(got)


def test_backfill_touches_empty_impressions_only(spark):
    df = stamped(stored(
        spark, stats_row("a", "impression", 10, 0), stats_row("b", "impression", 10, 1), stats_row("c", "click", 10, 0),
    ), "2024-01-01")
    got = maintenance.backfill_impression_bids(df, updated_at=F.lit("2024-02-01").cast("timestamp"))
    assert table(got, "campaign_id", "total_bid_amount", "updated_at") == [
        ("a", Decimal("0.500000"), at("2024-02-01")), ("b", Decimal("1.000000"), at("2024-01-01")),
        ("c", Decimal("0.000000"), at("2024-01-01")),
    ]


def windows(spark, *starts):
    return stored(spark, *[stats_row(f"c{i}", "click", 1, 1, start=s, end=s) for i, s in enumerate(starts)])


LIMIT_ROWS = ("2024-01-01 11:59:59", "2024-01-01 12:00:00", "2024-01-05 00:00:00", "2023-06-01 00:00:00")
AS_OF = "2024-03-31 12:00:00"


def test_retention_keeps_its_limit(spark):
    df = windows(spark, *LIMIT_ROWS)
    assert table(maintenance.apply_retention(df, AS_OF), "campaign_id") == [("c1",), ("c2",)]
    assert rows(maintenance.expired_rows(df, AS_OF)) == [(2,)]


def read(spark, path):
    return stats_table.latest_stats(stats_table.read_versions(spark, path, schemas.STATS))


def test_newest_batch_wins_and_replay_changes_nothing(spark, folder):
    path = f"{folder}/stats"
    first = stored(spark, stats_row("a", "click", 2, 1), stats_row("b", "click", 1, 1))
    second = stored(spark, stats_row("a", "click", 3, 2), stats_row("c", "click", 1, 1, start="2024-02-01 00:00:00"))
    stats_table.upsert_stats(first, 0, path)
    stats_table.upsert_stats(second, 1, path)
    expected = [("a", 3, Decimal("2.000000")), ("b", 1, Decimal("1.000000")), ("c", 1, Decimal("1.000000"))]
    assert table(read(spark, path), "campaign_id", "event_count", "total_bid_amount") == expected
    stats_table.upsert_stats(second, 1, path)
    stats_table.upsert_stats(first.limit(0), 2, path)
    assert table(read(spark, path), "campaign_id", "event_count", "total_bid_amount") == expected
    assert rows(read(spark, path).filter("updated_at is null")) == []


def test_failed_write_is_tried_again_and_raised(spark, folder):
    df = stored(spark, stats_row("a", "click", 1, 1)).withColumn("event_count", F.raise_error(F.lit("no")))
    with pytest.raises(Exception, match="no"):
        stats_table.upsert_stats(df, 0, f"{folder}/stats", attempts=2, backoff=0.01)


def test_compaction_and_purge(spark, folder):
    path, out = f"{folder}/stats", f"{folder}/compact"
    stats_table.upsert_stats(windows(spark, *LIMIT_ROWS), 0, path)
    assert stats_table.compact_stats(spark, path, schemas.STATS, out) == 0
    assert spark.read.parquet(out).count() == 4
    assert stats_table.purge_expired(spark, out, AS_OF) == 2
    assert table(spark.read.parquet(out), "campaign_id") == [("c1",), ("c2",)]
    assert sorted(d for d in os.listdir(out) if d.startswith("stats_date")) == [
        "stats_date=2024-01-01", "stats_date=2024-01-05",
    ]
    assert stats_table.purge_expired(spark, out, AS_OF) == 0


def test_batches_after_a_compaction(spark, folder):
    path, out = f"{folder}/stats", f"{folder}/compact"
    stats_table.upsert_stats(stored(spark, stats_row("a", "click", 2, 1), stats_row("b", "click", 1, 1)), 0, path)
    through = stats_table.compact_stats(spark, path, schemas.STATS, out)
    stats_table.upsert_stats(stored(spark, stats_row("a", "click", 3, 2), stats_row("c", "click", 1, 1)), 1, path)
    both = stats_table.current_stats(spark, path, schemas.STATS, out, through)
    assert table(both, "campaign_id", "event_count") == [("a", 3), ("b", 1), ("c", 1)]
    assert table(both) == table(read(spark, path).select(*both.columns))


def test_purge_of_a_whole_limit_day(spark, folder):
    out = f"{folder}/compact"
    dated = windows(spark, "2024-01-01 11:00:00", "2024-01-02 00:00:00").withColumn("stats_date", F.to_date("window_start_time"))
    dated.write.partitionBy("stats_date").parquet(out)
    assert stats_table.purge_expired(spark, out, AS_OF) == 1
    assert table(spark.read.parquet(out), "campaign_id") == [("c1",)]


def test_messages(spark, folder):
    df = spark.createDataFrame([("c1", 2)], "campaign_id string, n int")
    sent = messages.to_messages(df)
    assert rows(sent) == [("c1", '{"campaign_id":"c1","n":2}')]
    messages.write_messages(sent, "text", f"{folder}/out")
    messages.write_messages(sent, "text", f"{folder}/out")
    assert spark.read.text(f"{folder}/out").count() == 2


def test_summary_refresh_is_logged(spark, folder):
    stats = stored(spark, stats_row("a", "click", 2, 1))
    oplog.refresh_summary(spark, stats, f"{folder}/summary", f"{folder}/log")
    oplog.refresh_summary(spark, stats, f"{folder}/summary", f"{folder}/log")
    assert spark.read.parquet(f"{folder}/summary").count() == 1
    log = oplog.read_log(spark, f"{folder}/log")
    status = F.variant_get("event_data", "$.status", "string")
    assert rows(log, "event_type", status) == [("materialized_view_refresh", "completed")] * 2


def test_failed_refresh_is_logged_and_raised(spark, folder):
    bad = stored(spark, stats_row("a", "click", 2, 1)).withColumn("event_count", F.raise_error(F.lit("broken")).cast("bigint"))
    with pytest.raises(Exception, match="broken"):
        oplog.refresh_summary(spark, bad, f"{folder}/summary", f"{folder}/log")
    assert rows(oplog.read_log(spark, f"{folder}/log"), "event_type") == [("materialized_view_refresh_error",)]


def test_scratch_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    place = session.scratch_dir(spark, "x")
    assert place != session.scratch_dir(spark, "x")
    if root:
        assert place.startswith(root)
