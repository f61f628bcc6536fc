from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from campanile.operators import aggregate, ingest
from tests.helpers import at, events, messages, rows, stats_frame, stats_row, table

E2E = [
    {"timestamp": "2024-05-15T10:00:15Z", "campaign_id": "cmp_1", "event_type": "impression", "bid_amount_usd": 0.05},
    {"timestamp": "2024-05-15T10:00:25Z", "campaign_id": "cmp_1", "event_type": "impression", "bid_amount_usd": 0.06},
    {"timestamp": "2024-05-15T10:00:45Z", "campaign_id": "cmp_1", "event_type": "click", "bid_amount_usd": 0.10},
]


def enriched(spark, *values):
    return ingest.enrich_events(ingest.parse_events(messages(spark, *values)))


def test_one_minute_windows(spark):
    stats = aggregate.aggregate_events(enriched(spark, *E2E))
    assert table(stats) == [
        ("cmp_1", "click", at("2024-05-15 10:00:00"), at("2024-05-15 10:01:00"), 1, Decimal("0.100000")),
        ("cmp_1", "impression", at("2024-05-15 10:00:00"), at("2024-05-15 10:01:00"), 2, Decimal("0.110000")),
    ]


def test_windows_are_half_open(spark):
    edge = [dict(E2E[0], timestamp=f"2024-05-15T10:0{m}Z") for m in ("0:59.999999", "1:00.000000")]
    assert table(aggregate.aggregate_events(enriched(spark, *edge)), "window_start_time", "event_count") == [
        (at("2024-05-15 10:00:00"), 1), (at("2024-05-15 10:01:00"), 1),
    ]


def test_unkeyed_rows_are_left_out(spark):
    bad = [dict(E2E[0], campaign_id=None), {**E2E[0], "timestamp": None}, dict(E2E[0], event_type=None), "{x"]
    assert aggregate.aggregate_events(enriched(spark, *bad)).count() == 0


def test_dimensions_join_the_key(spark):
    values = [dict(E2E[0], device_type=d) for d in ("TV", "TV", None)]
    stats = aggregate.aggregate_events(enriched(spark, *values), dims=["device_type"])
    assert table(stats, "device_type", "event_count") == [("TV", 2), ("unknown", 1)]


def test_money_is_exact(spark):
    df = events(spark, *[
        {"timestamp": at("2024-01-01"), "campaign_id": "c", "event_type": "click", "spend_usd": 0.1}
    ] * 1000).withColumn("event_timestamp", F.col("timestamp"))
    (row,) = aggregate.aggregate_events(ingest.enrich_events(df)).collect()
    assert row["total_bid_amount"] == Decimal("100.000000")


def test_amount_that_is_no_number_raises(spark):
    df = events(spark, {"timestamp": at("2024-01-01"), "campaign_id": "c", "event_type": "click",
                        "spend_usd": float("nan")}).withColumn("event_timestamp", F.col("timestamp"))
    with pytest.raises(Exception, match="CAST"):
        aggregate.aggregate_events(ingest.enrich_events(df)).collect()


def test_running_totals_ignore_null_keys_and_bids(spark):
    df = spark.createDataFrame(
        [("a", "click", 1.5), ("a", "click", None), (None, "click", 1.0), ("a", None, 1.0), ("b", "click", None)],
        "campaign_id string, event_type string, total_bid_amount double",
    )
    assert table(aggregate.running_totals(df)) == [
        ("a", "click", 2, Decimal("1.500000")), ("b", "click", 1, Decimal("0.000000")),
    ]


def test_campaign_summary(spark):
    stats = stats_frame(
        spark, stats_row("a", "click", 2, 5), stats_row("a", "click", 0, 7, start="2024-01-01 11:00:00"),
        stats_row("a", "click", 4, 2, end="2024-01-01 12:00:00"),
    )
    (row,) = aggregate.campaign_summary(stats, F.lit("now")).collect()
    # The window without events has no mean of its own.
    assert (row["total_events"], row["total_bid_amount"], row["avg_bid_per_event"], row["total_windows"]) == (
        6, 14, 1.5, 3)
    assert row["last_event_time"] == at("2024-01-01 12:00:00") and row["last_refreshed"] == "now"


def test_summary_of_windows_without_events(spark):
    (row,) = aggregate.campaign_summary(stats_frame(spark, stats_row("a", "click", 0, 7))).collect()
    assert row["avg_bid_per_event"] is None


def test_global_totals_of_empty_input(spark):
    assert rows(aggregate.totals_by(stats_frame(spark))) == [(0, 0, 0, Decimal("0.000000"))]


def test_freshness(spark):
    as_of = F.lit("2024-01-01 10:05:30").cast("timestamp")
    stats = stats_frame(spark, stats_row("a", "click", 1, 1))
    assert rows(aggregate.data_freshness(stats, as_of), "data_freshness_seconds") == [(330,)]
    assert rows(aggregate.data_freshness(stats.limit(0), as_of)) == [(None, 9999)]


def test_lowest_day_takes_the_first_of_ties(spark):
    daily = spark.createDataFrame([("2024-01-03", 5.0), ("2024-01-02", 5.0), ("2024-01-01", 9.0)], "day string, v double")
    assert rows(aggregate.lowest_day(daily, "v")) == [("2024-01-02", 5.0)]
    assert rows(aggregate.lowest_day(daily.limit(0), "v")) == []


def test_distinct_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    assert rows(aggregate.distinct_count(df, "k")) == [(2,)]
    assert rows(aggregate.distinct_count(df, "k", approximate=True)) == [(2,)]
    assert table(aggregate.record_counts(df, "k")) == [("a", 2), ("b", 1), (None, 1)]
