"""Physical plans: what must hold for large tables."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from campanile.operators import aggregate, dedupe, ingest, lookup, quality
from campanile.plans import registry, reports
from campanile.plans.top_campaigns import top_campaigns
from campanile.sources import derived
from tests.helpers import plan

FOLDER = "/root/testdata/sf0.001"
# Queries that run something themselves before they return a frame.
EAGER = {"stored_summary", "operational_log", "stream_minute_stats", "stream_stats_with_rejects",
         "stream_arrival_totals", "stream_repeats", "stream_stats_over_triggers", "event_file_stats",
         "stored_stats_after_compaction", "purged_stats"}
LAZY = sorted(set(registry.all_queries()) - EAGER)


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_python_or_single_task_window(spark, name):
    text = plan(registry.all_queries()[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in text
    # A window without partitioning gathers all rows in one task, below a single-partition exchange.
    for spec in re.findall(r"windowspecdefinition\(([^\n]*?)specifiedwindowframe", text):
        assert not re.match(r"\S+ (ASC|DESC)", spec)


def test_no_forced_broadcast(spark):
    """With automatic broadcasts off, nothing is broadcast: sizes decide."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        for name in LAZY:
            assert "BroadcastExchange" not in plan(registry.all_queries()[name](spark, FOLDER)), name
    finally:
        spark.conf.set(key, before)


def stats_table(spark, folder):
    stats = derived.campaign_stats(spark, FOLDER, "1 minute")
    dated = stats.withColumn("stats_date", F.to_date("window_start_time"))
    dated.write.mode("overwrite").partitionBy("stats_date").parquet(f"{folder}/stats")
    return spark.read.parquet(f"{folder}/stats")


def test_lookup_filters_and_columns_reach_the_scan(spark, folder):
    text = plan(lookup.stats_for_campaign(
        stats_table(spark, folder), "campaign_1", "2024-01-05 00:00:00", "2024-01-06 00:00:00"))
    pushed = re.search(r"PushedFilters: \[([^\n]*)\], ReadSchema: (\S+)", text)
    for part in ("EqualTo(campaign_id,campaign_1)", "GreaterThanOrEqual(window_start_time", "LessThan(window_start_time"):
        assert part in pushed.group(1)
    assert "spend_usd" not in pushed.group(2)


def test_reports_read_only_their_columns(spark, folder):
    text = plan(reports.revenue_by(stats_table(spark, folder).withColumn("product_brand", F.lit("x")), "product_brand"))
    assert re.search(r"ReadSchema: struct<total_sales_amount_euro:decimal\(18,6\)>", text)
    text = plan(reports.platform_kpis(derived.campaign_stats(spark, FOLDER)))
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>", text)


def test_order_range_reaches_the_scan(spark):
    text = plan(registry.all_queries()["top_campaigns_by_country"](spark, FOLDER))
    assert "GreaterThanOrEqual(o_orderdate,1995-07-01" in text and "LessThan(o_orderdate,1995-08-01" in text


def test_top_per_country_is_cut_before_the_shuffle(spark):
    text = plan(top_campaigns(derived.hourly_performance(spark, FOLDER), "1995-01-01", "2002-01-01"))
    assert text.count("WindowGroupLimit") == 2
    assert re.search(r"Exchange hashpartitioning\(country_code[^\n]*\n[^\n]*WindowGroupLimit \[country_code", text)


def test_top_k_does_not_sort_everything(spark):
    for name in ("top_campaigns_by_spend", "campaign_efficiency", "revenue_by_brand", "top_stats_rows"):
        assert "TakeOrderedAndProject" in plan(registry.all_queries()[name](spark, FOLDER))


def test_window_aggregation_is_a_partial_hash_aggregation(spark):
    text = plan(aggregate.aggregate_events(
        derived.ad_events(spark, FOLDER).withColumn("total_bid_amount", F.col("spend_usd"))))
    assert text.count("HashAggregate") == 2 and "partial_sum" in text and "SortAggregate" not in text
    # Summed as 64-bit integers: the buffer of a decimal sum would carry an is-empty flag.
    assert "isEmpty" not in text


def test_messages_are_parsed_once(spark):
    messages = spark.read.text(f"{FOLDER}/events.parquet")
    stats = aggregate.aggregate_events(ingest.enrich_events(ingest.parse_events(messages)))
    assert plan(stats).count("from_json(") == 1
    checked = quality.accepted(quality.quarantine_events(messages))
    # Once for every message, and once more inside CASE for those that lack something.
    assert plan(checked).count("from_json(") == 2


def test_repeats_are_matched_on_key_and_position(spark):
    """The row side of the join is spread by position, never by key alone."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        keyed = dedupe.with_record_key(derived.keyed_records(spark, FOLDER), "id", "type")
        text = plan(dedupe.repeated_records(keyed, ["record_key"], "arrival"))
    finally:
        spark.conf.set(key, before)
    assert len(re.findall(r"Exchange hashpartitioning\(record_key#\d+, arrival#\d+", text)) == 2
    by_key = re.findall(r"Exchange hashpartitioning\(record_key#\d+, \d+\)[^\n]*\n[^\n]*HashAggregate[^\n]*partial_min", text)
    assert len(by_key) == 1


def test_stream_writes_without_collecting():
    import inspect

    from campanile.sinks import stats_table as sink
    from campanile.streaming import arrival, repeats, stats_job

    for module in (sink, stats_job, arrival, repeats):
        source = inspect.getsource(module)
        assert ".collect(" not in source and "toPandas" not in source and "localCheckpoint" not in source


@pytest.mark.parametrize("name", ["stats_for_campaign", "stats_in_range", "stats_with_metadata", "campaign_performance_summary",
                                  "campaign_performance_summary_one", "sql_report", "retained_stats", "expired_stats"])
def test_ranges_of_registered_queries_reach_the_event_scan(spark, name):
    text = plan(registry.all_queries()[name](spark, FOLDER))
    assert re.search(r"PushedFilters: \[[^\n]*(GreaterThanOrEqual|LessThan)\(ts,", text)
    assert "one" not in name and "campaign" not in name.split("_")[-1] or "EqualTo(user_id,7)" in text


@pytest.mark.parametrize("name", ["duplicate_records", "first_records", "user_first_events", "insert_ignore"])
def test_first_and_repeated_records_are_hash_aggregations(spark, name):
    assert "SortAggregate" not in plan(registry.all_queries()[name](spark, FOLDER))


def test_the_return_of_recent_days_reads_events_once(spark):
    assert plan(registry.all_queries()["roi_trend_fallback"](spark, FOLDER)).count("FileScan") <= 2  # initial and final plan
