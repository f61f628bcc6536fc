from __future__ import annotations

import json

import pytest

from pyspark.sql import Observation, functions as F

from campanile.operators import dedupe, quality
from tests.helpers import messages, plan, rows, table

GOOD = {"timestamp": "2024-01-01T00:00:00Z", "campaign_id": "c", "event_type": "click", "spend_usd": 1}


def without(name):
    return {k: v for k, v in GOOD.items() if k != name}


CASES = {
    json.dumps(GOOD): None,
    "{broken": "malformed json",
    json.dumps(GOOD)[:60]: "malformed json",
    "": "malformed json",
    json.dumps(without("timestamp")): "missing timestamp",
    json.dumps(without("campaign_id")): "missing campaign_id",
    json.dumps(without("event_type")): "missing event_type",
}


def test_presence_rules(spark):
    cases = {**CASES, json.dumps(dict(GOOD, campaign_id=None)): None}
    assert dict(rows(quality.validate_events(messages(spark, *cases)), "value", "reject_reason")) == cases


def test_quarantine_adds_null_and_amount_rules(spark):
    cases = {
        **CASES,
        json.dumps(dict(GOOD, campaign_id=None)): "null campaign_id",
        json.dumps(dict(GOOD, timestamp="not a time")): "null timestamp",
        json.dumps(GOOD).replace('"spend_usd": 1', '"spend_usd": NaN'): "amount out of range",
        json.dumps(dict(GOOD, spend_usd=1e13)): "amount out of range",
        json.dumps(dict(GOOD, spend_usd="text")): None,
    }
    got = quality.quarantine_events(messages(spark, *cases))
    assert dict(rows(got, "value", "reject_reason")) == cases
    assert quality.accepted(got).count() + quality.rejected(got).count() == len(cases)


def test_counters_and_observation(spark):
    checked = quality.validate_events(messages(spark, *CASES))
    assert rows(quality.quality_counts(checked)) == [(1, len(CASES) - 1)]
    seen = Observation("quality")
    ok = F.col("reject_reason").isNull()
    checked.observe(seen, F.count_if(ok).alias("processed"), F.count_if(~ok).alias("failed")).count()
    assert seen.get == {"processed": 1, "failed": len(CASES) - 1}


def test_constraints_report_all_rules_and_pass_nulls(spark):
    df = spark.createDataFrame(
        [("a", 11, 2.0, "standard"), ("b", 1, 0.5, "other"), ("c", None, None, None)],
        "id string, priority int, target_ctr double, campaign_type string",
    )
    rules = {k: v for k, v in quality.METADATA_RULES.items() if v.split()[0] in df.columns}
    assert table(quality.constraint_violations(df, rules), "id", "violations") == [
        ("a", ["priority_in_range", "target_ctr_is_fraction"]), ("b", ["campaign_type_known"]),
    ]


def test_null_keys(spark):
    df = spark.createDataFrame([("a", "x"), (None, "x"), ("b", None)], "campaign_id string, event_type string")
    assert table(quality.null_keys(df, ["campaign_id", "event_type"]), "reject_reason") == [
        ("null campaign_id",), ("null event_type",),
    ]


def records(spark, *pairs):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "seq bigint, id string, type string")
    return dedupe.with_record_key(df, "id", "type")


def test_duplicates_within_one_batch(spark):
    keyed = records(spark, ("101", "A"), ("102", "B"), ("101", "A"))
    assert rows(dedupe.repeated_records(keyed, ["record_key"], "seq"), "record_key") == [("101:A",)]
    assert table(dedupe.duplicate_keys(keyed, ["record_key"])) == [("101:A", 2)]
    assert dedupe.first_records(keyed, ["record_key"], "seq").count() == 2


def test_every_repeat_is_listed_and_flagged(spark):
    keyed = records(spark, ("1", "A"), (" 1", "A "), ("1", "A"), ("2", "A"))
    assert rows(dedupe.repeated_records(keyed, ["record_key"], "seq"), "record_key") == [("1:A",), ("1:A",)]
    flagged = dedupe.flag_repeats(keyed, ["record_key"], "seq")
    assert table(flagged, "seq", "is_repeat") == [(0, False), (1, True), (2, True), (3, False)]


def test_blank_or_missing_keys_are_skipped(spark):
    assert records(spark, ("", "A"), (None, "A"), ("1", "  "), ("1", None)).count() == 0


def test_null_keys_repeat_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "k"), (4, "k")], "seq int, key string")
    assert rows(dedupe.repeated_records(df, ["key"], "seq"), "seq") == [(4,)]
    assert table(dedupe.flag_repeats(df, ["key"], "seq"), "seq", "is_repeat") == [
        (1, False), (2, False), (3, False), (4, True)]


def test_first_record_is_whole(spark):
    df = spark.createDataFrame([(2, "k", "late"), (1, "k", "early")], "seq int, key string, v string")
    assert rows(dedupe.first_records(df, ["key"], "seq"), "key", "v", "seq") == [("k", "early", 1)]


def event(i, **changed):
    return {"event_id": str(i), "timestamp": "2024-01-01T00:00:00Z", "event_name": "click", "attributes": {}, **changed}


def envelope(batch_id, n=1, **changed):
    return {"batch_id": batch_id, "source": "web", "events": [event(i) for i in range(n)], **changed}


def ingest(spark, *values, **limits):
    numbered = messages(spark, *values).coalesce(1).withColumn("seq", F.monotonically_increasing_id())
    return quality.ingest_batches(numbered, "seq", **limits)


def test_batch_rules(spark):
    no_source = envelope("b4")
    del no_source["source"]
    got = ingest(
        spark, envelope("b1"), "{broken", envelope("b1"), envelope("b2", 3), no_source,
        {"source": "web", "events": []}, envelope("b5", events=[event(1, timestamp="whenever")]),
        envelope("b6", events=[event(1, event_name=None)]), envelope("b7", source="x" * 500),
        max_events=2, max_bytes=400,
    )
    found = {r["seq"]: (r["reject_field"], r["reject_reason"]) for r in got.collect()}
    assert found == {
        0: (None, None),
        1: ("body", "malformed json"),
        2: ("batch_id", "duplicate batch"),
        3: ("events", "too many events"),
        4: ("source", "missing"),
        5: ("batch_id", "missing"),
        6: ("events.timestamp", "invalid"),
        7: ("events.event_name", "missing"),
        8: ("body", "payload too large"),
    }


def test_a_bad_batch_does_not_take_its_id(spark):
    got = ingest(spark, envelope("b1", 5), envelope("b1", 1), envelope("b1", 1), max_events=2)
    assert table(got, "seq", "reject_reason") == [(0, "too many events"), (1, None), (2, "duplicate batch")]


def test_default_batch_limit_is_a_thousand_events(spark):
    got = ingest(spark, envelope("b1", 1000), envelope("b2", 1001))
    assert table(got, "seq", "reject_reason") == [(0, None), (1, "too many events")]


@pytest.mark.parametrize("field", ["spend_usd", "sales_amount_euro"])
@pytest.mark.parametrize("value", ['"NaN"', "1e13", "-1e13"])
def test_every_summed_amount_is_checked(spark, field, value):
    """One message with such an amount would stop the aggregation of its whole batch."""
    bad = '{"timestamp":"2024-01-01T10:00:00Z","campaign_id":"c","event_type":"click","%s":%s}' % (field, value)
    checked = quality.quarantine_events(messages(spark, bad)).select("reject_reason").first()
    assert checked.reject_reason == "amount out of range"


def test_positions_are_numbers_in_order_of_files_and_rows(spark, folder):
    path = f"{folder}/some table"
    spark.range(0, 30, 1, 3).selectExpr("id", "id % 4 AS k").write.parquet(path)
    scan = spark.read.parquet(path)
    placed = dedupe.with_position(scan, "arrival")
    assert dict(placed.dtypes)["arrival"] == "bigint" and placed.columns == ["id", "k", "arrival"]
    got = [r.id for r in placed.orderBy("arrival").collect()]
    other = dedupe.with_position(scan, "arrival", max_files=0)
    assert got == [r.id for r in other.orderBy("arrival").collect()] == sorted(got)
    firsts = table(dedupe.first_records(placed, ["k"], "arrival"), "k", "id")
    assert firsts == table(dedupe.first_records(other, ["k"], "arrival"), "k", "id") == [(0, 0), (1, 1), (2, 2), (3, 3)]
    text = plan(dedupe.first_records(placed, ["k"], "arrival"))
    assert "SortAggregate" not in text and "SortAggregate" in plan(dedupe.first_records(other, ["k"], "arrival"))


def test_first_records_keep_a_row_of_the_null_key(spark):
    df = spark.createDataFrame([(None, 2, "late"), (None, 1, "early"), ("a", 3, "x")], "k string, seq bigint, v string")
    assert table(dedupe.first_records(df, ["k"], "seq"), "k", "v") == [("a", "x"), (None, "early")]
