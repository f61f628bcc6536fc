from __future__ import annotations

from pyspark.sql import functions as F

from campanile.operators import ingest
from campanile.sources import click_log, events as sources
from campanile.sources.tables import run_sql
from tests.helpers import at, messages, rows, table

FIELDS = ("event_timestamp", "campaign_id", "event_type", "spend_usd", "bid_amount_usd")


def log_line(**changed):
    fields = dict(
        sale="1", sales_amount_euro="12.5", time_delay_conv="60", click_timestamp="1598891494", nb_clicks_week="3",
        product_price="20", product_age_group="-1", device_type="-1", audience_id="a", product_gender="f",
        product_brand="b", product_category_1="1", product_category_2="-1", product_category_3="",
        product_category_4="x", product_category_5="5", product_category_6="6", product_category_7="7",
        product_country="-1", product_id="p", product_title="t", partner_id="partner", user_id="user",
    )
    fields.update(changed)
    return "\t".join(fields.values())


def test_parse_events_types_and_gaps(spark):
    df = messages(
        spark,
        {"timestamp": "2024-07-28T10:00:10.000Z", "campaign_id": "c", "event_type": "click", "bid_amount_usd": 0.5,
         "other": 1},
        {"timestamp": "2024-07-28T12:00:10+02:00", "campaign_id": "d", "event_type": "click", "spend_usd": 2},
        "{broken",
    )
    assert rows(ingest.parse_events(df), *FIELDS) == [
        (at("2024-07-28 10:00:10"), "c", "click", None, 0.5),
        (at("2024-07-28 10:00:10"), "d", "click", 2.0, None),
        (None, None, None, None, None),
    ]


def test_enrich_fills_and_settles_spend(spark):
    df = messages(spark, {"spend_usd": 1.5, "bid_amount_usd": 9}, {"bid_amount_usd": 2}, {"device_type": "TV"})
    got = ingest.enrich_events(ingest.parse_events(df))
    assert rows(got, "total_bid_amount", "device_type", "country_code", "product_category_7", "sales_amount_euro",
                "sale") == [
        (1.5, "unknown", "unknown", 0, 0.0, False),
        (2.0, "unknown", "unknown", 0, 0.0, False),
        (0.0, "TV", "unknown", 0, 0.0, False),
    ]


def click_events(spark, *lines):
    return click_log.click_log_events(click_log.split_click_log(messages(spark, *lines)))


def test_click_log_keeps_and_drops_rows(spark):
    got = click_events(
        spark,
        log_line(),
        log_line(partner_id="-1"),
        log_line(user_id="-1"),
        log_line(click_timestamp="-1"),
        log_line(click_timestamp="soon"),
        log_line().rsplit("\t", 1)[0],
        log_line(partner_id="other") + "\textra",
    )
    assert table(got, "campaign_id") == [("other",), ("partner",)]


def test_click_log_values(spark):
    (row,) = click_events(spark, log_line()).collect()
    assert row["timestamp"] == at("2020-08-31 16:31:34")
    assert (row["spend_usd"], row["product_price"], row["sale"]) == (12.5, 20.0, True)
    # Text keeps the missing mark, numbers do not.
    assert (row["device_type"], row["country_code"], row["product_age_group"]) == ("-1", "-1", "-1")
    assert [row[f"product_category_{i}"] for i in range(1, 8)] == [1, None, None, None, 5, 6, 7]
    assert (row["time_delay_for_conversion"], row["nb_clicks_1week"], row["audience_id"]) == (60, 3, "a")


def test_click_log_spend_falls_back_to_price(spark):
    got = click_events(
        spark, log_line(sales_amount_euro="-1"), log_line(sales_amount_euro="0"),
        log_line(sales_amount_euro="n/a", product_price="n/a"), log_line(sale="x", sales_amount_euro="-1"),
    )
    assert rows(got, "spend_usd", "sale") == [(20.0, True), (20.0, True), (0.0, True), (20.0, False)]


def test_fan_out_of_sale_and_click(spark):
    lines = messages(spark, log_line(partner_id="s"), log_line(partner_id="c", sale="0", sales_amount_euro="-1"))
    assert table(click_log.expand_click_log(lines), "campaign_id", "event_type", "spend_usd") == [
        ("c", "click", 20.0), ("c", "impression", 2.0), ("s", "conversion", 12.5), ("s", "impression", 1.25),
    ]


def test_click_log_from_file(spark, folder):
    with open(f"{folder}/log.tsv", "w") as f:
        f.write(log_line() + "\n" + log_line(user_id="-1") + "\n")
    assert click_log.expand_click_log(click_log.read_click_log(spark, f"{folder}/log.tsv")).count() == 2


ENVELOPE = {
    "batch_id": "b1", "source": "web",
    "events": [
        {"event_id": "e1", "timestamp": "2024-01-01T00:00:00Z", "event_name": "click", "attributes": {"ad": 7}},
        {"event_id": "e2", "timestamp": "2024-01-01T00:00:01Z", "event_name": "view", "attributes": {}},
    ],
}


def test_event_batches_explode_and_pack(spark):
    batches = ingest.parse_event_batches(messages(spark, ENVELOPE))
    exploded = ingest.explode_event_batches(batches)
    assert rows(exploded, "batch_id", "source", "event_id", "event_name", F.col("attributes")["ad"]) == [
        ("b1", "web", "e1", "click", "7"), ("b1", "web", "e2", "view", None),
    ]
    again = ingest.parse_event_batches(ingest.pack_event_batches(batches))
    assert rows(ingest.explode_event_batches(again)) == rows(exploded)


def test_events_from_json_lines(spark, folder):
    with open(f"{folder}/events.jsonl", "w") as f:
        f.write('{"timestamp":"2024-07-28T10:00:10Z","campaign_id":"c","event_type":"click","bid_amount_usd":1}\n')
    df = sources.read_events_json(spark, folder)
    assert rows(df, "timestamp", "campaign_id", "bid_amount_usd", "device_type") == [
        (at("2024-07-28 10:00:10"), "c", 1.0, None)
    ]


def test_generated_events_have_the_event_schema(spark):
    rate = spark.range(6).select(F.lit("2024-01-01").cast("timestamp").alias("timestamp"), F.col("id").alias("value"))
    made = sources.generated_events(rate, campaigns=2)
    assert table(made, "campaign_id", "event_type")[0] == ("campaign_0", "click")
    assert ingest.enrich_events(made).count() == 6
    assert sources.generated_event_stream(spark).isStreaming


def test_preview_limits_rows(spark):
    assert rows(sources.preview(spark.range(100), 3, "id")) == [(0,), (1,), (2,)]


def test_sql_with_parameters(spark):
    got = run_sql(spark, "SELECT id FROM {t} WHERE id >= :low", {"t": spark.range(5)}, low=3)
    assert table(got) == [(3,), (4,)]
