"""One key holding a third or more of all rows: results stay whole."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from campanile.operators import aggregate, dedupe, lookup, maintenance, quality
from campanile.plans import reports
from campanile.plans.top_campaigns import top_campaigns
from tests.helpers import rows, table

ROWS = 60_000


@pytest.fixture(scope="module")
def hot(spark):
    """Half of all rows share one key, the rest have two rows each."""
    n = F.col("id")
    return spark.range(0, ROWS, 1, 16).select(
        n.alias("seq"), F.when(n % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.floor(n / 4))).alias("key"))


def test_repeats_of_a_hot_key(hot):
    repeats = dedupe.repeated_records(hot, ["key"], "seq")
    assert repeats.filter("key = 'hot'").count() == ROWS // 2 - 1
    assert repeats.count() == ROWS - hot.select("key").distinct().count()
    assert repeats.filter("seq = 0").count() == 0


def test_row_side_of_the_repeat_join_is_spread(spark, hot):
    """Hashing key and position gives the hot key to all partitions evenly."""
    sizes = [r["count"] for r in hot.filter("key = 'hot'").withColumn(
        "p", F.pmod(F.hash("key", "seq"), F.lit(8))).groupBy("p").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1.2 * min(sizes)


def test_first_of_a_hot_key(hot):
    firsts = dedupe.first_records(hot.withColumn("v", F.col("seq") * 2), ["key"], "seq")
    assert rows(firsts.filter("key = 'hot'"), "v", "seq") == [(0, 0)]


def test_insert_ignore_with_a_hot_key(spark, hot):
    base = spark.createDataFrame([("k0",)], "key string")
    got = maintenance.insert_ignore(base, hot.select("key", "seq"), ["key"], "seq")
    assert got.count() == hot.select("key").distinct().count()


def stats(hot):
    return hot.select(
        F.col("key").alias("campaign_id"), F.lit("click").alias("event_type"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("seq") % 60).alias("window_start_time"),
        F.timestamp_seconds(F.lit(1_704_067_260)).alias("window_end_time"),
        F.lit(1).cast("bigint").alias("event_count"), F.lit("1.000001").cast("decimal(18,6)").alias("total_bid_amount"),
    )


def test_totals_of_a_hot_campaign(hot):
    summary = aggregate.campaign_summary(stats(hot)).filter("campaign_id = 'hot'").first()
    assert summary["total_events"] == ROWS // 2 and float(summary["total_bid_amount"]) == ROWS // 2 * 1.000001


def test_hot_campaign_joins_its_metadata_without_broadcast(spark, hot, folder):
    hot.select("key").distinct().select(
        F.col("key").alias("campaign_id"), F.lit(True).alias("is_active"), F.lit(None).cast("date").alias("end_date"),
    ).write.parquet(f"{folder}/meta")
    meta = spark.read.parquet(f"{folder}/meta")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = lookup.stats_with_metadata(stats(hot), meta, "2024-01-01", "2024-01-02", as_of="2024-01-01")
        inner = stats(hot).join(meta, "campaign_id")
        assert joined.count() == ROWS
        inner.collect()
        assert "skew=true" in inner._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_country_with_most_campaigns(spark):
    n = F.col("id")
    hourly = spark.range(0, ROWS, 1, 16).select(
        F.lit("2024-07-15 12:00:00").cast("timestamp").alias("hour_timestamp"),
        F.concat(F.lit("c"), F.lpad(n.cast("string"), 6, "0")).alias("campaign_id"), F.lit("p").alias("publisher_id"),
        F.when(n % 3 < 2, "US").otherwise(F.concat(F.lit("X"), n % 7)).alias("country_code"),
        F.lit(1000).cast("bigint").alias("impressions"), (n % 1000).alias("clicks"), F.lit(1).cast("bigint").alias("conversions"),
        F.lit("1").cast("decimal(18,6)").alias("spend_usd"),
    )
    top = top_campaigns(hourly, "2024-07-15", "2024-07-16")
    best = hourly.filter("country_code = 'US'").orderBy(F.desc("clicks"), "campaign_id").limit(3)
    assert rows(top.filter("country_code = 'US'"), "campaign_id") == rows(best, "campaign_id")
    assert top.groupBy("country_code").count().filter("count <> 3").count() == 0


def test_repeated_batch_id_sent_by_everyone(spark):
    values = spark.range(0, 9000, 1, 8).select(
        F.to_json(F.struct(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("b"), "id")).alias("batch_id"),
            F.lit("s").alias("source"), F.array().cast("array<struct<event_id:string>>").alias("events"))).alias("value"),
        F.col("id").alias("seq"))
    judged = quality.ingest_batches(values, "seq")
    assert table(judged.groupBy("reject_reason").count()) == [("duplicate batch", 2999), (None, 6001)]
    assert rows(quality.accepted(judged).filter("batch_id = 'hot'"), "seq") == [(0,)]


def test_share_of_a_hot_brand(hot):
    revenue = reports.revenue_by(
        hot.select(F.col("key").alias("brand"), F.lit("1").cast("decimal(18,6)").alias("total_sales_amount_euro")), "brand")
    shared = reports.with_share(revenue, "total_revenue")
    assert shared.first()["share"] == 0.5
    assert abs(shared.agg(F.sum("share")).first()[0] - 1) < 1e-9
