from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from campanile import schemas
from campanile.functions import ctr_tier, from_micros, in_percent, in_thousands, micros, performance_score, rounded_ratio, safe_div
from campanile.plans import health, reports
from campanile.plans import registry
from campanile.plans.top_campaigns import top_campaigns
from tests.helpers import at, rows, stats_frame, stats_row, table

BIG = 150_000


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_safe_division(spark):
    n = lambda v: F.lit(v).cast("double")
    assert one(spark, safe_div(n(1), n(4)), safe_div(n(1), n(4), 100), safe_div(n(1), n(0)), safe_div(n(1), n(None)),
               safe_div(n(None), n(2)), safe_div(n(1), n(-2))) == (0.25, 25.0, 0.0, 0.0, None, 0.0)


def test_micros_equal_the_decimal_cast(spark):
    values = [0.1, 1234567.891234, -2.5, 0.0000005, -0.0000005, 1.0000005, 2.0000015, 9_000_000_000.123456, 99999999.1234567,
              999_999_999_999.25, 0.0, None, 2.3000000000000003, 100000000.0000005]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for got, expected in rows(df, from_micros(micros("v")), F.col("v").cast("decimal(18,6)")):
        assert got == expected


@pytest.mark.parametrize("value", [float("nan"), float("inf"), 1e13])
def test_micros_of_unfit_amounts_raise(spark, value):
    df = spark.createDataFrame([(value,)], "v double")
    with pytest.raises(Exception, match="CAST|NUMERIC"):
        df.select(from_micros(F.sum(micros("v")))).collect()


def test_rounded_ratio_is_exact_at_ties(spark):
    cases = [("985777.95", 6, 164296.33), ("1096370.17", 2, 548185.09), ("1004999.6", 1000000, 1.0), ("-0.005", 1, -0.01),
             ("1", 3, 0.33), ("2", 3, 0.67), ("0", 5, 0.0), ("1", 0, None), (None, 1, None), ("1e15", 7, 142857142857142.86)]
    df = spark.createDataFrame([(n and Decimal(n), d, e) for n, d, e in cases], "n decimal(28,6), d bigint, e double")
    got = rows(df.select(rounded_ratio(F.col("n"), F.col("d"), 2), "e"))
    assert [g for g, _ in got] == [e for _, e in got]
    assert one(spark, in_thousands(F.lit(1004.9996)), in_thousands(F.lit(1005.0))) == (1.0, 1.01)


def test_tiers_and_display(spark):
    assert one(spark, *[ctr_tier(F.lit(v)) for v in (0.05, 0.0499, 0.03, 0.015, 0.0149, 0.0)]) == (
        "Excellent", "Good", "Good", "Average", "Below Average", "Below Average")
    assert one(spark, in_thousands(F.lit(Decimal("1235"))), in_percent(F.lit(0.25))) == (1.24, 25.0)


def test_score_caps_the_cost_term(spark):
    score = lambda spend, conv: performance_score(F.lit(0.1), F.lit(0.2), F.lit(spend), F.lit(conv))
    assert one(spark, score(50.0, 10), score(5000.0, 10), score(5000.0, 0)) == (1.12, 20.12, 20.12)


@pytest.fixture(scope="module")
def stats(spark):
    return stats_frame(
        spark,
        stats_row("a", "impression", BIG, 100, device="TV", brand="x", age="25-34", category=1),
        stats_row("a", "click", BIG // 2, 50, device="TV", brand="x", age="25-34", category=1),
        stats_row("a", "conversion", 10, 50, sales=400, device="TV", brand="x", age="25-34", category=1),
        stats_row("b", "impression", 10, 5, device="Unknown", brand="y", age="55+", category=2,
                  start="2024-01-02 10:00:00"),
        stats_row("c", "click", 4, 0, sales=10, start="2024-01-02 11:00:00"),
        stats_row("d", "signup", 9, 7, start="2024-01-03 00:00:00", device="Phone"),
    )


def test_platform_kpis(stats):
    (row,) = reports.platform_kpis(stats).collect()
    assert (row["impressions"], row["clicks"], row["conversions"]) == (BIG + 10, BIG // 2 + 4, 10)
    assert (row["spend_usd"], row["revenue_euro"]) == (212.0, 410.0)
    assert row["ctr"] == (BIG // 2 + 4) / (BIG + 10)
    assert (row["roas"], row["cpa"]) == (410 / 212, 21.2)
    assert row["conversion_rate"] == 10 / (BIG // 2 + 4)


def test_kpis_of_nothing_are_zero(stats):
    assert rows(reports.platform_kpis(stats.limit(0))) == [(0, 0, 0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)]
    assert rows(reports.basic_kpis(stats.limit(0))) == [(0, 0, 0, 0.0)]
    assert rows(reports.advertiser_metrics(stats.limit(0))) == [(0.0, 0.0, 0.0)]


def test_dashboard_kpis_in_percent(stats):
    (row,) = reports.dashboard_kpis(stats).collect()
    assert row["ctr"] == (BIG // 2 + 4) / (BIG + 10) * 100
    assert row["spend_thousands"] == 0.21


def test_roi_trend(stats):
    assert rows(reports.roi_trend(stats)) == [
        (date(2024, 1, 1), 2.0), (date(2024, 1, 2), 2.0), (date(2024, 1, 3), 0.0),
    ]
    assert rows(reports.roi_trend_rounded(stats))[0] == ("2024-01-01", 2.0)


def test_roi_range_and_fallback(stats):
    def days(as_of, **options):
        return [r["day"].day for r in reports.roi_trend(stats, as_of, days=90, **options).collect()]

    assert days("2024-04-01 10:30:00", fallback_all=True) == [2, 3]
    assert days("2024-04-01 10:30:00") == [2, 3]
    assert days("2025-01-01 00:00:00", fallback_all=True) == [1, 2, 3]
    assert days("2025-01-01 00:00:00") == []
    # A row exactly at the limit is out of range.
    assert days("2024-04-02 00:00:00", fallback_all=True) == [1, 2, 3]
    assert rows(reports.roi_trend(stats.limit(0), "2024-01-01 00:00:00", fallback_all=True)) == []


def test_roi_of_bids(stats):
    assert rows(reports.roi_trend_bid(stats)) == [
        (date(2024, 1, 1), 0.5), (date(2024, 1, 2), 0.0), (date(2024, 1, 3), None),
    ]


def test_campaign_performance_nulls(stats):
    got = {r["campaign_id"]: r["ctr"] for r in reports.campaign_performance(stats).collect()}
    # Impressions without a click row: NULL; no impressions: 0.
    assert got == {"a": 50.0, "b": None, "c": 0.0, "d": 0.0}


def test_top_by_spend_and_ties(spark, stats):
    got = reports.top_campaigns_by_spend(stats, 2)
    assert rows(got, "campaign_id", "spend_usd", "ctr") == [("a", 200.0, 50.0), ("d", 7.0, 0.0)]
    tied = stats_frame(spark, *[stats_row(c, "click", 1, 5) for c in "zyxw"])
    assert rows(reports.top_campaigns_by_spend(tied, 2), "campaign_id") == [("w",), ("x",)]
    assert rows(reports.top_stats_rows(tied, 3), "campaign_id") == [("w",), ("x",), ("y",)]


def test_efficiency_needs_spend(stats):
    got = reports.campaign_efficiency(stats)
    assert rows(got, "campaign_id", "roi", "roi_percent", "conversions", "conversion_rate") == [
        ("a", 2.0, 200.0, 10, 10 / (BIG // 2) * 100), ("d", 0.0, 0.0, 0, 0.0), ("b", 0.0, 0.0, 0, 0.0),
    ]


@pytest.fixture(scope="module")
def performance(spark):
    return spark.createDataFrame(
        [("star", 100, 100, 90, 80.0, 1.0), ("mark", 1, 1, 1, 90.0, 1.0), ("cow", 1, 1, 10, 10.0, 0.0),
         ("pet", 1, 1, 1, 10.0, 2.0), ("none", 1, 1, 0, 50.0, 3.0), ("free", 1, 1, 5, 0.0, 4.0)],
        "campaign_id string, impressions bigint, clicks bigint, conversions bigint, spend_usd double, ctr double",
    )


def test_quadrants(performance):
    got = reports.campaign_quadrants(performance)
    assert table(got, "campaign_id", "quadrant") == [
        ("cow", "Cash Cows"), ("mark", "Question Marks"), ("pet", "Pets"), ("star", "Stars"),
    ]
    assert {r["mean_spend"] for r in got.collect()} == {47.5}


def test_assumed_return(performance):
    assert rows(reports.campaign_roas(performance, top=2), "campaign_id", "roas") == [("star", 56.25), ("cow", 50.0)]
    assert rows(reports.campaign_roas(performance).filter("campaign_id = 'free'"), "roas") == [(0.0,)]


def test_cost_map_and_converting(performance):
    assert table(reports.cpa_ctr_map(performance), "campaign_id") == [("mark",), ("pet",), ("star",)]
    assert reports.converting_campaigns(performance).count() == 5


def test_devices(stats):
    assert rows(reports.performance_by_device(stats), "device_type", "total_revenue", "conversion_rate") == [
        ("TV", 400.0, 10 / (BIG // 2)), ("Phone", 0.0, 0.0), ("Unknown", 0.0, 0.0),
    ]
    # NULL and the label Unknown are one group.
    assert rows(reports.dashboard_by_device(stats), "device_type", "total_revenue", "conversion_rate") == [
        ("TV", 400.0, 10 / (BIG // 2) * 100), ("Unknown", 10.0, 0.0), ("Phone", 0.0, 0.0),
    ]


def test_device_rate_is_null_without_conversions(spark):
    stats = stats_frame(spark, stats_row("a", "click", 5, 1, device="TV"))
    assert rows(reports.performance_by_device(stats), "conversion_rate") == [(None,)]
    assert rows(reports.dashboard_by_device(stats), "conversion_rate") == [(0.0,)]


def test_revenue_by_dimension(stats):
    assert rows(reports.revenue_by(stats, "product_category_1")) == [(1, 400.0), (2, 0.0)]
    assert rows(reports.revenue_by(stats, "product_brand", top=1)) == [("x", 400.0)]
    assert rows(reports.revenue_by(stats, "product_brand", unknown="Unknown")) == [
        ("x", 400.0), ("Unknown", 10.0), ("y", 0.0),
    ]


def test_age_groups_in_order(stats):
    got = rows(reports.dashboard_by_age_group(stats))
    assert got == [("25-34", 400.0, 50.0), ("55+", 0.0, 0.0), ("Unknown", 10.0, 0.0)]


def test_shares_sum_to_one(spark, stats):
    shared = reports.with_share(reports.revenue_by(stats, "product_brand", unknown="Unknown"), "total_revenue")
    assert [round(r["share"], 4) for r in shared.collect()] == [0.9756, 0.0244, 0.0]
    nothing = reports.with_share(spark.createDataFrame([("a", 0.0)], "k string, v double"), "v")
    assert rows(nothing) == [("a", 0.0, 0.0)]


def hourly(spark, *facts):
    return spark.createDataFrame(
        [(at(h), c, "p", country, i, cl, cv, Decimal(str(s))) for h, c, country, i, cl, cv, s in facts], schemas.HOURLY)


DAY = ("2024-07-15 00:00:00", "2024-07-16 00:00:00")
NOON = "2024-07-15 12:00:00"


def test_top_campaigns_per_country(spark):
    facts = [(NOON, f"c{i}", "US", 1000, i * 10, 1, 10) for i in range(1, 6)]
    facts += [
        (NOON, "few", "US", 99, 99, 1, 1),                         # under the volume threshold
        (NOON, "none", "US", 0, 0, 0, 0),                          # no impressions
        (NOON, "neg", "US", -5, 9, 9, 9),                          # unusable row
        (NOON, "lost", None, 1000, 50, 0, 5000),                   # no country
        (NOON, None, "US", 1000, 999, 1, 1),                       # no campaign
        ("2024-07-16 00:00:00", "next", "US", 1000, 999, 1, 1),    # next day
        ("2024-07-15 00:00:00", "c5", "US", 1000, 50, 1, 10),
    ]
    got = top_campaigns(hourly(spark, *facts), *DAY)
    assert rows(got, "country_code", "campaign_id", "rank_in_country", "ctr_percentage", "hourly_records_count",
                "ctr_performance_tier") == [
        ("UNKNOWN", "lost", 1, 5.0, 1, "Excellent"),
        ("US", "c5", 1, 5.0, 2, "Excellent"),
        ("US", "c4", 2, 4.0, 1, "Good"),
        ("US", "c3", 3, 3.0, 1, "Good"),
    ]
    lost = got.filter("campaign_id = 'lost'").first()
    assert (lost["cost_per_conversion"], lost["performance_score"], lost["report_date"]) == (0.0, 20.02, "2024-07-15")
    assert "report_generated_at" in top_campaigns(hourly(spark, *facts), *DAY, stamp=True).columns


def test_top_campaigns_of_all_time_leave_no_year_out(spark):
    facts = [(f"{year}-07-15 12:00:00", f"c{year}", "US", 1000, 10, 1, 10) for year in (1990, 1997, 2030)]
    assert sorted(r.campaign_id for r in top_campaigns(hourly(spark, *facts)).collect()) == ["c1990", "c1997", "c2030"]
    assert [r.campaign_id for r in top_campaigns(hourly(spark, *facts), start="1997-01-01").collect()] == ["c1997", "c2030"]


def moved(spark, folder, name, column, stretch):
    """A folder of the smallest tables, with the times of one table moved."""
    for other in ("orders", "customer", "nation", "lineitem", "events"):
        rows = spark.read.parquet(f"/root/testdata/sf0.001/{other}.parquet")
        (rows.withColumn(column, F.expr(stretch)) if other == name else rows).write.parquet(f"{folder}/{other}.parquet")
    return folder


def test_all_time_query_counts_orders_of_any_year(spark, folder):
    query = registry.all_queries()["top_campaigns_by_country_all_time"]
    names = ("country_code", "campaign_id", "total_impressions")
    wanted = rows(query(spark, "/root/testdata/sf0.001"), *names)
    place = moved(spark, folder, "orders", "o_orderdate", "o_orderdate - INTERVAL '30' YEAR")
    assert rows(query(spark, place), *names) == wanted != []


def test_triggers_count_events_over_more_than_the_watermark(spark, folder):
    place = moved(spark, folder, "events", "ts", "ts + make_dt_interval(event_id % 40 * 30)")
    got = registry.all_queries()["stream_stats_over_triggers"](spark, place)
    assert got.agg(F.sum("event_count")).first()[0] == 1000


def test_top_campaigns_ties_and_large_counts(spark):
    facts = [(NOON, c, "US", 400_000, 200_000, 100_000, "1.005") for c in "dcba"]
    got = top_campaigns(hourly(spark, *facts), *DAY)
    assert rows(got, "campaign_id", "ctr_percentage", "conversion_rate_percentage") == [
        ("a", 50.0, 50.0), ("b", 50.0, 50.0), ("c", 50.0, 50.0),
    ]


def runs(spark, *facts):
    made = [(at(t), "p", str(i), s, Decimal(str(sec)), 1, 0, fresh, Decimal(q), None)
            for i, (t, s, sec, fresh, q) in enumerate(facts)]
    return spark.createDataFrame(made, schemas.RUNS)


def test_health(spark):
    df = runs(
        spark, ("2024-01-02 01:00:00", "success", 1, 59, 90), ("2024-01-02 02:00:00", "failed", 2, 119, 100),
        ("2024-01-03 00:00:00", "success", 5, 10, 80), ("2023-12-01 00:00:00", "failed", 5, 10, 80),
    )
    daily = health.run_health(df, "2024-01-31 00:00:00")
    assert rows(daily) == [
        (date(2024, 1, 2), 1.5, 2, 50.0, 1, 95.0), (date(2024, 1, 3), 5.0, 1, 100.0, 0, 80.0),
    ]
    roi = spark.createDataFrame([(date(2024, 1, 2), 3.0)], "day date, roi double")
    assert rows(health.health_vs_roi(daily, roi, 1), "day", "roi") == [(date(2024, 1, 3), None)]
    assert rows(health.root_cause_point(daily, roi)) == [(date(2024, 1, 2), 50.0, 1, 95.0, 3.0)]
    stats = stats_frame(spark, stats_row("a", "click", 1, 1))
    assert rows(health.health_summary(stats, df, "2024-01-01 10:00:10")) == [(10, 50.0, 87.5)]
    assert rows(health.health_summary(stats.limit(0), df, "2024-01-01 10:00:10"))[0][0] == 9999
