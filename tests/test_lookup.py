from __future__ import annotations

from decimal import Decimal

import pytest

from campanile import schemas
from campanile.operators import lookup, views
from tests.helpers import at, rows, stats_frame, stats_row, table


@pytest.fixture(scope="module")
def stats(spark):
    one = dict(start="2025-01-01 10:00:00", end="2025-01-01 10:01:00")
    return stats_frame(
        spark,
        stats_row("test_campaign_001", "impression", 1000, 50, **one),
        stats_row("test_campaign_001", "click", 50, 25, **one),
        stats_row("test_campaign_002", "impression", 2000, 100, **one),
    )


def meta_row(campaign, active=True, end=None, priority=1, name=None, advertiser="adv_1"):
    return (campaign, name or f"name {campaign}", advertiser, "Advertiser", "Tech", None, at("2025-01-01").date(),
            end and at(end).date(), Decimal("100"), Decimal("0.0400"), Decimal("10"), active, "standard", priority,
            None, None)


@pytest.fixture(scope="module")
def meta(spark):
    return spark.createDataFrame(
        [
            meta_row("test_campaign_001", priority=2),
            meta_row("test_campaign_002", active=False),
            meta_row("ended", end="2025-01-14", priority=1),
            meta_row("ends_today", end="2025-01-15", priority=2, name="a"),
            meta_row("elsewhere", advertiser="adv_2"),
        ],
        schemas.METADATA,
    )


def test_campaign_series(stats):
    got = lookup.stats_for_campaign(stats, "test_campaign_001", "2025-01-01 09:00:00", "2025-01-01 11:00:00")
    assert got.columns == ["window_start_time", "campaign_id", "event_type", "event_count", "total_bid_amount"]
    assert table(got, "event_type", "event_count", "total_bid_amount") == [
        ("click", 50, 25.0), ("impression", 1000, 50.0),
    ]
    assert lookup.stats_for_campaign(stats, "nobody", "2025-01-01", "2025-01-02").count() == 0


def test_range_is_half_open_and_checked(stats):
    assert lookup.in_window(stats, "2025-01-01 10:00:00", "2025-01-01 10:00:01").count() == 3
    assert lookup.in_window(stats, "2025-01-01 09:00:00", "2025-01-01 10:00:00").count() == 0
    with pytest.raises(ValueError):
        lookup.in_window(stats, "2025-01-02", "2025-01-01")
    with pytest.raises(ValueError):
        lookup.stats_in_range(stats, "2025-01-02", "2025-01-01")


def test_windows_wholly_inside(stats):
    assert lookup.stats_in_range(stats, "2025-01-01 10:00:00", "2025-01-01 10:01:00").count() == 3
    assert lookup.stats_in_range(stats, "2025-01-01 10:00:00", "2025-01-01 10:00:59").count() == 0


def test_equality_filters(stats):
    assert lookup.stats_where(stats, event_type="click").count() == 1
    assert lookup.stats_where(stats, event_type="impression", campaign_id="test_campaign_002").count() == 1


def test_look_back_excludes_its_limit(stats):
    assert lookup.newer_than(stats, "2025-01-31 10:00:00", 30).count() == 0
    assert lookup.newer_than(stats, "2025-01-31 09:59:59", 30).count() == 3


def test_active_campaigns(meta):
    assert table(lookup.active_campaigns(meta, "2025-01-15"), "campaign_id") == [
        ("elsewhere",), ("ends_today",), ("test_campaign_001",),
    ]
    assert rows(lookup.advertiser_campaigns(meta, "adv_1", "2025-01-15"), "campaign_id") == [
        ("ends_today",), ("test_campaign_001",),
    ]


def test_join_keeps_active_campaigns_only(stats, meta):
    got = lookup.stats_with_metadata(stats, meta, "2025-01-01", "2025-01-02", as_of="2025-01-15")
    assert table(got, "campaign_id", "event_type") == [
        ("test_campaign_001", "click"), ("test_campaign_001", "impression"),
    ]


def summary(stats, meta, campaign, start="2025-01-01", end="2025-01-02"):
    return lookup.campaign_performance_summary(stats, meta, start, end, campaign).collect()


def test_performance_summary(stats, meta):
    (row,) = summary(stats, meta, "test_campaign_001")
    assert (row["total_impressions"], row["total_clicks"], row["total_conversions"]) == (1000, 50, 0)
    assert (row["total_spend"], row["actual_ctr"], row["actual_cpa"], row["conversion_rate"]) == (75.0, 0.05, 0.0, 0.0)
    assert (row["meets_target_ctr"], row["meets_target_cpa"], row["budget_used"]) == (True, False, 0.75)


def test_performance_summary_without_stats_or_metadata(stats, meta):
    (row,) = summary(stats, meta, "test_campaign_001", "2024-01-01", "2024-01-02")
    assert (row["total_impressions"], row["total_spend"], row["actual_ctr"]) == (0, 0.0, 0.0)
    assert summary(stats, meta, "unknown") == []


def test_views_fill_only_what_is_missing(spark, stats):
    stored = stats.select(*schemas.STATS.names)
    (row,) = views.stats_view(stored).filter("event_type = 'click'").collect()
    assert (row["device_type"], row["product_category_1"], row["product_category_2"]) == ("Desktop", 1, None)
    assert (row["spend_usd"], row["total_sales_amount_euro"], row["total_sales_count"]) == (25, Decimal("21.25"), 0)
    kept = views.stats_view(stats_frame(spark, stats_row("c", "conversion", 3, 10, sales=99, device="TV")))
    (row,) = kept.collect()
    assert (row["device_type"], row["total_sales_amount_euro"], row["total_sales_count"]) == ("TV", 99, 3)


def test_category_by_first_character(spark):
    ids = ["d", "e", "f", "g", "h", "campaign"]  # 100 .. 104, and 99
    stats = stats_frame(spark, *[stats_row(i, "click", 1, 1) for i in ids]).select(*schemas.STATS.names)
    got = dict(rows(views.stats_view_by_category(stats), "campaign_id", "product_category_1"))
    assert got == dict(zip(ids, ["Electronics", "Clothing", "Home", "Sports", "Beauty", "Beauty"]))


def test_ratios_of_empty_windows(spark):
    got = views.stats_view_with_ratios(stats_frame(
        spark, stats_row("a", "click", 0, 0, sales=5), stats_row("b", "click", 2, 5, sales=10)))
    assert table(got, "campaign_id", "avg_bid_amount", "roi") == [("a", 0.0, 0.0), ("b", 2.5, 2.0)]
