"""Views over the statistics table.

The stored table keeps the key, the count and the spend.  Dimensions, spend and
sales are added here unless the table already has real columns for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from campanile.functions import category_bucket, safe_div
from campanile.schemas import CATEGORIES

# Sales per unit of spend, and the constant dimensions of the view.
SALES_RATE = 0.85
CONSTANT_DIMS = {
    "device_type": "Desktop",
    "country_code": "US",
    "product_brand": "Brand",
    "product_age_group": "25-34",
}
CONSTANT_CATEGORY = 1


def _with_missing(df: DataFrame, **columns: Column) -> DataFrame:
    return df.withColumns({name: c for name, c in columns.items() if name not in df.columns})


def stats_view(stats: DataFrame, sales_rate: float = SALES_RATE, category: Column | None = None) -> DataFrame:
    """Dashboard view: dimensions, ``spend_usd``, sales and conversion counts.

    Columns the table already has are kept; ``category`` fills
    ``product_category_1`` and defaults to a constant.
    """
    rate = F.lit(str(sales_rate)).cast("decimal(9,6)")
    dims = {name: F.lit(value) for name, value in CONSTANT_DIMS.items()}
    dims["product_category_1"] = F.lit(CONSTANT_CATEGORY) if category is None else category
    dims |= {name: F.lit(None).cast("int") for name in CATEGORIES[1:]}
    sold = F.when(F.col("event_type") == "conversion", F.col("event_count")).otherwise(F.lit(0))
    return _with_missing(
        stats,
        **dims,
        spend_usd=F.col("total_bid_amount"),
        total_sales_amount_euro=(F.col("total_bid_amount") * rate).cast("decimal(28,8)"),
        total_sales_count=sold,
    )


def stats_view_by_category(stats: DataFrame, sales_rate: float = SALES_RATE) -> DataFrame:
    """The same view with a category derived from the campaign id."""
    return stats_view(stats, sales_rate, category_bucket(F.col("campaign_id")))


def stats_view_with_ratios(stats: DataFrame) -> DataFrame:
    """Stored columns plus mean bid and return on spend, 0 where undefined."""
    return stats.withColumns({
        "avg_bid_amount": safe_div("total_bid_amount", "event_count"),
        "roi": safe_div("total_sales_amount_euro", "spend_usd"),
    })


def stats_records(stats: DataFrame) -> DataFrame:
    """The five fields a lookup returns."""
    return stats.select(
        "window_start_time", "campaign_id", "event_type", "event_count",
        F.col("total_bid_amount").cast("double").alias("total_bid_amount"),
    )
