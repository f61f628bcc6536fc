"""Raw click log: tab-separated lines turned into ad events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from campanile.functions import with_parsed
from campanile.schemas import CATEGORIES, CLICK_LOG_COLUMNS

MISSING = "-1"
IMPRESSION_SPEND_SHARE = 0.1
# Range of a calendar timestamp, years 1 to 9999, in epoch seconds.
EPOCH_MIN, EPOCH_MAX = -62_135_596_800, 253_402_300_799


def read_click_log(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the log as one string column ``value``."""
    return spark.read.text(path)


def split_click_log(lines: DataFrame) -> DataFrame:
    """Named text columns; lines with too few columns are skipped.

    The CSV reader would pad short lines with NULL, so lines are split here.
    """
    parts = with_parsed(lines, "p", F.split("value", "\t"))
    kept = parts.filter(F.size("p") >= len(CLICK_LOG_COLUMNS))
    return kept.select(*[F.col("p")[i].alias(name) for i, name in enumerate(CLICK_LOG_COLUMNS)])


def _cast(name: str, kind: str) -> Column:
    """NULL when the field is missing, empty or not of the type."""
    text = F.col(name)
    return F.when((text != MISSING) & (text != ""), F.trim(text)).try_cast(kind)


def click_log_events(rows: DataFrame) -> DataFrame:
    """One base event per usable log row.

    Rows without partner, user or click time are dropped.  Only numeric fields
    treat ``-1`` as missing; text fields keep it.
    """
    sales = F.coalesce(_cast("sales_amount_euro", "double"), F.lit(0.0))
    price = F.coalesce(_cast("product_price", "double"), F.lit(0.0))
    typed = rows.withColumn("click_epoch", _cast("click_timestamp", "bigint")).filter(
        (F.col("partner_id") != MISSING)
        & (F.col("user_id") != MISSING)
        & F.col("click_epoch").between(EPOCH_MIN, EPOCH_MAX)
    )
    return typed.select(
        F.timestamp_seconds("click_epoch").alias("timestamp"),
        F.col("partner_id").alias("campaign_id"),
        "user_id",
        F.when(sales > 0, sales).otherwise(price).alias("spend_usd"),
        "device_type",
        F.col("product_country").alias("country_code"),
        "product_brand",
        "product_age_group",
        *[_cast(c, "int").alias(c) for c in CATEGORIES],
        price.alias("product_price"),
        sales.alias("sales_amount_euro"),
        (F.coalesce(_cast("sale", "bigint"), F.lit(0)) != 0).alias("sale"),
        _cast("time_delay_conv", "bigint").alias("time_delay_for_conversion"),
        _cast("nb_clicks_week", "bigint").alias("nb_clicks_1week"),
        "audience_id",
        "product_gender",
        "product_title",
        "product_id",
    )


def fan_out(events: DataFrame) -> DataFrame:
    """Two events per base event: an impression, and a conversion or click.

    The impression carries a tenth of the spend.
    """
    copies = F.array(
        F.struct(
            F.lit("impression").alias("event_type"),
            (F.col("spend_usd") * F.lit(IMPRESSION_SPEND_SHARE)).alias("spend_usd"),
        ),
        F.struct(
            F.when(F.col("sale"), "conversion").otherwise("click").alias("event_type"),
            F.col("spend_usd"),
        ),
    )
    others = [c for c in events.columns if c != "spend_usd"]
    return events.select(*others, F.inline(copies))


def expand_click_log(lines: DataFrame) -> DataFrame:
    """Log lines to ad events, ready for the bus or for aggregation."""
    return fan_out(click_log_events(split_click_log(lines)))
