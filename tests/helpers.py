"""Small input builders and readers for tests."""

from __future__ import annotations

import json
from datetime import datetime
from decimal import Decimal

from campanile import schemas

STATS_COLUMNS = (
    "campaign_id string, event_type string, window_start_time timestamp, window_end_time timestamp, "
    "event_count bigint, total_bid_amount decimal(18,6), spend_usd decimal(18,6), "
    "total_sales_amount_euro decimal(18,6), device_type string, product_brand string, "
    "product_age_group string, product_category_1 int"
)


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def stats_row(campaign, kind, count, bid, sales=0, start="2024-01-01 10:00:00", end="2024-01-01 10:01:00",
              device=None, brand=None, age=None, category=None):
    return (campaign, kind, at(start), at(end), count, Decimal(str(bid)), Decimal(str(bid)), Decimal(str(sales)),
            device, brand, age, category)


def stats_frame(spark, *rows):
    return spark.createDataFrame(list(rows), STATS_COLUMNS)


def messages(spark, *values):
    lines = [(v if isinstance(v, str) else json.dumps(v),) for v in values]
    return spark.createDataFrame(lines, "value string")


def events(spark, *rows):
    """Typed events; absent fields are NULL."""
    names = schemas.EVENT.names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schemas.EVENT)


def rows(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def table(df, *columns):
    return sorted(rows(df, *columns), key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
