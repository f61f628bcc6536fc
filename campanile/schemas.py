"""Declared schemas of every table and message the library handles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

S, L, I, D, B, TS, DT = (
    T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(),
    T.BooleanType(), T.TimestampType(), T.DateType(),
)
MONEY = T.DecimalType(18, 6)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


CATEGORIES = tuple(f"product_category_{i}" for i in range(1, 8))

#: Ad event as it arrives.  Producers name the spend either ``spend_usd`` or
#: ``bid_amount_usd``; both are declared and merged on enrichment.
EVENT = _struct(
    timestamp=TS, campaign_id=S, event_type=S, user_id=S, spend_usd=D, bid_amount_usd=D,
    device_type=S, country_code=S, product_brand=S, product_age_group=S,
    **{c: I for c in CATEGORIES},
    product_price=D, sales_amount_euro=D, sale=B,
)

#: Key of the windowed statistics table.
STATS_KEYS = ("campaign_id", "event_type", "window_start_time")

STATS = _struct(
    campaign_id=S, event_type=S, window_start_time=TS, window_end_time=TS,
    event_count=L, total_bid_amount=MONEY,
)



def stats_keys(dims: Sequence[str] = ()) -> tuple[str, ...]:
    """Key of a statistics table that carries dimensions."""
    return (*STATS_KEYS, *dims)


def stats(dims: Sequence[str] = (), sales: bool = False) -> T.StructType:
    """A stored statistics table with dimensions and, if wanted, real revenue."""
    money = {"total_bid_amount": MONEY} | ({"total_sales_amount_euro": MONEY} if sales else {})
    return _struct(
        campaign_id=S, event_type=S, window_start_time=TS, window_end_time=TS,
        **{d: I if d in CATEGORIES else S for d in dims}, event_count=L, **money, updated_at=TS,
    )


METADATA = _struct(
    campaign_id=S, campaign_name=S, advertiser_id=S, advertiser_name=S,
    industry_category=S, target_audience=S, start_date=DT, end_date=DT,
    budget_usd=T.DecimalType(15, 2), target_ctr=T.DecimalType(5, 4),
    target_cpa=T.DecimalType(10, 2), is_active=B, campaign_type=S, priority=I,
    created_at=TS, updated_at=TS,
)

HOURLY = _struct(
    hour_timestamp=TS, campaign_id=S, publisher_id=S, country_code=S,
    impressions=L, clicks=L, conversions=L, spend_usd=MONEY,
)

RUNS = _struct(
    process_time=TS, pipeline_name=S, job_id=S, status=S,
    processing_time_sec=T.DecimalType(10, 3), records_processed=L, errors_count=L,
    data_freshness_minutes=I, quality_score=T.DecimalType(5, 2), created_at=TS,
)

#: Column order of the raw click log, a fixed file format.
CLICK_LOG_COLUMNS = (
    "sale", "sales_amount_euro", "time_delay_conv", "click_timestamp", "nb_clicks_week",
    "product_price", "product_age_group", "device_type", "audience_id", "product_gender",
    "product_brand", *CATEGORIES, "product_country", "product_id", "product_title",
    "partner_id", "user_id",
)

#: Batch of events sent in one message; attributes are free-form.
ENVELOPE = _struct(
    batch_id=S, source=S,
    events=T.ArrayType(_struct(
        event_id=S, timestamp=TS, event_name=S, attributes=T.MapType(S, S),
    )),
)

#: The same with attributes of any shape, objects in objects among them.
NESTED_ENVELOPE = _struct(
    batch_id=S, source=S,
    events=T.ArrayType(_struct(
        event_id=S, timestamp=TS, event_name=S, attributes=T.VariantType(),
    )),
)

OPERATIONAL_EVENT = _struct(event_type=S, event_data=S, created_at=TS)
