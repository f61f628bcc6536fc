"""Advertising tables derived from a general sales and events data set.

Used by the registered queries and the tests.  Every table is a projection or
an aggregation of whole input tables, so its size follows theirs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from campanile.functions import from_micros, sum_money
from campanile.operators.aggregate import aggregate_events
from campanile.operators.dedupe import file_position, with_position
from campanile.schemas import CLICK_LOG_COLUMNS
from campanile.sources.tables import read_table

# Order dates end in 2001 and events in 2024; runs are shifted onto the events.
RUN_SHIFT_DAYS = 8217
JSON_OPTIONS = {"ignoreNullFields": "false"}


def _iso(column: str) -> str:
    """SQL for a timestamp as ISO text in UTC, microseconds kept."""
    return f"concat(replace(CAST({column} AS STRING), ' ', 'T'), 'Z')"


def _text(column: str) -> Column:
    return F.col(column).cast("string")


# --- events -------------------------------------------------------------------------------------


def to_ad_events(events: DataFrame) -> DataFrame:
    """Ad events; each user id stands for a campaign, so campaigns grow with the data."""
    return events.selectExpr(
        "event_id",
        "CAST(ts AS TIMESTAMP) AS event_timestamp",
        "concat('campaign_', user_id) AS campaign_id",
        "CASE event_type WHEN 'view' THEN 'impression' WHEN 'purchase' THEN 'conversion' ELSE event_type END "
        "AS event_type",
        "CAST(user_id AS STRING) AS user_id",
        "value AS spend_usd",
        "CASE WHEN event_type = 'purchase' THEN value * 10 ELSE 0.0D END AS sales_amount_euro",
        "CASE event_id % 4 WHEN 0 THEN 'Desktop' WHEN 1 THEN 'Mobile' WHEN 2 THEN 'Tablet' END AS device_type",
        "CASE event_id % 5 WHEN 0 THEN 'US' WHEN 1 THEN 'GB' WHEN 2 THEN 'DE' WHEN 3 THEN 'FR' END AS country_code",
        "concat('Brand#', event_id % 25) AS product_brand",
        "CASE event_id % 6 WHEN 0 THEN '18-24' WHEN 1 THEN '25-34' WHEN 2 THEN '35-44' WHEN 3 THEN '45-54' "
        "WHEN 4 THEN '55+' END AS product_age_group",
        "CAST(get_json_object(props, '$.k') AS INT) % 7 AS product_category_1",
    )


def ad_events(
    spark: SparkSession, folder: str, start: str | None = None, end: str | None = None, campaign: str | None = None,
) -> DataFrame:
    """The event table, or what lies in a half-open time range or belongs to a campaign.

    Bounds are compared with the raw columns, so they reach the scan.
    """
    events = read_table(spark, folder, "events")
    if start is not None:
        events = events.filter(F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        events = events.filter(F.col("ts") < F.lit(end).cast("timestamp_ntz"))
    if campaign is not None:
        user = campaign.removeprefix("campaign_")
        events = events.filter(F.col("user_id") == int(user)) if user.isdigit() else events.limit(0)
    return to_ad_events(events)


def campaign_stats(
    spark: SparkSession, folder: str, window: str = "1 day", dims: Sequence[str] = (), sales: bool = True,
    start: str | None = None, end: str | None = None, campaign: str | None = None,
) -> DataFrame:
    """Statistics table, with missing dimension values kept as NULL.

    Reports add up windows, so a day is as good as a minute and a much smaller
    intermediate result.  ``start`` and ``end`` lie on bounds of windows: they leave whole
    windows out before the events are read.
    """
    events = ad_events(spark, folder, start, end, campaign).withColumn("total_bid_amount", F.coalesce("spend_usd", F.lit(0.0)))
    stats = aggregate_events(events, window, dims=dims, sales=sales)
    return stats.withColumn("spend_usd", F.col("total_bid_amount")) if sales else stats


def event_messages(events: DataFrame) -> DataFrame:
    """Ad events as JSON messages."""
    fields = [F.expr(_iso("event_timestamp")).alias("timestamp")] + [
        F.col(c) for c in events.columns if c not in ("event_id", "event_timestamp")
    ]
    return events.select("event_id", F.to_json(F.struct(*fields), JSON_OPTIONS).alias("value"))


def faulty_messages(events: DataFrame) -> DataFrame:
    """Messages with one of every fifty damaged in each of five ways."""
    full = event_messages(events)
    kind = F.col("event_id") % 50
    value = (
        F.when(kind == 0, F.substring("value", 1, 40))
        .when(kind == 1, F.regexp_replace("value", '"campaign_id":"[^"]*",', ""))
        .when(kind == 2, F.regexp_replace("value", '"campaign_id":"[^"]*"', '"campaign_id":null'))
        .when(kind == 3, F.regexp_replace("value", '"timestamp":"[^"]*",', ""))
        .when(kind == 4, F.regexp_replace("value", '"spend_usd":[^,]*', '"spend_usd":NaN'))
        .otherwise(F.col("value"))
    )
    return full.select("event_id", value.alias("value"))


def event_batch_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Envelopes of one to three events with some faults; ids come twice.

    ``arrival`` is the unique arrival order.
    """
    positioned = read_table(spark, folder, "events").select("*", file_position().alias("_position"))
    events = positioned.withColumn("iso", F.expr(_iso("ts")))
    event = (
        "named_struct('event_id', concat(event_id, '-{i}'), 'timestamp', iso, 'event_name', event_type, "
        "'attributes', map('user_id', CAST(user_id AS STRING), 'k', get_json_object(props, '$.k')))"
    )
    made = ", ".join(event.format(i=i) for i in range(3))
    envelope = events.selectExpr(
        "event_id % 97 = 0 AS broken",
        "struct(event_id, _position) AS arrival",
        "named_struct('batch_id', concat('batch_', event_id div 2), "
        "'source', CASE WHEN event_id % 89 <> 0 THEN concat('source_', event_id % 5) END, "
        f"'events', slice(array({made}), 1, CAST(event_id % 3 + 1 AS INT))) AS envelope",
    )
    value = F.when(F.col("broken"), F.lit("{broken")).otherwise(F.to_json("envelope"))
    return envelope.select(value.alias("value"), "arrival")


def nested_batch_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Envelopes of one event whose attributes hold objects, arrays and values of changing type."""
    made = read_table(spark, folder, "events").selectExpr(
        "event_id", "event_type", _iso("ts") + " AS iso",
        "concat('{\"user\":{\"id\":', user_id, CASE WHEN event_id % 3 = 0 THEN ',\"group\":{\"name\":\"g\"}' ELSE '' END, '}', "
        "',\"k\":', CASE WHEN event_id % 2 = 0 THEN get_json_object(props, '$.k') "
        "ELSE concat('\"', get_json_object(props, '$.k'), '\"') END, "
        "CASE WHEN event_id % 5 = 0 THEN ',\"tags\":[1,\"x\"]' ELSE '' END, '}') AS attributes",
    )
    return made.selectExpr(
        "concat('{\"batch_id\":\"b', event_id, '\",\"source\":\"s\",\"events\":[{\"event_id\":\"', event_id, '\",\"timestamp\":\"', iso, "
        "'\",\"event_name\":\"', event_type, '\",\"attributes\":', attributes, '}]}') AS value")


# --- dimension and facts ------------------------------------------------------------------------


def campaign_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """One campaign per customer; campaigns without events stay in."""
    return read_table(spark, folder, "customer").selectExpr(
        "concat('campaign_', c_custkey) AS campaign_id",
        "c_name AS campaign_name",
        "concat('adv_', c_nationkey) AS advertiser_id",
        "concat('Advertiser ', c_nationkey) AS advertiser_name",
        "c_mktsegment AS industry_category",
        "DATE '2024-01-01' AS start_date",
        "CASE WHEN c_custkey % 3 = 0 THEN DATE '2024-01-15' END AS end_date",
        "CAST(abs(c_acctbal) AS DECIMAL(15,2)) AS budget_usd",
        "CAST(0.03 AS DECIMAL(5,4)) AS target_ctr",
        "CAST(25 AS DECIMAL(10,2)) AS target_cpa",
        "c_custkey % 4 <> 0 AS is_active",
        "CASE c_custkey % 4 WHEN 0 THEN 'standard' WHEN 1 THEN 'premium' WHEN 2 THEN 'test' ELSE 'pilot' END "
        "AS campaign_type",
        "CAST(c_custkey % 10 + 1 AS INT) AS priority",
    )


def raw_campaign_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Unchecked metadata, breaking constraints in places."""
    return read_table(spark, folder, "customer").selectExpr(
        "concat('campaign_', c_custkey) AS campaign_id",
        "DATE '2024-01-10' AS start_date",
        "CASE WHEN c_custkey % 3 = 0 THEN date_add(DATE '2024-01-01', CAST(c_custkey % 20 AS INT)) END AS end_date",
        "CAST(c_acctbal AS DECIMAL(15,2)) AS budget_usd",
        "CAST(c_custkey % 12 AS INT) AS priority",
        "CAST(c_custkey % 13 / 10 AS DECIMAL(5,4)) AS target_ctr",
        "CASE c_custkey % 5 WHEN 0 THEN 'standard' WHEN 1 THEN 'premium' WHEN 2 THEN 'test' WHEN 3 THEN 'pilot' "
        "ELSE 'other' END AS campaign_type",
    )


def processing_runs(spark: SparkSession, folder: str) -> DataFrame:
    """One processing run per order."""
    return read_table(spark, folder, "orders").selectExpr(
        f"CAST(date_add(CAST(o_orderdate AS DATE), {RUN_SHIFT_DAYS}) AS TIMESTAMP) AS process_time",
        "o_orderpriority AS pipeline_name",
        "CAST(o_orderkey AS STRING) AS job_id",
        "CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'P' THEN 'failed' WHEN 'O' THEN 'running' "
        "ELSE o_orderstatus END AS status",
        "CAST(o_totalprice / 1000 AS DECIMAL(10,3)) AS processing_time_sec",
        "o_custkey AS records_processed",
        "CAST(o_orderkey % 600 AS INT) AS data_freshness_minutes",
        "CAST(100 - o_orderkey % 20 AS DECIMAL(5,2)) AS quality_score",
    )


def raw_processing_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Unchecked runs: status codes as delivered, scores beyond their range."""
    return read_table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("job_id"),
        F.when(F.col("o_orderstatus") == "F", "success").otherwise(F.col("o_orderstatus")).alias("status"),
        (105 - F.col("o_orderkey") % 20).cast("decimal(5,2)").alias("quality_score"),
    )


def hourly_performance(spark: SparkSession, folder: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Hourly facts per campaign, publisher country and hour.

    ``start`` and ``end``, on full hours, prune the scan of the order table; the
    pruned orders then prune the much larger line items in the join.
    """
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    if start:
        orders = orders.filter(F.col("o_orderdate") >= F.lit(start).cast("timestamp_ntz"))
    if end:
        orders = orders.filter(F.col("o_orderdate") < F.lit(end).cast("timestamp_ntz"))
    customers = read_table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nations = read_table(spark, folder, "nation").select("n_nationkey", "n_name")
    placed = (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "o_orderkey",
            F.date_trunc("hour", F.col("o_orderdate").cast("timestamp")).alias("hour_timestamp"),
            F.col("n_name").alias("country_code"),
        )
    )
    lines = read_table(spark, folder, "lineitem")
    joined = lines.join(placed, lines.l_orderkey == placed.o_orderkey)
    return joined.groupBy(
        "hour_timestamp", F.concat(F.lit("campaign_"), _text("l_suppkey")).alias("campaign_id"), "country_code"
    ).agg(
        F.sum((F.col("l_quantity") * 100).cast("bigint")).alias("impressions"),
        F.sum(F.col("l_partkey") % 97).alias("clicks"),
        F.count_if(F.col("l_returnflag") == "R").alias("conversions"),
        from_micros(sum_money("l_extendedprice")).alias("spend_usd"),
    )


# --- records and logs ---------------------------------------------------------------------------


def keyed_records(spark: SparkSession, folder: str) -> DataFrame:
    """Records with ``id``, ``type`` and their unique arrival order."""
    lines = with_position(read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber"), "arrival")
    return lines.select(_text("l_orderkey").alias("id"), _text("l_linenumber").alias("type"), "arrival")


def click_log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of a click log with gaps, wrong types and short lines, from line items."""
    def missing_if(condition: Column, value: Column) -> Column:
        return F.when(condition, "-1").otherwise(value.cast("string"))

    line, supplier, order = F.col("l_linenumber"), F.col("l_suppkey"), F.col("l_orderkey")
    returned = F.col("l_returnflag") == "R"
    values = {
        "sale": F.when(returned, "1").when(F.col("l_returnflag") == "A", "0").otherwise("-1"),
        "sales_amount_euro": missing_if(~returned, F.col("l_extendedprice")),
        "time_delay_conv": line,
        "click_timestamp": missing_if(line == 7, F.unix_seconds(F.col("l_shipdate").cast("timestamp"))),
        "nb_clicks_week": F.lit(""),
        "product_price": F.when(line == 5, "n/a").otherwise(_text("l_quantity")),
        "product_age_group": missing_if(line == 1, F.lit("25-34")),
        "device_type": F.lit("Mobile"),
        "audience_id": F.lit("-1"),
        "product_gender": F.col("l_returnflag"),
        "product_brand": F.concat(F.lit("Brand#"), supplier % 25),
        "product_category_1": F.col("l_partkey") % 7,
        "product_category_2": F.lit("-1"),
        "product_category_3": F.lit(""),
        "product_category_4": F.when(line == 2, "x").otherwise(supplier.cast("string")),
        "product_category_5": line,
        "product_category_6": supplier,
        "product_category_7": F.lit("-1"),
        "product_country": F.lit("US"),
        "product_id": F.col("l_partkey"),
        "product_title": F.lit("title"),
        "partner_id": missing_if(supplier % 10 == 0, supplier),
        "user_id": missing_if(order % 50 == 0, order),
    }
    fields = [values[name].cast("string") for name in CLICK_LOG_COLUMNS]
    whole = read_table(spark, folder, "lineitem").select("l_linenumber", F.concat_ws("\t", *fields).alias("value"))
    short = F.substring_index("value", "\t", len(fields) - 1)
    return whole.select(F.when(line == 6, short).otherwise(F.col("value")).alias("value"))
