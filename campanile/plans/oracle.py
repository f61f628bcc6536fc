"""The registered queries as SQL for an independent engine.

Each query is built from the raw tables through the full chain of the data
model: events, windowed statistics of one minute with all dimensions, report.
The Spark side may take a shorter way to the same rows.
"""

from __future__ import annotations

from campanile.plans.registry import (
    ADVERTISER, ALL_ORDERS, AS_OF, CAMPAIGN, EARLY_END, META_AS_OF, RANGE, REPORT_MONTH, SLICES,
)

_SQL: dict[str, str] = {}

EVENTS = """
ad_events AS (
  SELECT event_id, ts AS event_timestamp, 'campaign_' || CAST(user_id AS VARCHAR) AS campaign_id,
    CASE event_type WHEN 'view' THEN 'impression' WHEN 'purchase' THEN 'conversion' ELSE event_type END AS event_type,
    CAST(user_id AS VARCHAR) AS user_id, value AS spend_usd,
    CASE WHEN event_type = 'purchase' THEN value * 10 ELSE 0.0 END AS sales_amount_euro,
    CASE event_id % 4 WHEN 0 THEN 'Desktop' WHEN 1 THEN 'Mobile' WHEN 2 THEN 'Tablet' END AS device_type,
    CASE event_id % 5 WHEN 0 THEN 'US' WHEN 1 THEN 'GB' WHEN 2 THEN 'DE' WHEN 3 THEN 'FR' END AS country_code,
    'Brand#' || CAST(event_id % 25 AS VARCHAR) AS product_brand,
    CASE event_id % 6 WHEN 0 THEN '18-24' WHEN 1 THEN '25-34' WHEN 2 THEN '35-44' WHEN 3 THEN '45-54'
      WHEN 4 THEN '55+' END AS product_age_group,
    CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) % 7 AS product_category_1
  FROM events
)"""

ALL_DIMS = "device_type, country_code, product_brand, product_age_group, product_category_1"


def stats_cte(unit: str = "minute", dims: str = ALL_DIMS, source: str = "ad_events", name: str = "stats") -> str:
    """Windowed statistics; empty ``dims`` group by the plain key."""
    extra = f", {dims}" if dims else ""
    return f"""
{name} AS (
  SELECT campaign_id, event_type, date_trunc('{unit}', event_timestamp) AS window_start_time,
    date_trunc('{unit}', event_timestamp) + INTERVAL 1 {unit} AS window_end_time{extra},
    count(*) AS event_count,
    CAST(sum(CAST(spend_usd AS DECIMAL(18,6))) AS DECIMAL(38,6)) AS total_bid_amount,
    CAST(sum(CAST(spend_usd AS DECIMAL(18,6))) AS DECIMAL(38,6)) AS spend_usd,
    CAST(sum(CAST(sales_amount_euro AS DECIMAL(18,6))) AS DECIMAL(38,6)) AS total_sales_amount_euro
  FROM {source}
  GROUP BY campaign_id, event_type, date_trunc('{unit}', event_timestamp){extra}
)"""


def pivot(kind: str) -> str:
    return f"CAST(coalesce(sum(CASE WHEN event_type = '{kind}' THEN event_count ELSE 0 END), 0) AS BIGINT)"


def filtered(kind: str) -> str:
    return f"CAST(sum(event_count) FILTER (WHERE event_type = '{kind}') AS DOUBLE)"


def money(column: str) -> str:
    return f"CAST(coalesce(sum({column}), 0) AS DOUBLE)"


def safe_div(n: str, d: str, scale: int = 1) -> str:
    times = f" * {scale}.0" if scale != 1 else ""
    return f"CASE WHEN {d} > 0 THEN CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE){times} ELSE 0.0 END"


COUNTS = (
    f"{pivot('impression')} AS impressions, {pivot('click')} AS clicks, {pivot('conversion')} AS conversions"
)


def add(name: str, body: str, *ctes: str) -> None:
    _SQL[name] = (f"WITH {','.join(ctes)}\n" if ctes else "") + body.strip()


def on_stats(name: str, body: str, *more: str, unit: str = "minute", dims: str = ALL_DIMS) -> None:
    add(name, body, EVENTS, stats_cte(unit, dims), *more)


def all_sql() -> dict[str, str]:
    return dict(_SQL)


# --- ingest -------------------------------------------------------------------------------------

add("parse_events", """
SELECT event_timestamp, campaign_id, event_type, user_id, spend_usd, device_type, product_category_1,
  sales_amount_euro FROM ad_events""", EVENTS)

add("enrich_events", """
SELECT event_timestamp, campaign_id, event_type, coalesce(spend_usd, 0.0) AS total_bid_amount,
  coalesce(device_type, 'unknown') AS device_type, coalesce(country_code, 'unknown') AS country_code,
  coalesce(product_age_group, 'unknown') AS product_age_group,
  coalesce(product_category_1, 0) AS product_category_1, 0 AS product_category_2, false AS sale
FROM ad_events""", EVENTS)

add("event_preview", """
SELECT event_id, campaign_id, event_type, spend_usd FROM ad_events ORDER BY event_id LIMIT 20""", EVENTS)

CLICKS = """
kept AS (
  SELECT * FROM lineitem
  WHERE l_linenumber NOT IN (6, 7) AND l_suppkey % 10 <> 0 AND l_orderkey % 50 <> 0
),
base AS (
  SELECT l_shipdate AS timestamp, CAST(l_suppkey AS VARCHAR) AS campaign_id, CAST(l_orderkey AS VARCHAR) AS user_id,
    CASE WHEN l_returnflag = 'R' THEN l_extendedprice WHEN l_linenumber = 5 THEN 0.0 ELSE l_quantity END AS spend_usd,
    CASE WHEN l_linenumber = 5 THEN 0.0 ELSE l_quantity END AS product_price,
    CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0.0 END AS sales_amount_euro,
    l_returnflag = 'R' AS sale,
    CASE WHEN l_linenumber = 1 THEN '-1' ELSE '25-34' END AS product_age_group,
    CAST(l_partkey % 7 AS INTEGER) AS product_category_1, CAST(NULL AS INTEGER) AS product_category_2,
    CASE WHEN l_linenumber = 2 THEN NULL ELSE CAST(l_suppkey AS INTEGER) END AS product_category_4,
    CAST(l_suppkey AS INTEGER) AS product_category_6,
    CAST(l_linenumber AS BIGINT) AS time_delay_for_conversion, CAST(NULL AS BIGINT) AS nb_clicks_1week,
    '-1' AS audience_id, CAST(l_partkey AS VARCHAR) AS product_id
  FROM kept
)"""
FANNED = """
fanned AS (
  SELECT timestamp, campaign_id, 'impression' AS event_type, spend_usd * CAST(0.1 AS DOUBLE) AS spend FROM base
  UNION ALL
  SELECT timestamp, campaign_id, CASE WHEN sale THEN 'conversion' ELSE 'click' END, spend_usd FROM base
)"""
add("click_log_events", "SELECT * FROM base", CLICKS)
add("click_log_fanout", """
SELECT campaign_id, event_type, count(*) AS event_count,
  CAST(sum(CAST(spend AS DECIMAL(18,6))) AS DOUBLE) AS total_bid_amount
FROM fanned GROUP BY campaign_id, event_type""", CLICKS, FANNED)
add("click_log_daily_stats", """
SELECT campaign_id, event_type, date_trunc('day', timestamp) AS window_start_time, count(*) AS event_count,
  CAST(sum(CAST(spend AS DECIMAL(18,6))) AS DOUBLE) AS total_bid_amount
FROM fanned GROUP BY campaign_id, event_type, date_trunc('day', timestamp)""", CLICKS, FANNED)

BATCHES = """
batches AS (
  SELECT event_id, ts, event_type, user_id, props, event_id % 97 = 0 AS malformed,
    'batch_' || CAST(event_id // 2 AS VARCHAR) AS batch_id,
    CASE WHEN event_id % 89 <> 0 THEN 'source_' || CAST(event_id % 5 AS VARCHAR) END AS source,
    event_id % 3 + 1 AS n
  FROM events
)"""
add("event_batch_rows", """
SELECT batch_id, source, CAST(b.event_id AS VARCHAR) || '-' || CAST(i.i AS VARCHAR) AS event_id, ts AS timestamp,
  event_type AS event_name, CAST(user_id AS VARCHAR) AS user_id, regexp_extract(props, '([0-9]+)', 1) AS k
FROM batches b JOIN (SELECT unnest([0, 1, 2]) AS i) i ON i.i < b.n
WHERE NOT malformed""", BATCHES)
add("event_batch_round_trip", """
SELECT batch_id, source, CAST(n AS INTEGER) AS event_count FROM batches WHERE NOT malformed""", BATCHES)
JUDGED = """
judged AS (
  SELECT *, CASE WHEN malformed THEN 'malformed json' WHEN source IS NULL THEN 'missing'
      WHEN n > 2 THEN 'too many events' END AS bad,
    CASE WHEN malformed THEN 'body' WHEN source IS NULL THEN 'source' WHEN n > 2 THEN 'events' END AS field
  FROM batches
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY batch_id, bad IS NULL ORDER BY event_id) AS nth FROM judged
)"""
add("ingest_batches_accepted", """
SELECT batch_id, source, CAST(n AS INTEGER) AS event_count FROM ranked WHERE bad IS NULL AND nth = 1""",
    BATCHES, JUDGED)
add("ingest_batches_rejected", """
SELECT coalesce(field, 'batch_id') AS reject_field, coalesce(bad, 'duplicate batch') AS reject_reason,
  count(*) AS batch_count
FROM ranked WHERE bad IS NOT NULL OR nth > 1 GROUP BY 1, 2""", BATCHES, JUDGED)

add("event_messages", """
SELECT campaign_id AS key, '{"campaign_id":"' || campaign_id || '","event_type":"' || event_type
  || '","user_id":"' || user_id || '"}' AS value
FROM ad_events""", EVENTS)

on_stats("sql_report", f"""
SELECT event_type, CAST(sum(event_count) AS BIGINT) AS event_count FROM stats
WHERE window_start_time >= TIMESTAMP '{RANGE[0]}' GROUP BY event_type""")

# --- aggregation --------------------------------------------------------------------------------

WINDOW_COLUMNS = """campaign_id, event_type, window_start_time, window_end_time, {dims} event_count,
  CAST(total_bid_amount AS DOUBLE) AS total_bid_amount,
  CAST(total_sales_amount_euro AS DOUBLE) AS total_sales_amount_euro"""


def windowed(name: str, unit: str, dims: str = "") -> None:
    columns = WINDOW_COLUMNS.format(dims=f"{dims}," if dims else "")
    on_stats(name, f"SELECT {columns} FROM stats", unit=unit, dims=dims)


windowed("minute_stats", "minute")
windowed("hourly_stats", "hour")
windowed("daily_stats", "day")
windowed("hourly_stats_by_device", "hour", "device_type, country_code")
windowed("daily_stats_by_all_dims", "day", ALL_DIMS)

add("running_totals", """
SELECT campaign_id, event_type, count(*) AS event_count,
  CAST(sum(CAST(spend_usd AS DECIMAL(18,6))) AS DOUBLE) AS total_bid_amount
FROM ad_events GROUP BY campaign_id, event_type""", EVENTS)

SUMMARY = """
SELECT campaign_id, event_type, CAST(sum(event_count) AS BIGINT) AS total_events,
  CAST(sum(total_bid_amount) AS DOUBLE) AS total_bid_amount,
  CAST(sum(CAST(CAST(total_bid_amount AS DOUBLE) / event_count AS DECIMAL(28,12))) AS DOUBLE) / count(*)
    AS avg_bid_per_event,
  min(window_start_time) AS first_event_time, max(window_end_time) AS last_event_time, count(*) AS total_windows
FROM stats GROUP BY campaign_id, event_type"""
on_stats("campaign_summary", SUMMARY, unit="hour", dims="")
on_stats("stored_summary", SUMMARY, unit="hour", dims="")

on_stats("totals_by_day", f"""
SELECT CAST(window_start_time AS DATE) AS day, {COUNTS}, {money('total_bid_amount')} AS spend_usd
FROM stats GROUP BY 1""")
on_stats("global_totals_of_nothing", f"""
SELECT {COUNTS}, {money('total_bid_amount')} AS spend_usd FROM stats WHERE event_count < 0""")
FRESHNESS = f"""
SELECT max(window_start_time) AS latest_ts,
  CAST(coalesce(epoch(TIMESTAMP '{AS_OF}') - epoch(max(window_start_time)), 9999) AS BIGINT) AS data_freshness_seconds
FROM stats"""
on_stats("data_freshness", FRESHNESS)
on_stats("data_freshness_of_nothing", FRESHNESS + " WHERE event_count < 0")

KEYED = """
keyed AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS id, CAST(l_linenumber AS VARCHAR) AS type,
    CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR) AS record_key
  FROM lineitem
)"""
add("record_counts", "SELECT record_key, count(*) AS record_count FROM keyed GROUP BY record_key", KEYED)
add("unique_records", "SELECT count(DISTINCT record_key) AS unique_records FROM keyed", KEYED)

# --- views --------------------------------------------------------------------------------------

on_stats("stats_view", """
SELECT campaign_id, event_type, window_start_time, window_end_time, event_count,
  CAST(total_bid_amount AS DOUBLE) AS total_bid_amount, 'Desktop' AS device_type, 'US' AS country_code,
  'Brand' AS product_brand, '25-34' AS product_age_group, 1 AS product_category_1,
  CAST(total_bid_amount AS DOUBLE) AS spend_usd,
  CAST(CAST(total_bid_amount AS DECIMAL(28,6)) * CAST(0.85 AS DECIMAL(4,2)) AS DOUBLE) AS total_sales_amount_euro,
  CASE WHEN event_type = 'conversion' THEN event_count ELSE 0 END AS total_sales_count
FROM stats""", unit="hour", dims="")
on_stats("stats_view_by_category", """
SELECT CASE ascii(campaign_id) % 5 WHEN 0 THEN 'Electronics' WHEN 1 THEN 'Clothing' WHEN 2 THEN 'Home'
    WHEN 3 THEN 'Sports' ELSE 'Beauty' END AS product_category_1,
  CAST(sum(CAST(CAST(total_bid_amount AS DECIMAL(28,6)) * CAST(0.85 AS DECIMAL(4,2)) AS DECIMAL(38,6))) AS DOUBLE)
    AS total_revenue
FROM stats GROUP BY 1""")
on_stats("stats_view_with_ratios", f"""
SELECT campaign_id, event_type, window_start_time, window_end_time, event_count,
  CAST(total_bid_amount AS DOUBLE) AS total_bid_amount,
  CAST(total_sales_amount_euro AS DOUBLE) AS total_sales_amount_euro, CAST(spend_usd AS DOUBLE) AS spend_usd,
  {safe_div('total_bid_amount', 'event_count')} AS avg_bid_amount,
  {safe_div('total_sales_amount_euro', 'spend_usd')} AS roi
FROM stats""", unit="hour", dims="")
RECORDS = """SELECT window_start_time, campaign_id, event_type, event_count,
  CAST(total_bid_amount AS DOUBLE) AS total_bid_amount FROM stats"""
on_stats("stats_records", RECORDS, unit="hour", dims="")

# --- lookups and joins --------------------------------------------------------------------------

IN_RANGE = f"window_start_time >= TIMESTAMP '{RANGE[0]}' AND window_start_time < TIMESTAMP '{RANGE[1]}'"
META = """
meta AS (
  SELECT 'campaign_' || CAST(c_custkey AS VARCHAR) AS campaign_id, c_name AS campaign_name,
    'adv_' || CAST(c_nationkey AS VARCHAR) AS advertiser_id,
    'Advertiser ' || CAST(c_nationkey AS VARCHAR) AS advertiser_name, c_mktsegment AS industry_category,
    DATE '2024-01-01' AS start_date, CASE WHEN c_custkey % 3 = 0 THEN DATE '2024-01-15' END AS end_date,
    CAST(CAST(abs(c_acctbal) AS DECIMAL(15,2)) AS DOUBLE) AS budget_usd,
    CAST(0.03 AS DOUBLE) AS target_ctr, CAST(25 AS DOUBLE) AS target_cpa, c_custkey % 4 <> 0 AS is_active,
    CASE c_custkey % 4 WHEN 0 THEN 'standard' WHEN 1 THEN 'premium' WHEN 2 THEN 'test' ELSE 'pilot' END
      AS campaign_type,
    CAST(c_custkey % 10 + 1 AS INTEGER) AS priority
  FROM customer
)"""
ACTIVE = f"is_active AND (end_date IS NULL OR end_date >= DATE '{META_AS_OF}')"

on_stats("stats_for_campaign", f"{RECORDS} WHERE campaign_id = '{CAMPAIGN}' AND {IN_RANGE}", dims="")
on_stats("stats_in_range", f"""
SELECT campaign_id, event_type, window_start_time, window_end_time, event_count,
  CAST(total_bid_amount AS DOUBLE) AS total_bid_amount, CAST(spend_usd AS DOUBLE) AS spend_usd,
  CAST(total_sales_amount_euro AS DOUBLE) AS total_sales_amount_euro
FROM stats WHERE window_start_time >= TIMESTAMP '{RANGE[0]}' AND window_end_time <= TIMESTAMP '{RANGE[1]}'""",
         unit="hour", dims="")
on_stats("stats_of_event_type", f"{RECORDS} WHERE event_type = 'click'", unit="hour", dims="")
add("active_campaigns", f"SELECT * FROM meta WHERE {ACTIVE}", META)
add("advertiser_campaigns", f"""
SELECT advertiser_id, campaign_id, campaign_name, priority FROM meta
WHERE {ACTIVE} AND advertiser_id = '{ADVERTISER}' ORDER BY priority, campaign_name""", META)
on_stats("stats_with_metadata", f"""
SELECT window_start_time, s.campaign_id, event_type, event_count, CAST(total_bid_amount AS DOUBLE) AS total_bid_amount
FROM stats s JOIN meta m ON s.campaign_id = m.campaign_id
WHERE {IN_RANGE} AND {ACTIVE}""", META, unit="hour", dims="")


def performance_summary(name: str, where: str) -> None:
    on_stats(name, f"""
SELECT *, {safe_div('total_clicks', 'total_impressions')} AS actual_ctr,
  {safe_div('total_spend', 'total_conversions')} AS actual_cpa,
  {safe_div('total_conversions', 'total_clicks')} AS conversion_rate,
  {safe_div('total_clicks', 'total_impressions')} >= target_ctr AS meets_target_ctr,
  total_conversions > 0 AND {safe_div('total_spend', 'total_conversions')} <= target_cpa AS meets_target_cpa,
  {safe_div('total_spend', 'budget_usd')} AS budget_used
FROM (
  SELECT m.campaign_id, campaign_name, advertiser_name, industry_category, budget_usd, target_ctr, target_cpa,
    {pivot('impression')} AS total_impressions, {pivot('click')} AS total_clicks,
    {pivot('conversion')} AS total_conversions, {money('total_bid_amount')} AS total_spend
  FROM meta m LEFT JOIN stats s ON m.campaign_id = s.campaign_id AND {IN_RANGE}
  WHERE {where}
  GROUP BY m.campaign_id, campaign_name, advertiser_name, industry_category, budget_usd, target_ctr, target_cpa
)""", META)


performance_summary("campaign_performance_summary", "true")
performance_summary("campaign_performance_summary_one", f"m.campaign_id = '{CAMPAIGN}'")

# --- reports ------------------------------------------------------------------------------------

KPIS = f"""
kpis AS (
  SELECT {COUNTS}, {money('spend_usd')} AS spend_usd, {money('total_sales_amount_euro')} AS revenue_euro FROM stats
)"""
on_stats("platform_kpis", f"""
SELECT *, {safe_div('clicks', 'impressions')} AS ctr, {safe_div('revenue_euro', 'spend_usd')} AS roas,
  {safe_div('spend_usd', 'conversions')} AS cpa, {safe_div('conversions', 'clicks')} AS conversion_rate
FROM kpis""", KPIS)
on_stats("dashboard_kpis", f"""
SELECT impressions, clicks, conversions, {safe_div('clicks', 'impressions', 100)} AS ctr, spend_usd,
  CAST(round(CAST(spend_usd AS DECIMAL(28,6)) / 1000, 2) AS DOUBLE) AS spend_thousands
FROM kpis""", KPIS)
on_stats("basic_kpis", f"SELECT {COUNTS}, {money('total_bid_amount')} AS spend_usd FROM stats")
on_stats("advertiser_metrics", f"""
SELECT {safe_div('spend_usd', 'conversions')} AS cpa, {safe_div('revenue_euro', 'spend_usd')} AS roas,
  {safe_div('conversions', 'clicks', 100)} AS conversion_rate
FROM kpis""", KPIS)


def roi_cte(where: str = "true") -> str:
    return f"""
roi AS (
  SELECT day, {safe_div('revenue', 'spend')} AS roi FROM (
    SELECT CAST(window_start_time AS DATE) AS day, {money('total_sales_amount_euro')} AS revenue,
      {money('spend_usd')} AS spend
    FROM stats WHERE {where} GROUP BY 1)
)"""


RECENT = "window_start_time > TIMESTAMP '{as_of}' - INTERVAL 90 DAY"
on_stats("roi_trend", "SELECT * FROM roi", roi_cte())
on_stats("roi_trend_rounded", """
SELECT CAST(day AS VARCHAR) AS window_start_time,
  CAST(round(CAST(roi AS DECIMAL(28,12)), 4) AS DOUBLE) AS roi FROM roi""", roi_cte())


def roi_recent(name: str, as_of: str) -> None:
    recent = RECENT.format(as_of=as_of)
    on_stats(name, "SELECT * FROM roi", roi_cte(f"({recent} OR NOT EXISTS (SELECT 1 FROM stats WHERE {recent}))"),
             unit="day", dims="")


roi_recent("roi_trend_recent", "2024-04-10 00:00:00")
roi_recent("roi_trend_fallback", "2025-01-01 00:00:00")
on_stats("roi_trend_bid", """
SELECT CAST(window_start_time AS DATE) AS day,
  CAST(coalesce(sum(total_bid_amount) FILTER (WHERE event_type = 'conversion'), 0) AS DOUBLE)
    / nullif(CAST(coalesce(sum(total_bid_amount) FILTER (WHERE event_type = 'impression'), 0) AS DOUBLE), 0) AS roi
FROM stats GROUP BY 1""")
on_stats("campaign_performance", f"""
SELECT campaign_id, {COUNTS}, {money('total_bid_amount')} AS spend_usd,
  CASE WHEN {filtered('impression')} > 0
    THEN CAST(round(CAST({filtered('click')} / {filtered('impression')} * 100.0 AS DECIMAL(28,10)), 2) AS DOUBLE)
    ELSE 0.0 END AS ctr
FROM stats GROUP BY campaign_id""")

PERF = f"""
perf AS (
  SELECT *, {safe_div('clicks', 'impressions', 100)} AS ctr FROM (
    SELECT campaign_id, {COUNTS}, {money('spend_usd')} AS spend_usd FROM stats GROUP BY campaign_id)
),
top15 AS (SELECT * FROM perf ORDER BY spend_usd DESC, campaign_id LIMIT 15)"""
on_stats("top_campaigns_by_spend", "SELECT * FROM top15", PERF)
on_stats("top_stats_rows", """
SELECT campaign_id, event_type, window_start_time, window_end_time, event_count,
  CAST(total_bid_amount AS DOUBLE) AS total_bid_amount, CAST(spend_usd AS DOUBLE) AS spend_usd,
  CAST(total_sales_amount_euro AS DOUBLE) AS total_sales_amount_euro
FROM stats ORDER BY stats.spend_usd DESC, campaign_id, event_type, window_start_time LIMIT 10""", dims="")
on_stats("campaign_efficiency", f"""
SELECT campaign_id, spend, {safe_div('revenue', 'spend')} AS roi,
  ({safe_div('revenue', 'spend')}) * 100.0 AS roi_percent, conversions,
  {safe_div('clicks', 'impressions', 100)} AS ctr, {safe_div('conversions', 'clicks', 100)} AS conversion_rate
FROM (SELECT campaign_id, {COUNTS}, {money('spend_usd')} AS spend, {money('total_sales_amount_euro')} AS revenue
  FROM stats GROUP BY campaign_id)
WHERE spend > 0 ORDER BY spend DESC, campaign_id LIMIT 20""")


def quadrants(name: str, source: str) -> None:
    on_stats(name, """
SELECT campaign_id, spend, roi, mean_spend, mean_roi,
  CASE WHEN spend >= mean_spend AND roi >= mean_roi THEN 'Stars' WHEN spend >= mean_spend THEN 'Question Marks'
    WHEN roi >= mean_roi THEN 'Cash Cows' ELSE 'Pets' END AS quadrant
FROM rated, means""", PERF, f"""
rated AS (
  SELECT * FROM (
    SELECT campaign_id, spend_usd AS spend,
      CASE WHEN spend_usd <> 0 THEN CAST(conversions * 50 AS DOUBLE) / spend_usd ELSE 0.0 END AS roi
    FROM {source})
  WHERE spend > 0 AND roi > 0
),
means AS (
  SELECT CAST(sum(CAST(spend AS DECIMAL(28,10))) AS DOUBLE) / count(*) AS mean_spend,
    CAST(sum(CAST(roi AS DECIMAL(28,10))) AS DOUBLE) / count(*) AS mean_roi
  FROM rated
)""")


quadrants("campaign_quadrants", "perf")
quadrants("top_campaign_quadrants", "top15")
on_stats("campaign_roas", """
SELECT campaign_id, conversions, spend_usd,
  CASE WHEN spend_usd <> 0 THEN CAST(conversions * 50 AS DOUBLE) / spend_usd ELSE 0.0 END AS roas
FROM top15 ORDER BY roas DESC, campaign_id LIMIT 15""", PERF)
on_stats("cpa_ctr_map", """
SELECT campaign_id, spend_usd / conversions AS cpa, ctr, spend_usd AS spend FROM perf
WHERE conversions > 0 AND spend_usd > 0 AND ctr > 0""", PERF)
on_stats("converting_campaigns", "SELECT campaign_id, conversions FROM perf WHERE conversions > 0", PERF)

on_stats("performance_by_device", f"""
SELECT device_type, {money('total_sales_amount_euro')} AS total_revenue,
  CASE WHEN {filtered('click')} > 0 THEN {filtered('conversion')} / {filtered('click')} ELSE 0.0 END AS conversion_rate
FROM stats WHERE device_type IS NOT NULL GROUP BY device_type""")
on_stats("dashboard_by_device", f"""
SELECT device_type, total_revenue, {safe_div('conversions', 'clicks', 100)} AS conversion_rate
FROM (SELECT coalesce(s.device_type, 'Unknown') AS device_type, {COUNTS},
    {money('total_sales_amount_euro')} AS total_revenue
  FROM stats s GROUP BY 1)""")


def revenue(dim: str, top: int | None = None, unknown: bool = False) -> str:
    key = f"coalesce(s.{dim}, 'Unknown')" if unknown else f"s.{dim}"
    where = "true" if unknown else f"s.{dim} IS NOT NULL"
    limit = f"ORDER BY total_revenue DESC, 1 LIMIT {top}" if top else ""
    return f"""
SELECT {key} AS {dim}, {money('total_sales_amount_euro')} AS total_revenue
FROM stats s WHERE {where} GROUP BY 1 {limit}"""


on_stats("revenue_by_category", revenue("product_category_1"))
on_stats("dashboard_by_category", revenue("product_category_1", 7))
on_stats("revenue_by_brand", revenue("product_brand", 15))
on_stats("dashboard_by_brand", revenue("product_brand", 10, unknown=True))
on_stats("revenue_by_age_group", revenue("product_age_group"))
on_stats("dashboard_by_age_group", f"""
SELECT product_age_group, total_revenue, {safe_div('clicks', 'impressions', 100)} AS ctr
FROM (SELECT coalesce(s.product_age_group, 'Unknown') AS product_age_group, {COUNTS},
    {money('total_sales_amount_euro')} AS total_revenue
  FROM stats s GROUP BY 1)""")


def shares(name: str, dim: str, unknown: bool) -> None:
    on_stats(name, f"""
SELECT {dim}, total_revenue, total_revenue / (SELECT CAST(sum(CAST(total_revenue AS DECIMAL(38,6))) AS DOUBLE)
  FROM revenue) AS share FROM revenue""", f"revenue AS ({revenue(dim, unknown=unknown)})")


shares("category_revenue_share", "product_category_1", False)
shares("age_group_revenue_share", "product_age_group", True)

HOURLY = """
hourly AS (
  SELECT date_trunc('hour', o_orderdate) AS hour_timestamp, 'campaign_' || CAST(l_suppkey AS VARCHAR) AS campaign_id,
    n_name AS country_code, CAST(sum(CAST(l_quantity * 100 AS BIGINT)) AS BIGINT) AS impressions,
    CAST(sum(l_partkey % 97) AS BIGINT) AS clicks,
    CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS conversions,
    sum(CAST(l_extendedprice AS DECIMAL(18,6))) AS spend_usd
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2, 3
)"""


def top_per_country(name: str, start: str, end: str) -> None:
    def rate(n: str, d: str, places: int) -> str:
        """Quotient of whole numbers, rounded half up in whole numbers: a double would miss ties."""
        n, unit = f"CAST({n} AS HUGEINT)", 10 ** places
        return f"CASE WHEN {d} = 0 THEN 0.0 ELSE CAST((2 * {n} * {unit} + {d}) // (2 * {d}) AS DOUBLE) / {unit} END"

    ctr, sold = rate("clicks", "impressions", 6), rate("conversions", "clicks", 6)
    score = "CAST(0.4 AS DOUBLE) * ctr + CAST(0.4 AS DOUBLE) * sold + CAST(0.2 AS DOUBLE) * least(CAST(spend AS DOUBLE) / nullif(conversions, 0), 100.0)"
    add(name, f"""
SELECT country AS country_code, campaign_id,
  CAST(row_number() OVER (PARTITION BY country ORDER BY ctr DESC, sold DESC, spend DESC, impressions DESC, campaign_id) AS INTEGER) AS rank_in_country,
  CAST(round(CAST(ctr * 100.0 AS DECIMAL(28,10)), 4) AS DOUBLE) AS ctr_percentage,
  CAST(round(CAST(sold * 100.0 AS DECIMAL(28,10)), 4) AS DOUBLE) AS conversion_rate_percentage,
  {rate('(spend * 1000000)', '(conversions * 1000000)', 2)} AS cost_per_conversion,
  impressions AS total_impressions, clicks AS total_clicks, conversions AS total_conversions,
  CAST(round(spend, 2) AS DOUBLE) AS total_spend_usd, CAST(round(CAST({score} AS DECIMAL(28,12)), 4) AS DOUBLE) AS performance_score,
  hours AS hourly_records_count,
  CASE WHEN ctr >= 0.05 THEN 'Excellent' WHEN ctr >= 0.03 THEN 'Good' WHEN ctr >= 0.015 THEN 'Average' ELSE 'Below Average' END
    AS ctr_performance_tier,
  '{start[:10]}' AS report_date
FROM (SELECT *, {ctr} AS ctr, {sold} AS sold FROM counted)
QUALIFY rank_in_country <= 3""", HOURLY, f"""
counted AS (
  SELECT campaign_id, coalesce(h.country_code, 'UNKNOWN') AS country, CAST(sum(impressions) AS BIGINT) AS impressions,
    CAST(coalesce(sum(clicks), 0) AS BIGINT) AS clicks, CAST(coalesce(sum(conversions), 0) AS BIGINT) AS conversions,
    coalesce(sum(spend_usd), 0) AS spend, count(*) AS hours
  FROM hourly h
  WHERE impressions >= 0 AND campaign_id IS NOT NULL AND hour_timestamp >= TIMESTAMP '{start}' AND hour_timestamp < TIMESTAMP '{end}'
  GROUP BY 1, 2 HAVING sum(impressions) >= 100
)""")


top_per_country("top_campaigns_by_country", *REPORT_MONTH)
top_per_country("top_campaigns_by_country_all_time", *ALL_ORDERS)

# --- health -------------------------------------------------------------------------------------

RUNS = """
runs AS (
  SELECT CAST(CAST(o_orderdate AS DATE) + 8217 AS TIMESTAMP) AS process_time,
    CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'P' THEN 'failed' WHEN 'O' THEN 'running' ELSE o_orderstatus END
      AS status,
    -- Half up in whole cents: a double would miss ties.
    CAST((CAST(round(o_totalprice * 100) AS BIGINT) + 50) // 100 AS DECIMAL(13,0)) * CAST(0.001 AS DECIMAL(4,3))
      AS processing_time_sec,
    CAST(o_orderkey % 600 AS INTEGER) AS data_freshness_minutes,
    CAST(100 - o_orderkey % 20 AS DECIMAL(5,2)) AS quality_score
  FROM orders
)"""
SUCCESS = "CAST(sum(CASE WHEN status = 'success' THEN 1 ELSE 0 END) AS DOUBLE) / count(*) * 100.0"
HEALTH = f"""
health AS (
  SELECT CAST(process_time AS DATE) AS day,
    CAST(sum(processing_time_sec) AS DOUBLE) / count(processing_time_sec) AS avg_processing_time,
    count(*) AS job_count, {SUCCESS} AS success_rate,
    CAST(max(data_freshness_minutes) // 60 AS BIGINT) AS data_freshness_hours,
    CAST(sum(quality_score) AS DOUBLE) / count(quality_score) AS quality_score
  FROM runs WHERE process_time > TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY GROUP BY 1
)"""
JOINED = """
joined AS (
  SELECT h.*, r.roi FROM (SELECT * FROM health ORDER BY day DESC LIMIT 6) h LEFT JOIN roi r ON h.day = r.day
)"""
add("run_health", "SELECT * FROM health", RUNS, HEALTH)
on_stats("health_summary", f"""
SELECT CAST(coalesce(epoch(TIMESTAMP '{AS_OF}') - epoch(max(date_trunc('day', window_start_time))), 9999) AS BIGINT)
    AS data_freshness_seconds,
  (SELECT {SUCCESS} FROM runs) AS etl_success_rate,
  (SELECT CAST(sum(quality_score) AS DOUBLE) / count(quality_score) FROM runs) AS data_quality_score
FROM stats""", RUNS)
on_stats("health_vs_roi", "SELECT * FROM joined", roi_cte(), RUNS, HEALTH, JOINED)
on_stats("root_cause_point", """
SELECT day, success_rate, data_freshness_hours, quality_score, roi FROM joined
ORDER BY success_rate, day LIMIT 1""", roi_cte(), RUNS, HEALTH, JOINED)

# --- quality ------------------------------------------------------------------------------------


def reasons(cases: str) -> str:
    return f"checked AS (SELECT *, CASE event_id % 50 {cases} END AS reject_reason FROM ad_events)"


PRESENCE = reasons("WHEN 0 THEN 'malformed json' WHEN 1 THEN 'missing campaign_id' WHEN 3 THEN 'missing timestamp'")
SOUND = reasons(
    "WHEN 0 THEN 'malformed json' WHEN 1 THEN 'missing campaign_id' WHEN 2 THEN 'null campaign_id' "
    "WHEN 3 THEN 'missing timestamp' WHEN 4 THEN 'amount out of range'"
)
add("validate_events", "SELECT reject_reason, count(*) AS message_count FROM checked GROUP BY 1", EVENTS, PRESENCE)
add("quarantine_events", """
SELECT reject_reason, count(*) AS message_count FROM checked WHERE reject_reason IS NOT NULL GROUP BY 1""",
    EVENTS, SOUND)
add("quality_counts", """
SELECT CAST(sum(CASE WHEN reject_reason IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS processed,
  CAST(sum(CASE WHEN reject_reason IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS failed FROM checked""",
    EVENTS, PRESENCE)
ACCEPTED = "accepted AS (SELECT * FROM checked WHERE reject_reason IS NULL)"
PLAIN = """
SELECT campaign_id, event_type, window_start_time, window_end_time, event_count,
  CAST(total_bid_amount AS DOUBLE) AS total_bid_amount FROM stats"""
for _name in ("stats_without_rejects", "stream_stats_with_rejects"):
    add(_name, PLAIN, EVENTS, SOUND, ACCEPTED, stats_cte("day", "", "accepted"))

add("metadata_violations", """
SELECT campaign_id, violations FROM (
  SELECT 'campaign_' || CAST(c_custkey AS VARCHAR) AS campaign_id,
    concat_ws(',',
      CASE WHEN c_custkey % 3 = 0 AND c_custkey % 20 < 9 THEN 'end_not_before_start' END,
      CASE WHEN c_acctbal < 0 THEN 'budget_not_negative' END,
      CASE WHEN c_custkey % 12 NOT BETWEEN 1 AND 10 THEN 'priority_in_range' END,
      CASE WHEN c_custkey % 13 > 10 THEN 'target_ctr_is_fraction' END,
      CASE WHEN c_custkey % 5 = 4 THEN 'campaign_type_known' END) AS violations
  FROM customer)
WHERE violations <> ''""")
add("run_violations", """
SELECT job_id, violations FROM (
  SELECT CAST(o_orderkey AS VARCHAR) AS job_id,
    concat_ws(',', CASE WHEN o_orderstatus <> 'F' THEN 'status_known' END,
      CASE WHEN 105 - o_orderkey % 20 > 100 THEN 'quality_score_is_percent' END) AS violations
  FROM orders)
WHERE violations <> ''""")
on_stats("stats_violations", """
SELECT campaign_id, event_type, window_start_time, 'total_bid_amount_not_negative' AS violations
FROM stats WHERE total_bid_amount < 50""", unit="hour", dims="")
on_stats("duplicate_stats_keys", """
SELECT campaign_id, event_type, window_start_time, count(*) AS row_count FROM stats
GROUP BY campaign_id, event_type, window_start_time HAVING count(*) > 1""", unit="day", dims="device_type")
add("null_dimension_rows", """
SELECT event_id, CASE WHEN device_type IS NULL THEN 'null device_type' ELSE 'null country_code' END AS reject_reason
FROM ad_events WHERE device_type IS NULL OR country_code IS NULL""", EVENTS)
add("duplicate_records", """
SELECT record_key FROM (SELECT record_key, row_number() OVER (PARTITION BY record_key) AS nth FROM keyed)
WHERE nth > 1""", KEYED)
add("first_records", "SELECT DISTINCT record_key, id, type FROM keyed", KEYED)
add("user_first_events", """
SELECT campaign_id, event_type, spend_usd, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY campaign_id, event_type ORDER BY event_id) AS nth FROM ad_events)
WHERE nth = 1""", EVENTS)

# --- table maintenance --------------------------------------------------------------------------

add("merge_additive", PLAIN, EVENTS, stats_cte("day", ""))
add("insert_ignore", f"""
SELECT campaign_id, campaign_name FROM meta WHERE {ACTIVE}
UNION ALL
SELECT DISTINCT campaign_id, 'New ' || user_id FROM ad_events
WHERE campaign_id NOT IN (SELECT campaign_id FROM meta WHERE {ACTIVE})""", META, EVENTS)
on_stats("backfill_impression_bids", """
SELECT campaign_id, event_type, window_start_time, window_end_time, event_count,
  CAST(CASE WHEN total_bid_amount < 40 THEN CASE WHEN event_type = 'impression' THEN event_count * 0.05 ELSE 0 END
    ELSE total_bid_amount END AS DOUBLE) AS total_bid_amount
FROM stats""", unit="hour", dims="")
LIMIT = "TIMESTAMP '2024-04-15 12:00:00' - INTERVAL 90 DAY"
on_stats("retained_stats", f"{RECORDS} WHERE window_start_time >= {LIMIT}", unit="hour", dims="")
on_stats("expired_stats", f"SELECT count(*) AS deleted_rows FROM stats WHERE window_start_time < {LIMIT}",
         unit="hour", dims="")
on_stats("operational_log", f"""
SELECT 'data_cleanup' AS event_type, 'campaign_stats' AS table_name, count(*) AS deleted_rows
FROM stats WHERE window_start_time < {LIMIT}""", unit="hour", dims="")

# --- streaming ----------------------------------------------------------------------------------

add("stream_minute_stats", PLAIN, EVENTS, stats_cte("minute", ""))
_SQL["stream_arrival_totals"] = _SQL["running_totals"]
add("stream_repeats", """
SELECT campaign_id || ':' || event_type AS record_key, count(*) - 1 AS repeats FROM ad_events
GROUP BY 1 HAVING count(*) > 1""", EVENTS)
add("stream_stats_over_triggers", PLAIN, EVENTS, stats_cte("day", ""))
add("event_file_stats", PLAIN, EVENTS, stats_cte("hour", ""))
add("stored_stats_after_compaction", PLAIN, EVENTS, stats_cte("hour", ""))
_SQL["purged_stats"] = _SQL["retained_stats"]

# --- tables and streams over several micro-batches ------------------------------------------------

add("stream_ingest_batches", """
SELECT CASE WHEN NOT malformed THEN batch_id END AS batch_id, CASE WHEN NOT malformed THEN source END AS source,
  CASE WHEN NOT malformed THEN CAST(n AS INTEGER) END AS event_count,
  CASE WHEN bad IS NULL AND nth > 1 THEN 'batch_id' ELSE field END AS reject_field,
  CASE WHEN bad IS NULL AND nth > 1 THEN 'duplicate batch' ELSE bad END AS reject_reason
FROM ranked""", BATCHES, JUDGED)
FILLED = """
filled AS (SELECT * REPLACE (coalesce(device_type, 'unknown') AS device_type, coalesce(country_code, 'unknown') AS country_code) FROM ad_events)"""
add("stored_stats_by_device", """
SELECT campaign_id, event_type, window_start_time, window_end_time, device_type, country_code, event_count,
  CAST(total_bid_amount AS DOUBLE) AS total_bid_amount, CAST(total_sales_amount_euro AS DOUBLE) AS total_sales_amount_euro FROM stats""",
    EVENTS, FILLED, stats_cte("day", "device_type, country_code", "filled"))
add("stored_revenue_by_device", """
SELECT device_type, CAST(sum(total_sales_amount_euro) AS DOUBLE) AS total_revenue,
  CASE WHEN sum(event_count) FILTER (WHERE event_type = 'click') > 0
    THEN CAST(sum(event_count) FILTER (WHERE event_type = 'conversion') AS DOUBLE) / CAST(sum(event_count) FILTER (WHERE event_type = 'click') AS DOUBLE)
    ELSE 0.0 END AS conversion_rate
FROM stats GROUP BY device_type""", EVENTS, FILLED, stats_cte("day", "device_type, country_code", "filled"))
_SQL["stats_after_purge_and_compaction"] = _SQL["retained_stats"]
on_stats("stored_stats_for_campaign", f"{RECORDS} WHERE campaign_id = '{CAMPAIGN}' AND {IN_RANGE}", unit="hour", dims="")


def _summary(stage: int, source: str, condition: str = "true") -> str:
    return f"""
SELECT campaign_id, event_type, CAST(sum(event_count) AS BIGINT) AS total_events, CAST(sum(total_bid_amount) AS DOUBLE) AS total_bid_amount,
  CAST(sum(CAST(CAST(total_bid_amount AS DOUBLE) / event_count AS DECIMAL(28,12))) AS DOUBLE) / count(*) AS avg_bid_per_event,
  min(window_start_time) AS first_event_time, max(window_end_time) AS last_event_time, count(*) AS total_windows, {stage} AS stage
FROM {source} WHERE {condition} GROUP BY campaign_id, event_type"""


add("kept_summary_by_stage", f"""
{_summary(0, 'begun')} UNION ALL {_summary(1, 'stats')} UNION ALL {_summary(2, 'stats', f'window_start_time >= {LIMIT}')}""",
    EVENTS, f"early AS (SELECT * FROM ad_events WHERE event_timestamp < TIMESTAMP '{EARLY_END}')",
    stats_cte("hour", "", "early", "begun"), stats_cte("hour", ""))
add("stream_late_rows", f"""
SELECT e.event_id, e.event_timestamp, e.campaign_id, e.event_type, e.spend_usd, m.watermark,
  date_trunc('hour', e.event_timestamp) + INTERVAL 1 HOUR AS window_end_time, e.event_id % {SLICES} AS batch
FROM ad_events e JOIN marks m ON e.event_id % {SLICES} = m.slice
WHERE date_trunc('hour', e.event_timestamp) + INTERVAL 1 HOUR <= m.watermark""", EVENTS, f"""
marks AS (
  SELECT s.slice, max(event_timestamp) - INTERVAL 10 DAY AS watermark
  FROM (SELECT unnest(range({SLICES})) AS slice) s JOIN ad_events ON event_id % {SLICES} < s.slice GROUP BY s.slice)""")
add("stream_repeat_records", """
SELECT record_key, occurrence FROM (
  SELECT campaign_id || ':' || event_type AS record_key,
    row_number() OVER (PARTITION BY campaign_id, event_type ORDER BY event_timestamp, event_id) AS occurrence
  FROM ad_events)
WHERE occurrence > 1""", EVENTS)

_BY_USERS = f"FROM ad_events WHERE event_timestamp >= TIMESTAMP '{RANGE[0]}' AND event_timestamp < TIMESTAMP '{RANGE[1]}'"
add("distinct_users_by_brand", f"SELECT product_brand, count(DISTINCT user_id) AS distinct_users {_BY_USERS} GROUP BY 1", EVENTS)
add("distinct_users_by_day", f"SELECT CAST(event_timestamp AS DATE) AS day, count(DISTINCT user_id) AS distinct_users {_BY_USERS} GROUP BY 1", EVENTS)
add("estimated_users_by_brand", f"SELECT DISTINCT product_brand, true AS within_5_percent {_BY_USERS}", EVENTS)
add("stream_state_matches_table", """
SELECT campaign_id, event_type, window_start_time, event_count, CAST(total_bid_amount AS DOUBLE) AS total_bid_amount,
  event_count AS state_count, CAST(total_bid_amount AS DOUBLE) AS state_bid_amount FROM stats""", EVENTS, stats_cte("day", ""))
_ABSENT = ", ".join(f"CAST(NULL AS INTEGER) AS product_category_{i}" for i in range(2, 8))
_ZERO = ", ".join(f"0 AS product_category_{i}" for i in range(2, 8))
add("parsed_event_fields", f"""
SELECT event_timestamp AS timestamp, campaign_id, event_type, user_id, spend_usd, CAST(NULL AS DOUBLE) AS bid_amount_usd, device_type,
  country_code, product_brand, product_age_group, product_category_1, {_ABSENT}, CAST(NULL AS DOUBLE) AS product_price,
  sales_amount_euro, CAST(NULL AS BOOLEAN) AS sale, event_timestamp FROM ad_events""", EVENTS)
add("enriched_event_fields", f"""
SELECT event_timestamp AS timestamp, campaign_id, event_type, user_id, spend_usd, CAST(NULL AS DOUBLE) AS bid_amount_usd,
  coalesce(device_type, 'unknown') AS device_type, coalesce(country_code, 'unknown') AS country_code,
  coalesce(product_brand, 'unknown') AS product_brand, coalesce(product_age_group, 'unknown') AS product_age_group,
  coalesce(product_category_1, 0) AS product_category_1, {_ZERO}, CAST(NULL AS DOUBLE) AS product_price,
  coalesce(sales_amount_euro, 0.0) AS sales_amount_euro, false AS sale, event_timestamp, coalesce(spend_usd, 0.0) AS total_bid_amount
FROM ad_events""", EVENTS)
on_stats("kpi_violations", """
SELECT day, 'spend_usd_not_negative' AS violations FROM (
  SELECT CAST(window_start_time AS DATE) AS day, sum(total_bid_amount - 60) AS spend FROM stats GROUP BY 1)
WHERE spend < 0""", unit="day", dims="")
add("health_violations", """
SELECT job_id, violations FROM (
  SELECT CAST(o_orderkey AS VARCHAR) AS job_id, concat_ws(',',
    CASE WHEN 106 - o_orderkey % 20 > 100 THEN 'success_rate_is_percent' END,
    CASE WHEN 105 - o_orderkey % 20 > 100 THEN 'quality_score_is_percent' END) AS violations
  FROM orders)
WHERE violations <> ''""")

add("nested_attribute_round_trip", """
SELECT CAST(event_id AS VARCHAR) AS event_id, user_id, CASE WHEN event_id % 3 = 0 THEN 'g' END AS group_name,
  regexp_extract(props, '([0-9]+)', 1) AS k, CASE WHEN event_id % 5 = 0 THEN 'x' END AS tag FROM events""")
add("nested_attribute_paths", """
SELECT event_type AS event_name, path, type, count(*) AS event_count FROM (
  SELECT event_type, unnest([
    {'path': 'user', 'type': 'OBJECT'}, {'path': 'user.id', 'type': 'BIGINT'},
    {'path': CASE WHEN event_id % 3 = 0 THEN 'user.group' END, 'type': 'OBJECT'},
    {'path': CASE WHEN event_id % 3 = 0 THEN 'user.group.name' END, 'type': 'STRING'},
    {'path': 'k', 'type': CASE WHEN event_id % 2 = 0 THEN 'BIGINT' ELSE 'STRING' END},
    {'path': CASE WHEN event_id % 5 = 0 THEN 'tags' END, 'type': 'ARRAY'}], recursive := true) FROM events)
WHERE path IS NOT NULL GROUP BY 1, 2, 3""")
