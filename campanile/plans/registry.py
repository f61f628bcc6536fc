"""Named queries over a folder of tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from campanile import session
from campanile.operators import aggregate, dedupe, distinct, ingest, lookup, maintenance, quality, views
from campanile.plans import health, reports
from campanile.plans.top_campaigns import top_campaigns
from campanile.sinks import messages, oplog, stats_table, stored
from campanile.sources import click_log, derived, events as event_sources, tables
from campanile.streaming import arrival, batch_ingest, late, repeat_history, repeats, stats_job

Query = Callable[[SparkSession, str], DataFrame]
Run = Callable[[int], object]

AS_OF = "2024-01-31 00:00:00"
META_AS_OF = "2024-01-20"
RANGE = ("2024-01-05 00:00:00", "2024-01-20 00:00:00")
REPORT_MONTH = ("1995-07-01 00:00:00", "1995-08-01 00:00:00")
ALL_ORDERS = ("1995-01-01 00:00:00", "2001-12-31 00:00:00")
SLICES = 4
RETENTION_AS_OF = "2024-04-15 12:00:00"
#: The limit that follows, the start of an hour: windows on either side lie wholly on it.
RETAINED_FROM = str(datetime.fromisoformat(RETENTION_AS_OF) - timedelta(days=maintenance.RETENTION_DAYS))
CAMPAIGN = "campaign_7"
ADVERTISER = "adv_7"
ALL_DIMS = ("device_type", "country_code", "product_brand", "product_age_group", "product_category_1")

_QUERIES: dict[str, Query] = {}


def query(name: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(session.prepare(spark), folder)

        _QUERIES[name or fn.__name__] = run
        return fn

    return register


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _doubles(df: DataFrame, *columns: str) -> DataFrame:
    """Money as double, so results compare equal across engines."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def _stats(spark, folder, dims: Sequence[str] = (), window: str = "1 day", **bounds: str) -> DataFrame:
    return derived.campaign_stats(spark, folder, window, dims, **bounds)


def _ranged(spark, folder, window: str, **bounds: str) -> DataFrame:
    """Statistics of the reporting range; its bounds are midnights, so they are bounds of windows too."""
    return _stats(spark, folder, window=window, start=RANGE[0], end=RANGE[1], **bounds)


# --- ingest -------------------------------------------------------------------------------------


@query()
def parse_events(spark, folder):
    parsed = ingest.parse_events(derived.event_messages(derived.ad_events(spark, folder)))
    return parsed.select(
        "event_timestamp", "campaign_id", "event_type", "user_id", "spend_usd", "device_type",
        "product_category_1", "sales_amount_euro",
    )


@query()
def enrich_events(spark, folder):
    parsed = ingest.parse_events(derived.event_messages(derived.ad_events(spark, folder)))
    return ingest.enrich_events(parsed).select(
        "event_timestamp", "campaign_id", "event_type", "total_bid_amount", "device_type", "country_code",
        "product_age_group", "product_category_1", "product_category_2", "sale",
    )


@query()
def event_preview(spark, folder):
    return event_sources.preview(derived.ad_events(spark, folder), 20, "event_id").select(
        "event_id", "campaign_id", "event_type", "spend_usd"
    )


@query()
def click_log_events(spark, folder):
    rows = click_log.split_click_log(derived.click_log_lines(spark, folder))
    return click_log.click_log_events(rows).select(
        "timestamp", "campaign_id", "user_id", "spend_usd", "product_price", "sales_amount_euro", "sale",
        "product_age_group", "product_category_1", "product_category_2", "product_category_4",
        "product_category_6", "time_delay_for_conversion", "nb_clicks_1week", "audience_id", "product_id",
    )


@query()
def click_log_fanout(spark, folder):
    events = click_log.expand_click_log(derived.click_log_lines(spark, folder))
    totals = aggregate.running_totals(events.withColumnRenamed("spend_usd", "total_bid_amount"))
    return _doubles(totals, "total_bid_amount")


@query()
def click_log_daily_stats(spark, folder):
    events = click_log.expand_click_log(derived.click_log_lines(spark, folder))
    enriched = ingest.enrich_events(events.withColumn("bid_amount_usd", F.lit(None).cast("double")))
    stats = aggregate.aggregate_events(enriched, "1 day", time_col="timestamp")
    return _doubles(stats, "total_bid_amount").drop("window_end_time")


@query()
def event_batch_rows(spark, folder):
    batches = ingest.parse_event_batches(derived.event_batch_messages(spark, folder))
    return ingest.explode_event_batches(batches).select(
        "batch_id", "source", "event_id", "timestamp", "event_name",
        F.col("attributes")["user_id"].alias("user_id"), F.col("attributes")["k"].alias("k"),
    )


@query()
def event_batch_round_trip(spark, folder):
    batches = ingest.parse_event_batches(derived.event_batch_messages(spark, folder)).filter("batch_id IS NOT NULL")
    again = ingest.parse_event_batches(ingest.pack_event_batches(batches))
    return again.select("batch_id", "source", F.size("events").alias("event_count"))


def _nested_events(spark, folder):
    """Events with nested attributes, packed into messages and parsed once more."""
    batches = ingest.parse_event_batches(derived.nested_batch_messages(spark, folder), nested=True)
    again = ingest.parse_event_batches(ingest.pack_event_batches(batches), nested=True)
    return ingest.explode_event_batches(again)


@query()
def nested_attribute_round_trip(spark, folder):
    return _nested_events(spark, folder).select(
        "event_id", F.variant_get("attributes", "$.user.id", "bigint").alias("user_id"),
        F.variant_get("attributes", "$.user.group.name", "string").alias("group_name"),
        F.variant_get("attributes", "$.k", "string").alias("k"), F.variant_get("attributes", "$.tags[1]", "string").alias("tag"))


@query()
def nested_attribute_paths(spark, folder):
    return ingest.attribute_paths(_nested_events(spark, folder))


@query()
def event_messages(spark, folder):
    sent = messages.to_messages(derived.ad_events(spark, folder).select("campaign_id", "event_type", "user_id"))
    return sent


@query()
def sql_report(spark, folder):
    return tables.run_sql(
        spark,
        "SELECT event_type, sum(event_count) AS event_count FROM {stats} "
        "WHERE window_start_time >= :start GROUP BY event_type",
        {"stats": _stats(spark, folder, start=RANGE[0])}, start=RANGE[0],
    )


# --- aggregation --------------------------------------------------------------------------------


def _windowed(window: str, dims: Sequence[str] = ()) -> Query:
    def run(spark, folder):
        return _doubles(
            _stats(spark, folder, dims, window).drop("spend_usd"), "total_bid_amount", "total_sales_amount_euro"
        )

    return run


query("minute_stats")(_windowed("1 minute"))
query("hourly_stats")(_windowed("1 hour"))
query("daily_stats")(_windowed("1 day"))
query("hourly_stats_by_device")(_windowed("1 hour", ("device_type", "country_code")))
query("daily_stats_by_all_dims")(_windowed("1 day", ALL_DIMS))


@query()
def running_totals(spark, folder):
    events = derived.ad_events(spark, folder).withColumn("total_bid_amount", F.col("spend_usd"))
    return _doubles(aggregate.running_totals(events), "total_bid_amount")


@query()
def campaign_summary(spark, folder):
    return _doubles(aggregate.campaign_summary(_stats(spark, folder, window="1 hour")), "total_bid_amount")


@query()
def totals_by_day(spark, folder):
    return _doubles(aggregate.totals_by_day(_stats(spark, folder)), "spend_usd")


@query()
def global_totals_of_nothing(spark, folder):
    none = _stats(spark, folder).filter(F.col("event_count") < 0)
    return _doubles(aggregate.totals_by(none), "spend_usd")


@query()
def data_freshness(spark, folder):
    stats = _stats(spark, folder, window="1 minute")
    return aggregate.data_freshness(stats, F.lit(AS_OF).cast("timestamp"))


@query()
def data_freshness_of_nothing(spark, folder):
    none = _stats(spark, folder).filter(F.col("event_count") < 0)
    return aggregate.data_freshness(none, F.lit(AS_OF).cast("timestamp"))


@query()
def record_counts(spark, folder):
    keyed = dedupe.with_record_key(derived.keyed_records(spark, folder), "id", "type")
    return aggregate.record_counts(keyed, "record_key")


@query()
def unique_records(spark, folder):
    keyed = dedupe.with_record_key(derived.keyed_records(spark, folder), "id", "type")
    return aggregate.distinct_count(keyed, "record_key")


def _daily_users(spark, folder):
    return derived.ad_events(spark, folder, *RANGE).withColumn("day", F.to_date("event_timestamp"))


@query()
def distinct_users_by_brand(spark, folder):
    """Users of two weeks per brand, merged from a bitmap for each day."""
    parts = distinct.distinct_parts(_daily_users(spark, folder), ["day", "product_brand"], "user_id")
    return distinct.merged_distinct(parts, ["product_brand"])


@query()
def distinct_users_by_day(spark, folder):
    parts = distinct.distinct_parts(_daily_users(spark, folder), ["day", "product_brand"], "user_id")
    return distinct.merged_distinct(parts, ["day"])


@query()
def estimated_users_by_brand(spark, folder):
    """Whether the merged sketches of the days come within 5 % of the exact number, or of one user."""
    users = _daily_users(spark, folder)
    estimate = distinct.merged_estimate(distinct.sketch_parts(users, ["day", "product_brand"], "user_id"), ["product_brand"], "estimate")
    exact = distinct.merged_distinct(distinct.distinct_parts(users, ["day", "product_brand"], "user_id"), ["product_brand"])
    near = F.abs(F.col("estimate") - F.col("distinct_users")) <= F.greatest(F.lit(1.0), F.col("distinct_users") * 0.05)
    return exact.join(estimate, "product_brand").select("product_brand", near.alias("within_5_percent"))


# --- views --------------------------------------------------------------------------------------


def _plain_stats(spark, folder):
    return derived.campaign_stats(spark, folder, "1 hour", sales=False)


@query()
def stats_view(spark, folder):
    view = views.stats_view(_plain_stats(spark, folder))
    return _doubles(view, "total_bid_amount", "spend_usd", "total_sales_amount_euro").drop(
        *[f"product_category_{i}" for i in range(2, 8)]
    )


@query()
def stats_view_by_category(spark, folder):
    view = views.stats_view_by_category(_plain_stats(spark, folder))
    return reports.revenue_by(view, "product_category_1")


@query()
def stats_view_with_ratios(spark, folder):
    view = views.stats_view_with_ratios(_stats(spark, folder, window="1 hour"))
    return _doubles(view, "total_bid_amount", "spend_usd", "total_sales_amount_euro")


@query()
def stats_records(spark, folder):
    return views.stats_records(_stats(spark, folder, window="1 hour"))


# --- lookups and joins --------------------------------------------------------------------------


@query()
def stats_for_campaign(spark, folder):
    return lookup.stats_for_campaign(_ranged(spark, folder, "1 minute", campaign=CAMPAIGN), CAMPAIGN, *RANGE)


@query()
def stats_in_range(spark, folder):
    return _doubles(
        lookup.stats_in_range(_ranged(spark, folder, "1 hour"), *RANGE),
        "total_bid_amount", "spend_usd", "total_sales_amount_euro",
    )


@query()
def stats_of_event_type(spark, folder):
    return views.stats_records(
        lookup.stats_where(_stats(spark, folder, window="1 hour"), event_type="click")
    )


@query()
def active_campaigns(spark, folder):
    return _doubles(
        lookup.active_campaigns(derived.campaign_metadata(spark, folder), META_AS_OF),
        "budget_usd", "target_ctr", "target_cpa",
    )


@query()
def advertiser_campaigns(spark, folder):
    return lookup.advertiser_campaigns(derived.campaign_metadata(spark, folder), ADVERTISER, META_AS_OF)


@query()
def stats_with_metadata(spark, folder):
    return lookup.stats_with_metadata(
        _ranged(spark, folder, "1 hour"), derived.campaign_metadata(spark, folder), *RANGE, as_of=META_AS_OF
    )


@query()
def campaign_performance_summary(spark, folder):
    return lookup.campaign_performance_summary(
        _ranged(spark, folder, "1 day"), derived.campaign_metadata(spark, folder), *RANGE
    )


@query()
def campaign_performance_summary_one(spark, folder):
    return lookup.campaign_performance_summary(
        _ranged(spark, folder, "1 day", campaign=CAMPAIGN), derived.campaign_metadata(spark, folder), *RANGE, campaign_id=CAMPAIGN
    )


# --- reports ------------------------------------------------------------------------------------


@query()
def platform_kpis(spark, folder):
    return reports.platform_kpis(_stats(spark, folder))


@query()
def dashboard_kpis(spark, folder):
    return reports.dashboard_kpis(_stats(spark, folder))


@query()
def basic_kpis(spark, folder):
    return reports.basic_kpis(_stats(spark, folder))


@query()
def advertiser_metrics(spark, folder):
    return reports.advertiser_metrics(_stats(spark, folder))


@query()
def roi_trend(spark, folder):
    return reports.roi_trend(_stats(spark, folder))


@query()
def roi_trend_rounded(spark, folder):
    return reports.roi_trend_rounded(_stats(spark, folder))


@query()
def roi_trend_recent(spark, folder):
    return reports.roi_trend(_stats(spark, folder), as_of="2024-04-10 00:00:00", days=90, fallback_all=True)


@query()
def roi_trend_fallback(spark, folder):
    return reports.roi_trend(_stats(spark, folder), as_of="2025-01-01 00:00:00", days=90, fallback_all=True)


@query()
def roi_trend_bid(spark, folder):
    return reports.roi_trend_bid(_stats(spark, folder))


@query()
def campaign_performance(spark, folder):
    return reports.campaign_performance(_stats(spark, folder))


@query()
def top_campaigns_by_spend(spark, folder):
    return reports.top_campaigns_by_spend(_stats(spark, folder))


@query()
def top_stats_rows(spark, folder):
    return _doubles(
        reports.top_stats_rows(_stats(spark, folder, window="1 minute")),
        "total_bid_amount", "spend_usd", "total_sales_amount_euro",
    )


@query()
def campaign_efficiency(spark, folder):
    return reports.campaign_efficiency(_stats(spark, folder))


def _performance(spark, folder, top: int | None = None):
    return reports.top_campaigns_by_spend(_stats(spark, folder), top)


@query()
def campaign_quadrants(spark, folder):
    return reports.campaign_quadrants(_performance(spark, folder))


@query()
def top_campaign_quadrants(spark, folder):
    return reports.campaign_quadrants(_performance(spark, folder, 15))


@query()
def campaign_roas(spark, folder):
    return reports.campaign_roas(_performance(spark, folder, 15))


@query()
def cpa_ctr_map(spark, folder):
    return reports.cpa_ctr_map(_performance(spark, folder))


@query()
def converting_campaigns(spark, folder):
    return reports.converting_campaigns(_performance(spark, folder))


@query()
def performance_by_device(spark, folder):
    return reports.performance_by_device(_stats(spark, folder, ["device_type"]))


@query()
def dashboard_by_device(spark, folder):
    return reports.dashboard_by_device(_stats(spark, folder, ["device_type"]))


@query()
def revenue_by_category(spark, folder):
    return reports.revenue_by(_stats(spark, folder, ["product_category_1"]), "product_category_1")


@query()
def dashboard_by_category(spark, folder):
    return reports.revenue_by(_stats(spark, folder, ["product_category_1"]), "product_category_1", top=7)


@query()
def revenue_by_brand(spark, folder):
    return reports.revenue_by(_stats(spark, folder, ["product_brand"]), "product_brand", top=15)


@query()
def dashboard_by_brand(spark, folder):
    return reports.revenue_by(
        _stats(spark, folder, ["product_brand"]), "product_brand", top=10, unknown=reports.UNKNOWN
    )


@query()
def revenue_by_age_group(spark, folder):
    return reports.revenue_by(_stats(spark, folder, ["product_age_group"]), "product_age_group")


@query()
def dashboard_by_age_group(spark, folder):
    return reports.dashboard_by_age_group(_stats(spark, folder, ["product_age_group"]))


@query()
def category_revenue_share(spark, folder):
    revenue = reports.revenue_by(_stats(spark, folder, ["product_category_1"]), "product_category_1")
    return reports.with_share(revenue, "total_revenue")


@query()
def age_group_revenue_share(spark, folder):
    revenue = reports.dashboard_by_age_group(_stats(spark, folder, ["product_age_group"]))
    return reports.with_share(revenue, "total_revenue").drop("ctr")


@query()
def top_campaigns_by_country(spark, folder):
    return top_campaigns(derived.hourly_performance(spark, folder, *REPORT_MONTH), *REPORT_MONTH)


@query()
def top_campaigns_by_country_all_time(spark, folder):
    # ALL_ORDERS only names the report, as in the SQL twin; no order is left out.
    return top_campaigns(derived.hourly_performance(spark, folder), report_date=ALL_ORDERS[0][:10])


# --- health -------------------------------------------------------------------------------------


@query()
def run_health(spark, folder):
    return health.run_health(derived.processing_runs(spark, folder), AS_OF)


@query()
def health_summary(spark, folder):
    return health.health_summary(_stats(spark, folder), derived.processing_runs(spark, folder), AS_OF)


@query()
def health_vs_roi(spark, folder):
    return health.health_vs_roi(
        health.run_health(derived.processing_runs(spark, folder), AS_OF), reports.roi_trend(_stats(spark, folder))
    )


@query()
def root_cause_point(spark, folder):
    return health.root_cause_point(
        health.run_health(derived.processing_runs(spark, folder), AS_OF), reports.roi_trend(_stats(spark, folder))
    )


# --- quality ------------------------------------------------------------------------------------


@query()
def validate_events(spark, folder):
    checked = quality.validate_events(derived.faulty_messages(derived.ad_events(spark, folder)))
    return checked.groupBy("reject_reason").agg(F.count("*").alias("message_count"))


@query()
def quarantine_events(spark, folder):
    checked = quality.quarantine_events(derived.faulty_messages(derived.ad_events(spark, folder)))
    return quality.rejected(checked).groupBy("reject_reason").agg(F.count("*").alias("message_count"))


@query()
def stats_without_rejects(spark, folder):
    checked = quality.quarantine_events(derived.faulty_messages(derived.ad_events(spark, folder)))
    stats = aggregate.aggregate_events(ingest.enrich_events(quality.accepted(checked)), "1 day")
    return _doubles(stats, "total_bid_amount")


@query()
def quality_counts(spark, folder):
    checked = quality.validate_events(derived.faulty_messages(derived.ad_events(spark, folder)))
    return quality.quality_counts(checked)


@query()
def metadata_violations(spark, folder):
    broken = quality.constraint_violations(derived.raw_campaign_metadata(spark, folder), quality.METADATA_RULES)
    return broken.select("campaign_id", F.concat_ws(",", "violations").alias("violations"))


@query()
def run_violations(spark, folder):
    broken = quality.constraint_violations(derived.raw_processing_runs(spark, folder), quality.RUN_RULES)
    return broken.select("job_id", F.concat_ws(",", "violations").alias("violations"))


@query()
def stats_violations(spark, folder):
    stats = _stats(spark, folder, window="1 hour").withColumn(
        "total_bid_amount", F.col("total_bid_amount") - F.lit(50)
    )
    broken = quality.constraint_violations(stats, quality.STATS_RULES)
    return broken.select(
        "campaign_id", "event_type", "window_start_time", F.concat_ws(",", "violations").alias("violations")
    )


@query()
def duplicate_stats_keys(spark, folder):
    by_device = _stats(spark, folder, ["device_type"])
    return dedupe.duplicate_keys(by_device, ["campaign_id", "event_type", "window_start_time"])


@query()
def null_dimension_rows(spark, folder):
    found = quality.null_keys(derived.ad_events(spark, folder), ["device_type", "country_code"])
    return found.select("event_id", "reject_reason")


@query()
def duplicate_records(spark, folder):
    keyed = dedupe.with_record_key(derived.keyed_records(spark, folder), "id", "type")
    return dedupe.repeated_records(keyed, ["record_key"], "arrival").select("record_key")


@query()
def first_records(spark, folder):
    keyed = dedupe.with_record_key(derived.keyed_records(spark, folder), "id", "type")
    return dedupe.first_records(keyed, ["record_key"], "arrival").select("record_key", "id", "type")


@query()
def user_first_events(spark, folder):
    return dedupe.first_records(
        derived.ad_events(spark, folder).select("event_id", "campaign_id", "event_type", "spend_usd"),
        ["campaign_id", "event_type"], "event_id",
    )


@query()
def ingest_batches_accepted(spark, folder):
    judged = quality.ingest_batches(derived.event_batch_messages(spark, folder), "arrival", max_events=2)
    return quality.accepted(judged).select("batch_id", "source", F.size("events").alias("event_count"))


@query()
def ingest_batches_rejected(spark, folder):
    judged = quality.ingest_batches(derived.event_batch_messages(spark, folder), "arrival", max_events=2)
    return quality.rejected(judged).groupBy("reject_field", "reject_reason").agg(F.count("*").alias("batch_count"))


# --- table maintenance --------------------------------------------------------------------------


@query()
def merge_additive(spark, folder):
    cut = F.lit("2024-01-15 12:30:00").cast("timestamp")
    events = derived.ad_events(spark, folder).withColumn("total_bid_amount", F.col("spend_usd"))
    halves = [
        aggregate.aggregate_events(part, "1 day").withColumn("updated_at", cut)
        for part in (events.filter(F.col("event_timestamp") < cut), events.filter(F.col("event_timestamp") >= cut))
    ]
    keys = ["campaign_id", "event_type", "window_start_time", "window_end_time"]
    return _doubles(maintenance.merge_additive(*halves, keys), "total_bid_amount").drop("updated_at")


@query()
def insert_ignore(spark, folder):
    metadata = derived.campaign_metadata(spark, folder).select("campaign_id", "campaign_name")
    seen = derived.ad_events(spark, folder).select(
        "campaign_id", F.concat(F.lit("New "), "user_id").alias("campaign_name"), "event_id"
    )
    base = lookup.active_campaigns(derived.campaign_metadata(spark, folder), META_AS_OF)
    return maintenance.insert_ignore(base.select(*metadata.columns), seen, ["campaign_id"], "event_id")


@query()
def backfill_impression_bids(spark, folder):
    stats = derived.campaign_stats(spark, folder, "1 hour", sales=False)
    emptied = stats.withColumn(
        "total_bid_amount",
        F.when(F.col("total_bid_amount") < 40, F.lit(0)).otherwise(F.col("total_bid_amount")).cast("decimal(18,6)"),
    )
    return _doubles(maintenance.backfill_impression_bids(emptied), "total_bid_amount")


@query()
def retained_stats(spark, folder):
    kept = maintenance.apply_retention(_stats(spark, folder, window="1 hour", start=RETAINED_FROM), RETENTION_AS_OF)
    return views.stats_records(kept)


@query()
def expired_stats(spark, folder):
    return maintenance.expired_rows(_stats(spark, folder, window="1 hour", end=RETAINED_FROM), RETENTION_AS_OF)


@query()
def stored_summary(spark, folder):
    """Refresh the stored summary and read it back."""
    place = session.scratch_dir(spark, "summary")
    stats = _stats(spark, folder, window="1 hour")
    oplog.refresh_summary(spark, stats, f"{place}/summary", f"{place}/log")
    return _doubles(spark.read.parquet(f"{place}/summary"), "total_bid_amount").drop("last_refreshed")


@query()
def operational_log(spark, folder):
    """Retention and its log entry, read back from the log."""
    place = session.scratch_dir(spark, "oplog")
    expired = maintenance.expired_rows(_stats(spark, folder, window="1 hour", end=RETAINED_FROM), RETENTION_AS_OF).first()
    oplog.log_cleanup(spark, f"{place}/log", "campaign_stats", expired["deleted_rows"])
    log = oplog.read_log(spark, f"{place}/log")
    return log.select(
        "event_type",
        F.variant_get("event_data", "$.table", "string").alias("table_name"),
        F.variant_get("event_data", "$.deleted_rows", "bigint").alias("deleted_rows"),
    )


@query()
def event_file_stats(spark, folder):
    """Events sent as JSON lines to a folder, read back and aggregated."""
    place = session.scratch_dir(spark, "events")
    sent = derived.event_messages(derived.ad_events(spark, folder))
    messages.write_messages(sent, "text", place)
    events = ingest.enrich_events(event_sources.read_events_json(spark, place))
    stats = aggregate.aggregate_events(events, "1 hour", time_col="timestamp")
    return _doubles(stats, "total_bid_amount")


def _stored_stats(spark, folder, name):
    """The hourly statistics as two batches; the second replaces one running hour.

    Returns the place of the table, and of its compaction after the first batch.
    """
    place = session.scratch_dir(spark, name)
    events = derived.ad_events(spark, folder).withColumn("total_bid_amount", F.col("spend_usd"))
    early = aggregate.aggregate_events(events.filter("event_timestamp < TIMESTAMP '2024-01-15 12:30:00'"), "1 hour")
    late = aggregate.aggregate_events(events.filter("event_timestamp >= TIMESTAMP '2024-01-15 12:00:00'"), "1 hour")
    stats_table.upsert_stats(early, 0, f"{place}/table")
    through = stats_table.compact_stats(spark, f"{place}/table", early.schema, f"{place}/compacted")
    stats_table.upsert_stats(late, 1, f"{place}/table")
    return place, early.schema, through


@query()
def stored_stats_after_compaction(spark, folder):
    place, schema, through = _stored_stats(spark, folder, "compacted")
    current = stats_table.current_stats(spark, f"{place}/table", schema, f"{place}/compacted", through)
    return _doubles(current, "total_bid_amount").drop("updated_at")


@query()
def purged_stats(spark, folder):
    place, schema, _ = _stored_stats(spark, folder, "purged")
    stats_table.compact_stats(spark, f"{place}/table", schema, f"{place}/final")
    stats_table.purge_expired(spark, f"{place}/final", "2024-04-15 12:00:00")
    return views.stats_records(spark.read.parquet(f"{place}/final"))


# --- streaming ----------------------------------------------------------------------------------


def _event_stream(spark, folder):
    """The event table as a stream of ad events; all files in one trigger."""
    schema = tables.read_table(spark, folder, "events").schema
    return derived.to_ad_events(event_sources.read_table_stream(spark, folder, "events", schema))


def _drain(stream: DataFrame, spark: SparkSession, name: str, date_col: str | None = "window_start_time"):
    """Run a stream to its end into a new table and return all versions in it."""
    place = session.scratch_dir(spark, name)
    running = stats_job.start_stats_stream(
        stream, f"{place}/table", f"{place}/checkpoint", place.rsplit("/", 1)[-1],
        processing_time=None, date_col=date_col,
    )
    running.awaitTermination()
    return stats_table.read_versions(spark, f"{place}/table", stream.schema)


@query()
def stream_minute_stats(spark, folder):
    stats = stats_job.event_stats(derived.event_messages(_event_stream(spark, folder)))
    current = stats_table.latest_stats(_drain(stats, spark, "stats"))
    return _doubles(current, "total_bid_amount").drop("updated_at")


@query()
def stream_stats_with_rejects(spark, folder):
    stats = stats_job.event_stats(derived.faulty_messages(_event_stream(spark, folder)), "1 day")
    current = stats_table.latest_stats(_drain(stats, spark, "stats"))
    return _doubles(current, "total_bid_amount").drop("updated_at")


@query()
def stream_arrival_totals(spark, folder):
    events = _event_stream(spark, folder).withColumn("total_bid_amount", F.col("spend_usd"))
    current = stats_table.latest_stats(_drain(arrival.aggregate_by_arrival(events), spark, "arrival"))
    totals = current.groupBy("campaign_id", "event_type").agg(
        F.sum("event_count").alias("event_count"), F.sum("total_bid_amount").alias("total_bid_amount")
    )
    return _doubles(totals, "total_bid_amount")


@query()
def stream_repeats(spark, folder):
    events = dedupe.with_record_key(_event_stream(spark, folder), "campaign_id", "event_type")
    versions = _drain(repeats.key_counts(events), spark, "repeats", date_col=None)
    found = repeats.repeats_by_batch(versions)
    return found.groupBy("record_key").agg(F.sum("repeats").alias("repeats"))


@query()
def stream_stats_over_triggers(spark, folder):
    """Messages sent and drained in four slices of time; windows are touched by several triggers.

    No row of a slice is older than any row of the slices before it, so a short watermark drops none.
    """
    place = session.scratch_dir(spark, "messages")
    events = derived.ad_events(spark, folder)
    at = F.unix_micros("event_timestamp")
    first, last = events.agg(F.min(at), F.max(at)).first()
    # Without a time a message is rejected, whichever slice holds it.
    width = (last - first) // SLICES + 1 if first is not None else 1
    part = F.coalesce(F.expr(f"(unix_micros(event_timestamp) - {first or 0}) div {width}"), F.lit(0))
    for i in range(SLICES):
        messages.write_messages(derived.event_messages(events.filter(part == i)), "text", f"{place}/in")
        raw = event_sources.read_event_stream(spark, "text", path=f"{place}/in")
        stats = stats_job.event_stats(raw, "1 day")
        stats_job.start_stats_stream(
            stats, f"{place}/table", f"{place}/checkpoint", f"{place.rsplit('/', 1)[-1]}-{i}", processing_time=None,
        ).awaitTermination()
    current = stats_table.latest_stats(stats_table.read_versions(spark, f"{place}/table", stats.schema))
    return _doubles(current, "total_bid_amount").drop("updated_at")


# --- tables and streams over several micro-batches ------------------------------------------------

EARLY_END, RUNNING_HOUR = "2024-01-15 12:30:00", "2024-01-15 12:00:00"
LATE_DELAY = "10 days"
STORED_DIMS = ("device_type", "country_code")


def _time_slice(events: DataFrame) -> Column:
    """Slices of time; rows without one are in the first."""
    at = F.unix_micros("event_timestamp")
    first, last = events.agg(F.min(at), F.max(at)).first()
    width = (last - first) // SLICES + 1 if first is not None else 1
    return F.coalesce(F.expr(f"(unix_micros(event_timestamp) - {first or 0}) div {width}"), F.lit(0))


def _in_slices(slice_of: Callable[[int], DataFrame], place: str, start: Run) -> None:
    """Add the slices to the folder of a stream one by one; it is started anew for each and drained."""
    for i in range(SLICES):
        slice_of(i).write.mode("append").parquet(f"{place}/in")
        start(i).awaitTermination()


def _typed_stream(spark: SparkSession, place: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(f"{place}/in")


@query()
def stream_ingest_batches(spark, folder):
    """The ingest rules over a stream of batches in order of arrival; ids come again within slices and across them."""
    place = session.scratch_dir(spark, "ingest")
    sent = derived.event_batch_messages(spark, folder)
    first, last = sent.agg(F.min("arrival.event_id"), F.max("arrival.event_id")).first()
    # Rounded to odd numbers, so a slice ends within a pair of equal batch ids.
    width = ((last - first) // SLICES + 1 if first is not None else 1) | 1
    part = F.expr(f"(arrival.event_id - {first or 0}) div {width}")
    ledger = batch_ingest.batch_ledger(spark, f"{place}/ledger", buckets=16)
    _in_slices(lambda i: sent.filter(part == i), place, lambda i: batch_ingest.start_ingest_stream(
        _typed_stream(spark, place, sent.schema), f"{place}/judged", ledger, f"{place}/checkpoint", f"{place.rsplit('/', 1)[-1]}-{i}",
        "arrival", fold_every=2, max_events=2))
    judged = spark.read.parquet(f"{place}/judged")
    return judged.select("batch_id", "source", F.size("events").alias("event_count"), "reject_field", "reject_reason")


def _streamed_table(spark, folder, name, window, dims, sales):
    """A versioned table filled by the statistics stream in slices of time, folded twice on the way."""
    place = session.scratch_dir(spark, name)
    events = derived.ad_events(spark, folder)
    part, schema = _time_slice(events), derived.event_messages(events).schema
    table = stored.stats_table(spark, f"{place}/table", dims, sales)

    def start(i):
        if i % 2:
            table.compact()
        stats = stats_job.event_stats(_typed_stream(spark, place, schema), window, dims=dims, sales=sales)
        return stats_job.start_table_stream(stats, table, f"{place}/checkpoint", f"{place.rsplit('/', 1)[-1]}-{i}", processing_time=None)

    _in_slices(lambda i: derived.event_messages(events.filter(part == i)), place, start)
    return table


@query()
def stored_stats_by_device(spark, folder):
    table = _streamed_table(spark, folder, "devices", "1 day", STORED_DIMS, True)
    return _doubles(table.current(), "total_bid_amount", "total_sales_amount_euro").drop("updated_at", stored.DAY)


@query()
def stored_revenue_by_device(spark, folder):
    """Stream, table, view and report with the revenue that the events carry."""
    table = _streamed_table(spark, folder, "revenue", "1 day", STORED_DIMS, True)
    return reports.performance_by_device(views.stats_view(table.current()))


def _early_and_late(spark, folder, purpose):
    """A versioned table and two micro-batches of hourly statistics; the second replaces a running hour."""
    place = session.scratch_dir(spark, purpose)
    events = derived.ad_events(spark, folder).withColumn("total_bid_amount", F.col("spend_usd"))
    early = aggregate.aggregate_events(events.filter(f"event_timestamp < TIMESTAMP '{EARLY_END}'"), "1 hour")
    late_part = aggregate.aggregate_events(events.filter(f"event_timestamp >= TIMESTAMP '{RUNNING_HOUR}'"), "1 hour")
    return place, stored.stats_table(spark, f"{place}/table"), early, late_part


@query()
def stats_after_purge_and_compaction(spark, folder):
    """Rows that retention removed stay away, though a later micro-batch brings them again."""
    _, table, early, late_part = _early_and_late(spark, folder, "purge")
    write = table.writer()
    write(early, 0)
    table.compact()
    write(late_part, 1)
    stored.purge_expired(table, RETENTION_AS_OF)
    write(early.filter(f"window_start_time < TIMESTAMP '{RUNNING_HOUR}'"), 2)
    table.compact()
    return views.stats_records(table.current())


@query()
def stored_stats_for_campaign(spark, folder):
    """One campaign over two weeks: days outside aren't opened, Bloom filters skip files without it."""
    _, table, early, late_part = _early_and_late(spark, folder, "lookup")
    table.writer()(early, 0)
    table.writer()(late_part, 1)
    table.compact()
    return views.stats_records(lookup.stats_where(stored.stats_between(table, *RANGE), campaign_id=CAMPAIGN))


@query()
def kept_summary_by_stage(spark, folder):
    """The kept summary after each change of the table: a first batch, one that replaces an hour, a purge."""
    place, table, early, late_part = _early_and_late(spark, folder, "kept")
    kept = stored.KeptSummary(table, f"{place}/summary")
    changes = (lambda: table.writer()(early, 0), lambda: table.writer()(late_part, 1), lambda: stored.purge_expired(table, RETENTION_AS_OF))
    for stage, change in enumerate(changes):
        change()
        kept.refresh()
        kept.summary().write.parquet(f"{place}/out/stage={stage}")
    return _doubles(spark.read.parquet(f"{place}/out"), "total_bid_amount")


@query()
def stream_late_rows(spark, folder):
    """Rows whose hour had ended ten days before the newest row of earlier slices; every slice spans the whole time."""
    place = session.scratch_dir(spark, "late")
    events = derived.ad_events(spark, folder).select("event_id", "event_timestamp", "campaign_id", "event_type", "spend_usd")
    part = F.pmod("event_id", F.lit(SLICES))
    _in_slices(lambda i: events.filter(part == i), place, lambda i: late.start_late_stream(
        _typed_stream(spark, place, events.schema), f"{place}/late", f"{place}/checkpoint", f"{place.rsplit('/', 1)[-1]}-{i}",
        window="1 hour", watermark=LATE_DELAY))
    return late.read_late_rows(spark, f"{place}/late", events.schema)


@query()
def stream_repeat_records(spark, folder):
    """Every repeated record once, over slices of time with a restart between them."""
    place = session.scratch_dir(spark, "history")
    events = derived.ad_events(spark, folder).select("event_id", "event_timestamp", "campaign_id", "event_type")
    part = _time_slice(events)

    def start(i):
        keyed = dedupe.with_record_key(_typed_stream(spark, place, events.schema), "campaign_id", "event_type")
        found = repeat_history.repeated_within(keyed, "record_key", "event_timestamp", "400 days", "1 minute")
        return (found.writeStream.outputMode("append").trigger(availableNow=True).option("checkpointLocation", f"{place}/checkpoint")
                .format("parquet").option("path", f"{place}/out").start())

    _in_slices(lambda i: events.filter(part == i), place, start)
    return spark.read.schema(repeat_history.OUTPUT).parquet(f"{place}/out").select("record_key", "occurrence")


@query()
def stream_state_matches_table(spark, folder):
    """The totals in the state of a stopped stream, read back, beside those that its table holds."""
    place = session.scratch_dir(spark, "state")
    stats = stats_job.event_stats(derived.event_messages(_event_stream(spark, folder)), "1 day", "400 days")
    stats_job.start_stats_stream(stats, f"{place}/table", f"{place}/checkpoint", place.rsplit("/", 1)[-1], processing_time=None).awaitTermination()
    held = stats_job.state_totals(spark, f"{place}/checkpoint")
    table = stats_table.latest_stats(stats_table.read_versions(spark, f"{place}/table", stats.schema))
    both = table.join(held, ["campaign_id", "event_type", "window_start_time"], "full")
    return _doubles(both, "total_bid_amount", "state_bid_amount").select(
        "campaign_id", "event_type", "window_start_time", "event_count", "total_bid_amount", "state_count", "state_bid_amount")


# --- full rows, and bounds of what is served --------------------------------------------------------


@query()
def parsed_event_fields(spark, folder):
    """All declared fields of the parsed messages."""
    return ingest.parse_events(derived.event_messages(derived.ad_events(spark, folder)))


@query()
def enriched_event_fields(spark, folder):
    """All fields after the defaults are filled."""
    return ingest.enrich_events(ingest.parse_events(derived.event_messages(derived.ad_events(spark, folder))))


@query()
def kpi_violations(spark, folder):
    """Daily figures outside the bounds of the served report, here of statistics with debits among the spend."""
    daily = aggregate.totals_by_day(_stats(spark, folder).withColumn("total_bid_amount", F.col("total_bid_amount") - 60))
    rules = {n: r for n, r in quality.KPI_RULES.items() if r.split(" ")[0] in daily.columns}
    return quality.constraint_violations(daily, rules).select(F.col("day"), F.concat_ws(",", "violations").alias("violations"))


@query()
def health_violations(spark, folder):
    """Runs of a pipeline whose figures are outside the bounds of the served health report."""
    runs = derived.raw_processing_runs(spark, folder).select(
        "job_id", F.lit(0).alias("data_freshness_seconds"), (F.col("quality_score") + 1).alias("etl_success_rate"),
        F.col("quality_score").alias("data_quality_score"))
    return quality.constraint_violations(runs, quality.HEALTH_RULES).select("job_id", F.concat_ws(",", "violations").alias("violations"))
