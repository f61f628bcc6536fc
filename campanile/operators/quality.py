"""Validation: malformed messages, constraints and batch ingest rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from campanile import schemas
from campanile.functions import with_parsed
from campanile.operators.dedupe import flag_repeats
from campanile.operators.ingest import parse_event_batches

REQUIRED_FIELDS = ("timestamp", "campaign_id", "event_type")
# Limits of one ingest batch.
MAX_BATCH_EVENTS = 1000
MAX_BATCH_BYTES = 5 * 1024 * 1024

# Amounts must fit the money type.
AMOUNT_LIMIT = 1e12

# Constraints of the stored tables and of served figures, by rule name the condition that must hold.
STATS_RULES = {
    "event_count_not_negative": "event_count >= 0",
    "total_bid_amount_not_negative": "total_bid_amount >= 0",
    "window_end_after_start": "window_end_time >= window_start_time",
}
METADATA_RULES = {
    "end_not_before_start": "end_date >= start_date",
    "budget_not_negative": "budget_usd >= 0",
    "priority_in_range": "priority BETWEEN 1 AND 10",
    "target_ctr_is_fraction": "target_ctr BETWEEN 0 AND 1",
    "campaign_type_known": "campaign_type IN ('standard', 'premium', 'test', 'pilot')",
}
RUN_RULES = {
    "status_known": "status IN ('success', 'failed', 'running', 'pending')",
    "quality_score_is_percent": "quality_score BETWEEN 0 AND 100",
}
KPI_RULES = {
    name + "_not_negative": f"{name} >= 0"
    for name in ("impressions", "clicks", "conversions", "ctr", "spend_usd", "revenue_euro",
                 "roas", "cpa", "conversion_rate")
}
HEALTH_RULES = {
    "freshness_not_negative": "data_freshness_seconds >= 0",
    "success_rate_is_percent": "etl_success_rate BETWEEN 0 AND 100",
    "quality_score_is_percent": "data_quality_score BETWEEN 0 AND 100",
}


def first_reason(*rules: tuple[str, Column]) -> Column:
    """Name of the first rule whose condition holds, NULL when none does."""
    return F.coalesce(*[F.when(broken, F.lit(name)) for name, broken in rules])


def validate_events(messages: DataFrame) -> DataFrame:
    """Add ``reject_reason``: malformed JSON or an absent required field.

    A field that is there with the value null counts as present.
    """
    checked = with_parsed(messages, "_fields", F.from_json("value", "map<string,string>"))
    absent = [
        (f"missing {name}", ~F.map_contains_key("_fields", name)) for name in REQUIRED_FIELDS
    ]
    reason = first_reason(("malformed json", F.col("_fields").isNull()), *absent)
    return checked.withColumn("reject_reason", reason).drop("_fields")


def quarantine_events(messages: DataFrame) -> DataFrame:
    """Parsed events with every reason that keeps a row out of the statistics.

    Adds to :func:`validate_events`: required values that are null or not of
    their type, and amounts that do not fit the money type.  Sound messages are
    parsed once; blank text counts as a value; only those lacking a required value are looked at again to
    tell malformed, absent and null apart.
    """
    parsed = with_parsed(messages, "e", F.from_json("value", schemas.EVENT))
    lacking = F.lit(False)
    for name in REQUIRED_FIELDS:
        lacking = lacking | F.col(f"e.{name}").isNull()
    fields = F.when(lacking, F.from_json("value", "map<string,string>"))
    parsed = with_parsed(parsed, "_fields", fields)
    # Every amount that is summed: one that does not fit would stop the whole batch.
    amounts = (F.coalesce("e.spend_usd", "e.bid_amount_usd"), F.col("e.sales_amount_euro"))
    unfit = F.lit(False)
    for amount in amounts:
        unfit = unfit | F.isnan(amount) | (F.abs(amount) >= AMOUNT_LIMIT)
    reason = first_reason(
        ("malformed json", lacking & F.col("_fields").isNull()),
        *[(f"missing {name}", ~F.map_contains_key("_fields", name)) for name in REQUIRED_FIELDS],
        *[(f"null {name}", F.col(f"e.{name}").isNull()) for name in REQUIRED_FIELDS],
        ("amount out of range", unfit),
    )
    return parsed.select(
        "value", reason.alias("reject_reason"), "e.*", F.col("e.timestamp").alias("event_timestamp")
    )


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reject_reason").isNotNull())


def quality_counts(checked: DataFrame) -> DataFrame:
    """Processed and failed messages."""
    ok = F.col("reject_reason").isNull()
    return checked.agg(F.count_if(ok).alias("processed"), F.count_if(~ok).alias("failed"))


def observe_quality(checked: DataFrame, name: str = "quality") -> DataFrame:
    """Count processed and failed messages on the way, at no extra pass.

    Batch: pass the frame on and read the observation; streams report it in
    ``observedMetrics`` of each progress.
    """
    ok = F.col("reject_reason").isNull()
    return checked.observe(
        name, F.count_if(ok).alias("processed"), F.count_if(~ok).alias("failed")
    )


def constraint_violations(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Rows breaking any rule, with the names of all broken ones.

    As in SQL, a rule that evaluates to NULL is not broken.
    """
    broken = [
        F.when(~F.coalesce(F.expr(condition), F.lit(True)), F.lit(name)) for name, condition in rules.items()
    ]
    marked = df.withColumn("violations", F.array_compact(F.array(*broken)))
    return marked.filter(F.size("violations") > 0)


def null_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL in a column that must not have one, named in ``reject_reason``."""
    reason = first_reason(*[(f"null {c}", F.col(c).isNull()) for c in columns])
    return rejected(df.withColumn("reject_reason", reason))


def check_batches(messages: DataFrame, max_events: int = MAX_BATCH_EVENTS, max_bytes: int = MAX_BATCH_BYTES) -> DataFrame:
    """Parsed event batches with ``bad``, the field and the text of the first rule that one breaks by itself, else NULL."""
    parsed = parse_event_batches(messages)
    rules = (
        ("body", "payload too large", F.octet_length("value") > max_bytes),
        ("body", "malformed json", F.col("batch_id").isNull() & F.col("source").isNull() & F.col("events").isNull()),
        ("batch_id", "missing", F.col("batch_id").isNull()),
        ("source", "missing", F.col("source").isNull()),
        ("events", "missing", F.col("events").isNull()),
        ("events", "too many events", F.size("events") > max_events),
        ("events.timestamp", "invalid", F.exists("events", lambda e: e["timestamp"].isNull())),
        ("events.event_name", "missing", F.exists("events", lambda e: e["event_name"].isNull())),
    )
    reason = F.coalesce(*[
        F.when(broken, F.struct(F.lit(field).alias("field"), F.lit(text).alias("text"))) for field, text, broken in rules
    ])
    return parsed.withColumn("bad", reason)


def with_batch_verdict(judged: DataFrame, repeat: str) -> DataFrame:
    """``reject_field`` and ``reject_reason`` from ``bad`` and the flag of repeated batch ids, in place of both."""
    return judged.select(
        *[c for c in judged.columns if c not in ("bad", repeat)],
        F.when(F.col(repeat), "batch_id").otherwise(F.col("bad.field")).alias("reject_field"),
        F.when(F.col(repeat), "duplicate batch").otherwise(F.col("bad.text")).alias("reject_reason"),
    )


def ingest_batches(
    messages: DataFrame, order: str, max_events: int = MAX_BATCH_EVENTS, max_bytes: int = MAX_BATCH_BYTES,
) -> DataFrame:
    """Check event batches; adds ``reject_field`` and ``reject_reason``.

    A batch id counts as taken by its earliest batch that passes all other
    rules; later ones are duplicates.  ``order`` is the unique arrival order.
    """
    checked = check_batches(messages, max_events, max_bytes)
    judged = flag_repeats(checked, ["batch_id"], order, "_repeat", among=F.col("bad").isNull())
    return with_batch_verdict(judged, "_repeat")
