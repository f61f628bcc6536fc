"""From raw messages to enriched events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from campanile import schemas
from campanile.functions import with_parsed

# Fill for absent text, category, amount and flag fields.
UNKNOWN = "unknown"
TEXT_FILLED = ("device_type", "country_code", "product_brand", "product_age_group")


def parse_events(messages: DataFrame) -> DataFrame:
    """JSON ``value`` to typed columns, with ``event_timestamp`` added.

    Unknown fields are ignored, absent ones are NULL; malformed messages give a
    row of NULLs (:mod:`campanile.operators.quality` separates those).
    """
    text = messages.select(F.col("value").cast("string").alias("value"))
    parsed = with_parsed(text, "e", F.from_json("value", schemas.EVENT))
    return parsed.select("e.*").withColumn("event_timestamp", F.col("timestamp"))


def enrich_events(events: DataFrame) -> DataFrame:
    """Fill defaults and settle the spend as ``total_bid_amount``."""
    return (
        events.withColumn(
            "total_bid_amount", F.coalesce("spend_usd", "bid_amount_usd", F.lit(0.0))
        )
        .fillna(UNKNOWN, subset=list(TEXT_FILLED))
        .fillna(0, subset=list(schemas.CATEGORIES))
        .fillna(0.0, subset=["sales_amount_euro"])
        .fillna(False, subset=["sale"])
    )


def parse_event_batches(messages: DataFrame, nested: bool = False) -> DataFrame:
    """Envelope JSON to ``batch_id``, ``source`` and the ``events`` array.

    Free attributes are a map of texts, or, if ``nested``, a variant that keeps their shape and types.
    """
    parsed = with_parsed(messages, "b", F.from_json("value", schemas.NESTED_ENVELOPE if nested else schemas.ENVELOPE))
    return parsed.select(*messages.columns, "b.*")


def explode_event_batches(batches: DataFrame) -> DataFrame:
    """One row per event of an envelope; free attributes stay a map."""
    return batches.select("batch_id", "source", F.inline("events"))


def attribute_paths(events: DataFrame, depth: int = 3) -> DataFrame:
    """How often each path of the nested attributes has which type, by ``event_name``; objects are entered ``depth`` deep.

    Types are those of JSON: BIGINT, DOUBLE, DECIMAL, STRING, BOOLEAN, VOID for null, ARRAY and OBJECT.
    """
    level = events.select("event_name", F.lit("").alias("above"), F.col("attributes").alias("node"))
    found = []
    for _ in range(depth):
        level = events.sparkSession.sql(
            "SELECT event_name, above || '.' || t.key AS above, t.value AS node, regexp_extract(schema_of_variant(t.value), '^[A-Z]+', 0) AS type "
            "FROM {level}, LATERAL variant_explode(node) AS t WHERE t.key IS NOT NULL", level=level)
        found.append(level.select("event_name", F.substring("above", 2, 1 << 30).alias("path"), "type"))
        level = level.filter("type = 'OBJECT'").select("event_name", "above", "node")
    paths = found[0]
    for more in found[1:]:
        paths = paths.unionByName(more)
    return paths.groupBy("event_name", "path", "type").agg(F.count("*").alias("event_count"))


def pack_event_batches(batches: DataFrame) -> DataFrame:
    """The inverse of :func:`parse_event_batches`: one JSON message per row."""
    return batches.select(F.to_json(F.struct("batch_id", "source", "events")).alias("value"))
