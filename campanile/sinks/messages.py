"""Message sink: keyed JSON."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

# Wait for all replicas before a send counts as done.
BUS_DEFAULTS = {"kafka.acks": "all"}


def to_messages(df: DataFrame, key_col: str = "campaign_id") -> DataFrame:
    """Key and JSON value of each row; equal keys go to the same bus partition."""
    return df.select(F.col(key_col).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def write_messages(
    messages: DataFrame, fmt: str = "kafka", path: str | None = None, options: Mapping[str, str] | None = None,
) -> None:
    """Send messages to the bus, or append them as lines of text to a folder."""
    if fmt == "kafka":
        messages.write.format(fmt).options(**{**BUS_DEFAULTS, **(options or {})}).save()
    else:
        messages.select("value").write.mode("append").text(path)
