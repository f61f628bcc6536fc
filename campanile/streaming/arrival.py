"""Statistics by arrival time, for events whose own time is not trusted."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from campanile.operators.aggregate import aggregate_events


def aggregate_by_arrival(events: DataFrame, window: str = "1 minute", watermark: str = "1 minute") -> DataFrame:
    """Count and spend per slot of processing time.

    All rows of a micro-batch arrive at the time its trigger fired.  Slots are
    fixed, so restarts do not shift them and no event falls between two.
    """
    arrived = events.withColumn("arrival", F.current_timestamp())
    return aggregate_events(arrived, window, watermark, time_col="arrival")
