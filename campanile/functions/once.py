"""Costly expressions that must run once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def with_parsed(df: DataFrame, name: str, expression: Column) -> DataFrame:
    """Add a column that later filters and projections do not repeat.

    Spark moves a filter below the projection it reads from and puts the whole
    expression in its place, once per field the filter uses; a parser would then
    run many times per row.  It does not move filters below a generator, and a
    generator over one element keeps every row.
    """
    return df.select("*", F.explode(F.array(expression)).alias(name))
