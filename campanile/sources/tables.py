"""Relational tables: Parquet, JDBC and parameterised SQL over views."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_jdbc(
    spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None,
    partition_column: str | None = None, lower: str | None = None, upper: str | None = None,
    partitions: int = 1,
) -> DataFrame:
    """Scan a database table, in parallel when a partition column is given."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **(properties or {}))
    if partition_column:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=lower, upperBound=upper,
            numPartitions=str(partitions),
        )
    return reader.load()


def run_sql(spark: SparkSession, query: str, tables: Mapping[str, DataFrame], **params) -> DataFrame:
    """A report given as SQL; tables are passed by name, values as parameters.

    Tables are referred to as ``{name}`` and values as ``:name``.
    """
    return spark.sql(query, args=params or None, **tables)
