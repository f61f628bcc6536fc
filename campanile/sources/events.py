"""Event sources: message bus, JSON lines and the generated stream."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from campanile import schemas

#: Bus options the stream starts from; callers override any of them.  Lost data stops the stream.
BUS_DEFAULTS = {"failOnDataLoss": "true", "startingOffsets": "earliest"}


def read_event_stream(
    spark: SparkSession, fmt: str = "kafka", options: Mapping[str, str] | None = None,
    path: str | None = None,
) -> DataFrame:
    """Streaming messages with a string column ``value``.

    Intake is not limited unless the caller asks for it, by ``maxOffsetsPerTrigger`` for a
    bus or ``maxFilesPerTrigger`` for folders.  ``fmt="kafka"`` needs the connector on the class path and at least
    ``kafka.bootstrap.servers`` and ``subscribe``.  Folders of JSON lines are
    read with ``fmt="text"``; ``value`` is then one line.
    """
    defaults = BUS_DEFAULTS if fmt == "kafka" else {}
    reader = spark.readStream.format(fmt).options(**{**defaults, **(options or {})})
    raw = reader.load(path) if path else reader.load()
    return raw.withColumn("value", F.col("value").cast("string"))


def read_events_json(spark: SparkSession, path: str, streaming: bool = False, **options: str) -> DataFrame:
    """Typed events from JSON lines, with the declared schema (no inference)."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(schemas.EVENT).options(**options).json(path)


def read_table_stream(spark: SparkSession, folder: str, name: str, schema, **options: str) -> DataFrame:
    """Stream a Parquet table ``{folder}/{name}.parquet``, a file or a folder of part files."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet")
    status = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path)
    # A plain path is taken as the base of partitions, which must be a folder; a pattern may match one file.
    place = f"{folder}/{name}.parquet" if status.isDirectory() else f"{folder}/[{name[0]}]{name[1:]}.parquet"
    return spark.readStream.schema(schema).options(**options).parquet(place)


def generated_event_stream(spark: SparkSession, rows_per_second: int = 100, campaigns: int = 20) -> DataFrame:
    """Mock events from the built-in rate source, for demonstrations."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return generated_events(rate, campaigns)


def generated_events(rate: DataFrame, campaigns: int = 20) -> DataFrame:
    """Project ``(timestamp, value)`` rows onto the event schema."""
    n = F.col("value")
    kind = F.element_at(
        F.array(F.lit("impression"), F.lit("click"), F.lit("conversion")), (n % 3 + 1).cast("int")
    )
    made = rate.select(
        "timestamp",
        F.concat(F.lit("campaign_"), n % campaigns).alias("campaign_id"),
        kind.alias("event_type"),
        F.concat(F.lit("user_"), n % 1000).alias("user_id"),
        ((n % 100) / 100).alias("bid_amount_usd"),
    )
    missing = [f for f in schemas.EVENT.fields if f.name not in made.columns]
    made = made.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
    return made.select(*schemas.EVENT.names)


def preview(df: DataFrame, rows: int, order_by: str | None = None) -> DataFrame:
    """First rows only, nothing written."""
    return (df.orderBy(order_by) if order_by else df).limit(rows)
