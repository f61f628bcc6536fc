"""Throughput on inputs larger than the test tables; prints one JSON line.

The inputs are multiples of the event and order tables, written once to a new
temporary folder: ``python bench_scale.py [event copies] [hourly copies]``.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from campanile import schemas  # noqa: E402
from campanile.operators import aggregate, dedupe, ingest, quality  # noqa: E402
from campanile.plans import reports  # noqa: E402
from campanile.plans.top_campaigns import top_campaigns  # noqa: E402
from campanile.session import build_session  # noqa: E402
from campanile.sinks import stats_table  # noqa: E402
from campanile.sources import derived, events as sources  # noqa: E402
from campanile.streaming import stats_job  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 100
    hourly_copies = int(sys.argv[2]) if len(sys.argv) > 2 else 17
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "campanile-scale", f"local[{cpus}]", spark__ui__enabled="false", spark__sql__shuffle__partitions=cpus,
        spark__ui__showConsoleProgress="false", spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    place = tempfile.mkdtemp(prefix="campanile-scale-")
    found: dict[str, float] = {}

    # Events: copies of the table, a minute apart, a third of the copies under one campaign.
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
    events = derived.ad_events(spark, FOLDER).repartition(32).select("*", copy).withColumns({
        "event_timestamp": F.timestamp_seconds(F.unix_seconds("event_timestamp") + F.col("copy") * 60),
        "campaign_id": F.when(F.col("copy") % 3 == 0, "campaign_hot").otherwise(F.col("campaign_id")),
        "total_bid_amount": F.col("spend_usd"),
    })
    events.write.parquet(f"{place}/events")
    big = spark.read.parquet(f"{place}/events")
    rows = big.count()
    found["events"] = rows

    def rate(name: str, df, count: int = rows) -> None:
        noop(df)
        seconds = min(timed(lambda: noop(df)) for _ in range(2))
        found[f"{name}_seconds"] = round(seconds, 2)
        found[f"{name}_rows_per_second"] = round(count / seconds)

    rate("minute_stats", aggregate.aggregate_events(big))
    daily = aggregate.aggregate_events(big, "1 day", sales=True).withColumn("spend_usd", F.col("total_bid_amount"))
    rate("platform_kpis", reports.platform_kpis(daily))
    rate("repeats", dedupe.repeated_records(
        big.select("campaign_id", "event_type", dedupe.file_position().alias("arrival")),
        ["campaign_id", "event_type"], "arrival"))

    # Messages: a tenth of the events as JSON lines, in batch and as a stream.
    part = big.filter(F.col("copy") < max(copies // 10, 1))
    derived.event_messages(part.drop("copy", "total_bid_amount")).select("value").write.text(f"{place}/messages")
    lines = spark.read.text(f"{place}/messages")
    count = lines.count()
    found["messages"] = count
    checked = quality.accepted(quality.quarantine_events(lines))
    rate("message_stats", aggregate.aggregate_events(ingest.enrich_events(checked)), count)

    stream = sources.read_event_stream(spark, "text", {"maxFilesPerTrigger": "8"}, f"{place}/messages")
    # Files are in no time order, so the watermark spans the whole range.
    stats = stats_job.event_stats(stream, watermark="60 days")
    query = stats_job.start_stats_stream(stats, f"{place}/table", f"{place}/checkpoint", "scale", processing_time=None)
    seconds = timed(query.awaitTermination)
    found["stream_seconds"] = round(seconds, 2)
    found["stream_rows_per_second"] = round(count / seconds)
    batches = [json.loads(p.json)["batchDuration"] / 1000 for p in query.recentProgress if p.numInputRows]
    found["stream_batch_seconds"] = [round(b, 2) for b in batches]
    current = stats_table.latest_stats(stats_table.read_versions(spark, f"{place}/table", schemas.STATS))
    found["stream_equals_input"] = current.agg(F.sum("event_count")).first()[0] == count

    # Hourly facts: copies of the order history under other campaigns.
    copy = F.explode(F.sequence(F.lit(0), F.lit(hourly_copies - 1))).alias("copy")
    hourly = derived.hourly_performance(spark, FOLDER).repartition(16).select("*", copy).withColumn(
        "campaign_id", F.concat_ws("_", "campaign_id", "copy")).drop("copy")
    hourly.repartitionByRange(16, "hour_timestamp").sortWithinPartitions("hour_timestamp").write.parquet(f"{place}/hourly")
    facts = spark.read.parquet(f"{place}/hourly")
    found["hourly_rows"] = facts.count()
    rate("top_campaigns_all_days", top_campaigns(facts, "1995-01-01", "2002-01-01"), found["hourly_rows"])
    rate("top_campaigns_one_month", top_campaigns(facts, "1995-07-01", "1995-08-01"), found["hourly_rows"])
    print(json.dumps({"cpus": cpus, **found}))
    spark.stop()


if __name__ == "__main__":
    main()
