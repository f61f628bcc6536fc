"""Versioned tables, the kept summary, the batch ledger, late rows and bounded histories."""

from __future__ import annotations

import json
import os
import random
from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from campanile import schemas
from campanile.operators import aggregate, quality
from campanile.sinks import files, stored
from campanile.streaming import batch_ingest, late, repeat_history
from tests.helpers import at, plan, rows, stats_frame, stats_row, table

VALUES = ("campaign_id", "device_type", "event_count", "total_sales_amount_euro")


def facts(spark, *made):
    return stats_frame(spark, *made)


def hour(campaign, count, start, device=None, sales=0):
    return stats_row(campaign, "click", count, count, sales, start, start[:14] + "59:00", device=device)


@pytest.fixture()
def by_device(spark, folder):
    return stored.stats_table(spark, f"{folder}/table", ("device_type",), sales=True)


def test_dimensions_are_part_of_the_key_and_revenue_is_kept(spark, by_device):
    write = by_device.writer()
    write(facts(spark, hour("a", 1, "2024-01-01 10:00:00", "Phone", 5), hour("a", 2, "2024-01-01 10:00:00", "Desktop", 7)), 0)
    by_device.compact()
    write(facts(spark, hour("a", 4, "2024-01-01 10:00:00", "Phone", 9)), 1)
    wanted = [("a", "Desktop", 2, Decimal("7.000000")), ("a", "Phone", 4, Decimal("9.000000"))]
    assert table(by_device.current(), *VALUES) == wanted
    by_device.compact()
    assert table(by_device.current(), *VALUES) == wanted and by_device.current().filter("updated_at IS NULL").count() == 0


def test_a_null_dimension_is_a_key_of_its_own(spark, by_device):
    by_device.writer()(facts(spark, hour("a", 1, "2024-01-01 10:00:00")), 0)
    by_device.compact()
    by_device.writer()(facts(spark, hour("a", 3, "2024-01-01 10:00:00"), hour("a", 2, "2024-01-01 10:00:00", "x")), 1)
    assert table(by_device.current(), "device_type", "event_count") == [("x", 2), (None, 3)]


def test_empty_batches_leave_nothing_and_an_empty_table_reads(spark, by_device, folder):
    assert by_device.current().count() == 0 and by_device.compact().version == 0
    by_device.writer()(facts(spark, hour("a", 1, "2024-01-01 10:00:00")).limit(0), 0)
    assert files.names(spark, f"{folder}/table/batches") == []
    assert stored.purge_expired(by_device, "2024-04-01 00:00:00") == 0


def test_only_touched_days_are_rewritten_and_read(spark, by_device, folder):
    write = by_device.writer()
    write(facts(spark, hour("a", 1, "2024-01-01 10:00:00"), hour("a", 1, "2024-01-02 10:00:00")), 0)
    by_device.compact()
    write(facts(spark, hour("a", 5, "2024-01-02 10:00:00"), hour("a", 1, "2024-01-03 10:00:00")), 1)
    made = by_device.compact()
    assert made.parts == {"2024-01-01": 1, "2024-01-02": 2, "2024-01-03": 2} and made.notes["through"] == 1
    day = stored.stats_between(by_device, "2024-01-02 00:00:00", "2024-01-02 23:00:00")
    assert rows(day, "event_count") == [(5,)]
    assert all("stats_date=2024-01-02" in f for f in day.inputFiles())
    assert "Aggregate" not in plan(day)


def test_folded_batches_and_old_versions_are_retired_one_version_later(spark, by_device, folder):
    for n in range(4):
        by_device.writer()(facts(spark, hour("a", n, "2024-01-01 10:00:00")), n)
        reader = by_device.current()
        by_device.compact()
        assert rows(reader, "event_count") == [(n,)]  # planned before the version that folds its batch
    assert files.names(spark, f"{folder}/table/batches") == ["batch=3"]
    assert files.names(spark, f"{folder}/table/snapshots") == ["version=3", "version=4"]
    assert files.names(spark, f"{folder}/table/manifests") == ["3", "4"]


def test_a_crash_between_write_and_publish_changes_nothing(spark, by_device, monkeypatch, folder):
    write = by_device.writer()
    write(facts(spark, hour("a", 1, "2024-01-01 10:00:00"), hour("b", 1, "2024-01-01 10:00:00")), 0)
    by_device.compact()
    write(facts(spark, hour("a", 2, "2024-01-01 10:00:00")), 1)
    before = table(by_device.current(), *VALUES)

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(files, "publish_text", crash)
        with pytest.raises(OSError, match="lost"):
            by_device.compact()
    assert by_device.manifest().version == 1 and table(by_device.current(), *VALUES) == before
    assert files.exists(spark, f"{folder}/table/snapshots/version=2")
    write(facts(spark, hour("c", 7, "2024-01-02 10:00:00")), 2)
    assert by_device.compact().version == 2
    assert table(by_device.current(), *VALUES) == sorted(before + [("c", None, 7, Decimal("0.000000"))], key=repr)


def test_unfinished_and_replayed_batches(spark, by_device, folder):
    write = by_device.writer()
    write(facts(spark, hour("a", 1, "2024-01-01 10:00:00")), 0)
    write(facts(spark, hour("a", 2, "2024-01-01 10:00:00")), 1)
    files.delete(spark, f"{folder}/table/batches/batch=1/_SUCCESS")
    assert table(by_device.current(), "event_count") == [(1,)]
    write(facts(spark, hour("a", 2, "2024-01-01 10:00:00")), 1)
    by_device.compact()
    write(facts(spark, hour("a", 2, "2024-01-01 10:00:00")), 1)  # run again after it was folded in
    assert table(by_device.current(), "event_count") == [(2,)]


def test_purged_rows_stay_away(spark, by_device):
    write = by_device.writer()
    old, edge, new = hour("a", 1, "2024-01-01 11:00:00"), hour("b", 2, "2024-01-01 12:00:00"), hour("c", 3, "2024-01-05 00:00:00")
    write(facts(spark, old, edge, new, hour("d", 4, "2023-06-01 00:00:00")), 0)
    assert stored.purge_expired(by_device, "2024-03-31 12:00:00") == 2
    write(facts(spark, old, hour("b", 9, "2024-01-01 12:00:00")), 1)
    wanted = [("b", 9), ("c", 3)]
    assert table(by_device.current(), "campaign_id", "event_count") == wanted
    by_device.compact()
    assert table(by_device.current(), "campaign_id", "event_count") == wanted
    assert stored.purge_expired(by_device, "2024-03-31 12:00:00") == 0
    assert sorted(by_device.manifest().parts) == ["2024-01-01", "2024-01-05"]


# --- summary --------------------------------------------------------------------------------------


def test_the_kept_summary_equals_the_full_one_and_redoes_changed_days(spark, folder):
    kept_table = stored.stats_table(spark, f"{folder}/table")
    kept = stored.KeptSummary(kept_table, f"{folder}/summary")
    write = kept_table.writer()
    steps = [
        (lambda: write(facts(spark, hour("a", 3, "2024-01-01 10:00:00"), hour("a", 1, "2024-01-02 10:00:00"), hour("b", 2, "2024-01-02 11:00:00")), 0),
         ["2024-01-01", "2024-01-02"]),
        (lambda: write(facts(spark, hour("a", 7, "2024-01-02 10:00:00")), 1), ["2024-01-02"]),
        (lambda: None, []),
        (lambda: write(facts(spark, hour("a", 0, "2024-04-10 10:00:00")), 2), ["2024-04-10"]),
        (lambda: stored.purge_expired(kept_table, "2024-04-01 10:30:00"), None),
    ]
    for step, changed in steps:
        step()
        redone = kept.refresh()
        assert changed is None or redone == changed
        whole = aggregate.campaign_summary(kept_table.current())
        assert table(kept.summary().select(*whole.columns)) == table(whole)
    assert rows(kept.summary().filter("first_event_time < '2024-01-02 10:30:00'")) == []


# --- ingest rules ---------------------------------------------------------------------------------


def envelope(batch, n=1, source="s"):
    made = [{"event_id": str(i), "timestamp": "2024-01-01T10:00:00Z", "event_name": "click", "attributes": {}} for i in range(n)]
    return json.dumps({"batch_id": batch, "source": source, "events": made})


class Batches:
    """A stream of envelopes, one file and trigger for each call."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.sent = spark, folder, 0
        self.ledger = batch_ingest.batch_ledger(spark, f"{folder}/ledger", buckets=4)

    def send(self, *values):
        made = [(v, self.sent + i) for i, v in enumerate(values)]
        self.sent += len(made)
        self.spark.createDataFrame(made, "value string, arrival int").coalesce(1).write.mode("append").parquet(f"{self.folder}/in")
        return self.run()

    def run(self):
        stream = self.spark.readStream.schema("value string, arrival int").parquet(f"{self.folder}/in")
        query = batch_ingest.start_ingest_stream(stream, f"{self.folder}/out", self.ledger, f"{self.folder}/checkpoint", f"ingest{id(self)}",
                                                 "arrival", fold_every=2, max_events=2)
        query.awaitTermination()
        return self

    def judged(self):
        return table(self.spark.read.parquet(f"{self.folder}/out"), "arrival", "batch_id", "reject_field", "reject_reason")

    def batch(self):
        whole = quality.ingest_batches(self.spark.read.parquet(f"{self.folder}/in"), "arrival", max_events=2)
        return table(whole, "arrival", "batch_id", "reject_field", "reject_reason")


def test_ingest_over_triggers_equals_the_batch_rules(spark, folder):
    sent = Batches(spark, folder)
    sent.send(envelope("x"), envelope("y", 3), "{broken", envelope("x"))
    sent.send(envelope("y"), envelope("x"), envelope("z", source=None), envelope(None))
    sent.send(envelope("z"), envelope("y")).send(envelope("z"), envelope("w")).send(envelope("w"), envelope("x"))
    assert sent.judged() == sent.batch()
    assert [r[3] for r in sent.judged()].count("duplicate batch") == 6
    assert sent.ledger.manifest().version == 2  # folded before micro-batches 2 and 4


def test_a_replayed_ingest_batch_gives_the_same(spark, folder):
    sent = Batches(spark, folder).send(envelope("x")).send(envelope("y"), envelope("x"))
    before = sent.judged()
    for name in ("1", ".1.crc"):
        os.remove(f"{folder}/checkpoint/commits/{name}")
    assert sent.run().judged() == before == sent.batch()


# --- late rows ------------------------------------------------------------------------------------


def test_late_rows_are_those_behind_the_watermark_of_earlier_batches(spark, folder):
    write = late.late_writer(f"{folder}/late", window="1 minute", watermark="1 minute")
    batches = [["10:00:00", "10:05:30"], ["10:03:59", "10:04:10", "10:09:00", None], [], ["10:07:00", "10:06:59", "10:08:10"]]

    def frame(times):
        return spark.createDataFrame([(t and at(f"2024-01-01 {t}"), t) for t in times], "event_timestamp timestamp, id string")

    for n, times in enumerate(batches):
        write(frame(times), n)
    read = lambda: table(late.read_late_rows(spark, f"{folder}/late", frame([]).schema), "batch", "id", "watermark")
    wanted = [(1, "10:03:59", at("2024-01-01 10:04:30")), (3, "10:06:59", at("2024-01-01 10:08:00")), (3, "10:07:00", at("2024-01-01 10:08:00"))]
    assert read() == wanted
    write(frame(batches[3]), 3)  # a replay doesn't see its own times
    assert read() == wanted


# --- bounded history ------------------------------------------------------------------------------


def test_a_history_forgets_keys_that_stay_away(spark, folder):
    def send(*made):
        data = [(k, at(f"2024-01-01 {t}")) for k, t in made]
        spark.createDataFrame(data, "k string, t timestamp").coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema("k string, t timestamp").parquet(f"{folder}/in")
        found = repeat_history.repeated_within(stream, "k", "t", "1 hour", "1 minute")
        (found.writeStream.outputMode("append").trigger(availableNow=True).option("checkpointLocation", f"{folder}/checkpoint")
         .format("parquet").option("path", f"{folder}/out").start().awaitTermination())
        return table(spark.read.schema(repeat_history.OUTPUT).parquet(f"{folder}/out"), "record_key", "occurrence")

    assert send(("a", "10:00:00"), ("b", "10:00:00"), ("a", "10:01:00"), (None, "10:00:00")) == [("a", 2)]
    assert send(("a", "10:40:00"), ("c", "10:41:00")) == [("a", 2), ("a", 3)]
    send(("d", "11:30:00"))  # b is forgotten, a isn't
    assert send(("b", "11:35:00"), ("a", "11:36:00")) == [("a", 2), ("a", 3), ("a", 4)]


def test_histories_travel_in_blocks_of_keys(spark, folder):
    spark.createDataFrame([("a", at("2024-01-01 10:00:00"))], "k string, t timestamp").write.parquet(f"{folder}/in")
    found = repeat_history.repeated_within(spark.readStream.schema("k string, t timestamp").parquet(f"{folder}/in"), "k", "t", "1 hour", "1 minute")
    logical = found._jdf.queryExecution().logical().toString()
    assert "FlatMapGroupsInPandasWithState" in logical and "TransformWithState" not in logical


def test_histories_of_many_keys_are_few_values(spark, folder):
    """Against counters of Python: more keys than buckets, buckets of several blocks, keys that are forgotten, late rows."""
    rng, start, keep, delay = random.Random(1), at("2024-01-01 10:00:00"), timedelta(hours=1), timedelta(minutes=1)
    keys = ["hot"] * 500 + [f"k{i}:ü" for i in range(3000)]
    held, mark, wanted, values = {}, at("1970-01-01 00:00:00"), [], []
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")
    try:
        for n in range(4):
            made = [(rng.choice(keys), start + timedelta(minutes=n * 40, seconds=rng.randrange(2400))) for _ in range(4000)]
            made += [(None, start), ("late", at("2024-01-01 10:30:00")), (rng.choice(keys), None)]
            spark.createDataFrame(made, "k string, t timestamp").coalesce(1).write.mode("append").parquet(f"{folder}/in")
            found = repeat_history.repeated_within(spark.readStream.schema("k string, t timestamp").parquet(f"{folder}/in"), "k", "t", "1 hour", "1 minute")
            query = (found.writeStream.outputMode("append").trigger(availableNow=True).option("checkpointLocation", f"{folder}/checkpoint")
                     .format("parquet").option("path", f"{folder}/out").start())
            query.awaitTermination()
            for k, t in made:
                if k and t and t > mark:
                    count, last = held.get(k, (0, t))
                    held[k] = count + 1, max(last, t)
                    wanted += [(k, count + 1)] if count else []
            mark = max(t for k, t in made if k and t) - delay
            held = {k: (count, last) for k, (count, last) in held.items() if last + keep >= mark}
            values.append(query.lastProgress.stateOperators[0].numRowsTotal)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = spark.read.schema(repeat_history.OUTPUT).parquet(f"{folder}/out")
    assert table(got, "record_key", "occurrence") == sorted(wanted, key=repr)
    assert len({k for k, _ in wanted}) > 1024 >= max(values)
    assert got.filter("record_time IS NULL").count() == 0 and "late" not in {k for k, _ in wanted}
