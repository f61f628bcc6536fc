"""Each repeated record of a stream, once, from a history that is bounded in time.

The history of a key is a counter and the time of its last record.  Keys are dealt into buckets by hash, and the histories of
a bucket are one value in Spark's state store, so a micro-batch costs calls for each bucket and not for each key.  A history is
dropped when the watermark has passed that time by ``keep``.  Rows of a bucket pass one task, a block at a time; where only numbers
matter, :func:`campanile.streaming.repeats.key_counts` combines them before the shuffle.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTPUT = "record_key string, occurrence bigint, record_time timestamp"
#: An Arrow stream with the columns record_key, records and last_ms.
HISTORIES = "histories binary"


def _pack(histories: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, histories.schema) as stream:
        stream.write_batch(histories)
    return out.getvalue().to_pybytes()


def _unpack(packed: bytes) -> tuple[list[str], np.ndarray, np.ndarray]:
    keys, records, last = pa.ipc.open_stream(packed).read_next_batch().columns
    return keys.to_pylist(), np.array(records), np.array(last)


def numbered(keep_ms: int) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """Numbers the records of each key of a bucket and emits the second and later ones."""
    def number(_bucket: tuple, blocks: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        none = np.empty(0, np.int64)
        keys, records, last = _unpack(held.get[0]) if held.exists else ([], none, none)
        place = {key: i for i, key in enumerate(keys)}
        for block in filter(len, blocks):  # a timeout comes without rows
            of, found = pd.factorize(block["record_key"])
            at = np.fromiter((place.setdefault(key, len(place)) for key in found), np.int64, len(found))
            new = len(place) - len(records)
            records, last = np.append(records, np.zeros(new, np.int64)), np.append(last, np.full(new, -1))
            # The rows by key, each key in order of arrival.
            order, counts = np.argsort(of, kind="stable"), np.bincount(of)
            start = np.cumsum(counts) - counts
            occurrence = np.empty(len(of), np.int64)
            occurrence[order] = np.arange(1, len(of) + 1) + np.repeat(records[at] - start, counts)
            records[at] += counts
            last[at] = np.maximum(last[at], np.maximum.reduceat(block["record_ms"].to_numpy()[order], start))
            again = occurrence > 1
            if again.any():
                yield pd.DataFrame({"record_key": block["record_key"][again], "occurrence": occurrence[again],
                                    "record_time": block["record_time"][again]})
        kept = last + keep_ms >= held.getCurrentWatermarkMs()
        if kept.any():
            histories = pa.record_batch([pa.array(place, pa.string()), records, last], ["record_key", "records", "last_ms"])
            held.update((_pack(histories if kept.all() else histories.filter(pa.array(kept))),))
            held.setTimeoutTimestamp(int(last[kept].min()) + keep_ms)
        elif held.exists:
            held.remove()

    return number


def repeated_within(records: DataFrame, key: str, time_col: str, keep: str, watermark: str, buckets: int = 1024) -> DataFrame:
    """``record_key, occurrence, record_time`` of every record after the first of its key.

    ``keep`` bounds the history: a key without a record for that long, by the watermark, counts from one again.
    Rows without a key or time are skipped, and such as are later than the watermark are dropped.  A task holds the histories
    of a bucket at a time and writes them whole, so many millions of keys want more ``buckets``; a checkpoint keeps their number.
    """
    # The function travels by value, so executors need not have this package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    keep_ms = records.sparkSession.sql(
        f"SELECT unix_millis(TIMESTAMP '1970-01-01 00:00:00Z' + INTERVAL {keep}) AS ms").first()["ms"]
    rows = records.filter(F.col(key).isNotNull() & F.col(time_col).isNotNull()).select(
        F.col(key).cast("string").alias("record_key"), F.col(time_col).alias("record_time"))
    dealt = rows.withWatermark("record_time", watermark).withColumns({
        "record_ms": F.unix_millis("record_time"), "bucket": F.pmod(F.xxhash64("record_key"), F.lit(buckets))})
    return dealt.groupBy("bucket").applyInPandasWithState(
        numbered(keep_ms), OUTPUT, HISTORIES, "append", GroupStateTimeout.EventTimeTimeout)
