"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are folded to lower case and read as code points; runs of white space count as one
space.  All n-grams of 1 to ``MAX_N`` code points are hashed into ``BUCKETS`` classes.
The model is one matrix of log-probabilities, languages by buckets, which every task gets
as a broadcast of known size; a batch is scored by sparse sums of its rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campanile.llm.sample import bounded
from campanile.llm.ship import ship
from campanile.llm.words import batches, mix

BUCKETS = 1 << 15
MAX_N = 3
#: Added to every count.
SMOOTHING = 0.5
#: Labelled documents that the model is fitted on, at most; a documented bound.
MAX_LABELLED = 20_000
UNKNOWN = "und"


@dataclass
class LanguageModel:
    languages: list[str]
    prior: np.ndarray
    weights: np.ndarray


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram of every text, grouped by text, and how many each text has."""
    parts = [np.frombuffer(f" {' '.join(t.lower().split())} ".encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    length = np.array([len(p) for p in parts])
    points = np.concatenate(parts).astype(np.uint64)
    left = np.repeat(np.cumsum(length), length) - np.arange(len(points))
    running = np.zeros(len(points), np.uint64)
    columns = []
    for n in range(1, MAX_N + 1):
        ahead = np.concatenate([points[n - 1:], np.zeros(n - 1, np.uint64)])
        running = running * np.uint64(0x100000001B3) + ahead
        bucket = (mix(running + np.uint64(n)) % np.uint64(BUCKETS)).astype(np.int32)
        # An n-gram that would reach into the next text stands for the n-gram it starts as.
        columns.append(np.where(left >= n, bucket, columns[-1] if columns else bucket))
    return np.stack(columns, axis=1).ravel(), length * MAX_N


def _has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def _count(blocks, languages: list[str]):
    place = {name: i for i, name in enumerate(languages)}
    total = np.zeros((len(languages), BUCKETS), np.int64)
    docs = np.zeros(len(languages), np.int64)
    for block in batches(blocks):
        rows = [(t, place[g]) for t, g in zip(block.column("text").to_pylist(), block.column("lang").to_pylist())
                if t and _has_letter(t)]
        if not rows:
            continue
        grams, length = _grams([t for t, _ in rows])
        at = np.array([g for _, g in rows])
        docs += np.bincount(at, minlength=len(languages))
        total += np.bincount(np.repeat(at, length) * BUCKETS + grams, minlength=total.size).reshape(total.shape)
    for name, row, number in zip(languages, total, docs):
        found = np.append(np.flatnonzero(row), -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(found)), pa.array(found), pa.array(np.append(row, number)[found])], names=["lang", "bucket", "n"])


def fit(labelled: DataFrame, max_labelled: int = MAX_LABELLED) -> LanguageModel:
    """A model from ``labelled(doc_id, text, lang)``; rows without language or letters teach nothing."""
    ship(labelled.sparkSession)
    rows = bounded(labelled.select("doc_id", "text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL"), max_labelled)
    languages = sorted(r.lang for r in rows.select("lang").distinct().collect())
    counts = rows.mapInArrow(lambda b: _count(b, languages), "lang string, bucket bigint, n bigint").groupBy(
        "lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    weights = np.zeros((len(languages), BUCKETS))
    docs = np.zeros(len(languages))
    at = counts["lang"].map({name: i for i, name in enumerate(languages)}).to_numpy(int) if len(counts) else np.zeros(0, int)
    bucket, n = counts["bucket"].to_numpy(int), counts["n"].to_numpy(int)
    weights[at[bucket >= 0], bucket[bucket >= 0]] = n[bucket >= 0]
    docs[at[bucket < 0]] = n[bucket < 0]
    kept = docs > 0
    weights, docs = weights[kept] + SMOOTHING, docs[kept]
    return LanguageModel([g for g, k in zip(languages, kept) if k], np.log(docs / max(docs.sum(), 1)),
                         np.log(weights / weights.sum(axis=1, keepdims=True)))


def _score(blocks, model: LanguageModel):
    table = np.ascontiguousarray(model.weights.T.astype(np.float32))
    for block in batches(blocks, 256 << 10):
        texts = block.column("text").to_pylist()
        named = [UNKNOWN] * len(texts)
        score = np.zeros(len(texts))
        known = [i for i, t in enumerate(texts) if t and _has_letter(t)] if model.languages else []
        if known:
            grams, length = _grams([texts[i] for i in known])
            starts = np.cumsum(length) - length
            total = np.add.reduceat(table[grams], starts, axis=0, dtype=np.float64) + model.prior
            odds = np.exp(total - total.max(axis=1, keepdims=True))
            best = odds.argmax(axis=1)
            score[known] = odds.max(axis=1) / odds.sum(axis=1)
            for i, b in zip(known, best):
                named[i] = model.languages[b]
        rest = [c for c in block.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays(
            [block.column(c) for c in rest] + [pa.array(named, pa.string()), pa.array(score)],
            names=[*rest, "lang_pred", "score"])


def predict(docs: DataFrame, model: LanguageModel, *keep: str) -> DataFrame:
    """``keep`` columns of ``docs(text, ...)`` with ``lang_pred`` and ``score``, the posterior probability.

    A text that is null, empty or without letters is ``und`` with score 0, as is everything under a
    model that has seen no labelled row; ties go to the language first in code-point order.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    frame = docs.select(*keep, F.col("text").cast("string").alias("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema if f.name != "text")
    return frame.mapInArrow(lambda b: _score(b, shared.value), f"{schema}, lang_pred string, score double")
