"""Toxicity by maximum-scoring segments over token log-odds.

1. A token's log-odds come from the labelled documents that hold it, with a Dirichlet prior
   that pulls rare tokens to the base rate.  Tokens are words and, for inflected forms rarely or
   never seen, their first four and five bytes.  Prefixes learn only from words that are not in the
   model themselves, so one frequent word says nothing about words that begin like it.  A word
   takes the longest of its forms in the model.
2. Every token scores its log-odds less a drift, so neutral text scores negative, and one
   linear scan finds all maximal-scoring segments of a text.
3. The best segment of ``n`` tokens of clean text follows an extreme-value law,
   ``P(S >= s) = 1 - exp(-K n exp(-lambda s))``; ``lambda`` solves its defining equation over the
   background scores and ``K`` is fitted to clean documents.  Segments that are significant under it are
   passages, and a document's evidence is the sum of their surprise.  A logistic curve,
   fitted on labelled documents not used for the log-odds, turns evidence into a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campanile.llm.sample import bounded, crc
from campanile.llm.ship import ship
from campanile.llm.store import stored
from campanile.llm.words import Words, batches, mix, split_words

#: Labelled documents that the model is fitted on, at most; a documented bound.
MAX_LABELLED = 20_000
#: Tokens of the model: those with the clearest difference.
MAX_TOKENS = 1 << 16
#: Weight of the prior, in documents; with fewer labelled documents than ``ENOUGH`` it is in proportion to them.
PRIOR, ENOUGH = 10.0, 500
#: A token is in that many labelled documents at least, or in one less if there are fewer than ``ENOUGH``.
MIN_DOCUMENTS = 3
#: Taken from every token's score.
DRIFT = 1.0
#: A segment is a passage if clean text of the same length reaches its score with less than this probability.
SIGNIFICANT = 0.05
#: Labelled documents of this fold fit the calibration, the others the log-odds.
FOLDS, CALIBRATION = 5, 4

_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
_PASSAGE = pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()), ("score", pa.float64()), ("p_value", pa.float64())])


@dataclass
class ToxicityModel:
    """Sorted token hashes with their log-odds, the extreme-value law and the logistic curve."""

    tokens: np.ndarray
    odds: np.ndarray
    rate: float
    scale: float
    k: float
    curve: tuple[float, float]


def _forms(words: Words) -> list[np.ndarray]:
    """Hashes of each word's forms, longest first; 0 where a word is too short for a prefix."""
    start, end = words.start.copy(), words.end.copy()
    for _ in range(4):  # outer punctuation; a longer run stays part of the word
        start += _PUNCTUATION[words.data[start]] & (start < end - 1)
        end -= _PUNCTUATION[words.data[end - 1]] & (start < end - 1)
    out = [words.hashes(start, end)]
    for size in (5, 4):
        prefix = mix(words.hashes(start, np.minimum(start + size, end)) + np.uint64(size))
        out.append(np.where(end - start > size, prefix, np.uint64(0)))
    return out


def _count(blocks, known: np.ndarray | None):
    """``token, toxic, clean``: labelled documents that hold the token, by label.

    Words without ``known``, else the prefixes of words that are not in it.
    """
    for block in batches(blocks):
        words = split_words(block.column("text").to_pylist(), lower=True)
        label = block.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
        tokens, *prefixes = _forms(words)
        owner = words.text_of
        if known is not None:
            rare = ~np.isin(tokens, known)
            tokens, owner = np.concatenate([p[rare] for p in prefixes]), np.tile(owner[rare], len(prefixes))
        order = np.lexsort((owner, tokens))
        tokens, owner = tokens[order], owner[order]
        new = np.ones(len(tokens), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
        tokens, owner = tokens[new & (tokens != 0)], owner[new & (tokens != 0)]
        start = np.flatnonzero(np.diff(tokens, prepend=np.uint64(0)) != 0)
        toxic = np.add.reduceat(label[owner], start) if len(start) else start
        number = np.diff(np.append(start, len(tokens)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(tokens[start].astype(np.int64)), pa.array(toxic), pa.array(number - toxic)],
            names=["token", "toxic", "clean"])


def _clearest(rows: DataFrame, known: np.ndarray | None, base: float, bound: int, labelled: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``bound`` tokens with the clearest difference and their log-odds; ``base`` is the toxic share."""
    prior, least = PRIOR * min(1.0, labelled / ENOUGH), MIN_DOCUMENTS - (labelled < ENOUGH)
    counts = rows.mapInArrow(lambda b: _count(b, known), "token bigint, toxic bigint, clean bigint").groupBy("token").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    one, other = F.col("toxic") + prior * base, F.col("clean") + prior * (1 - base)
    odds = F.log(one / other) - float(np.log(base / (1 - base)))
    found = counts.filter(f"toxic + clean >= {least}").select("token", odds.alias("odds"), F.abs(odds / F.sqrt(1 / one + 1 / other)).alias("z"))
    top = found.filter("z >= 2").orderBy(F.desc("z"), "token").limit(bound).toPandas()
    return top["token"].to_numpy(np.int64).astype(np.uint64), top["odds"].to_numpy(float)


def segments(cumulative: np.ndarray, positive: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments ``(first, last, score)``, in one pass over the positive places.

    ``cumulative[i]`` is the sum of the scores before place ``i``.  Candidates are kept in order; a new
    one is joined with the nearest earlier one that starts lower, if that also ends lower.  Each candidate keeps the place of
    the nearest earlier one that starts lower than itself, so none between is looked at again and time is linear.
    """
    found: list[tuple[int, int, float, float, int]] = []
    for i in positive:
        first, low, high = int(i), float(cumulative[i]), float(cumulative[i + 1])
        j = len(found) - 1
        while j >= 0 and found[j][2] >= low:
            j = found[j][4]
        while j >= 0 and found[j][3] < high:
            first, low, before = found[j][0], found[j][2], found[j][4]
            del found[j:]
            j = before
        found.append((first, int(i), low, high, j))
    return [(a, b, high - low) for a, b, low, high, _ in found]


def _scores(words: Words, model: ToxicityModel) -> np.ndarray:
    odds = np.zeros(len(words.start))
    if len(model.tokens):
        for form in reversed(_forms(words)):
            at = np.minimum(np.searchsorted(model.tokens, form), len(model.tokens) - 1)
            odds = np.where(model.tokens[at] == form, model.odds[at], odds)
    return odds - DRIFT


def _scan(block, model: ToxicityModel):
    """Per text: number of words and maximal segments with positive score."""
    words = split_words(block.column("text").to_pylist(), lower=True)
    scores = _scores(words, model)
    cumulative = np.concatenate([[0.0], np.cumsum(scores)])
    positive = np.flatnonzero(scores > 0)
    bounds = np.searchsorted(positive, words.first)
    out = []
    for t in range(len(words.first) - 1):
        places = positive[bounds[t]:bounds[t + 1]]
        base = int(words.first[t])
        out.append([(a - base, b - base, s) for a, b, s in segments(cumulative, places)] if len(places) else [])
    return words.counts, out, scores


def _evidence(number: int, found: list[tuple[int, int, float]], model: ToxicityModel):
    """Significant passages and the sum of their surprise, in nats."""
    passages, total = [], 0.0
    for first, last, score in found:
        tail = -np.expm1(-model.k * max(number, 1) * np.exp(-min(model.scale * score, 700.0)))
        if tail < SIGNIFICANT:
            passages.append({"first_word": first, "last_word": last, "score": score, "p_value": float(tail)})
            total -= np.log(max(tail, 1e-300))
    return passages, total


def _background(blocks, model: ToxicityModel):
    """Per labelled text: its label, length, best segment; and the sums of its scores' histogram."""
    for block in batches(blocks):
        counts, found, scores = _scan(block, model)
        label = block.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
        best = [max((s for _, _, s in f), default=0.0) for f in found]
        text = np.repeat(np.arange(len(counts)), counts)
        clean = np.round(scores[label[text] == 0], 2)
        values, number = np.unique(clean, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([label, np.full(len(values), -1)])), pa.array(np.concatenate([counts, number])),
             pa.array(np.concatenate([best, values]))], names=["toxic", "n", "best"])


def _evidences(blocks, model: ToxicityModel):
    for block in batches(blocks):
        counts, found, _ = _scan(block, model)
        yield pa.RecordBatch.from_arrays(
            [block.column("toxic").cast(pa.int64()), pa.array([_evidence(n, f, model)[1] for n, f in zip(counts, found)])],
            names=["toxic", "evidence"])


def _solve_scale(values: np.ndarray, weight: np.ndarray) -> float:
    """The positive root of ``sum(weight * exp(scale * value)) = 1``."""
    low, high = 0.0, 1.0
    total = lambda x: float(np.sum(weight * np.exp(np.minimum(x * values, 600.0))))
    while total(high) < 1 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if total(middle) < 1 else (low, middle)
    return max(low, 1e-3)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope by Newton steps, with a small ridge that keeps separable cases finite."""
    design = np.stack([np.ones_like(x), x], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (y - p) - 0.1 * beta
        beta = beta + np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(2), gradient)
    return float(beta[0]), float(max(beta[1], 0.0))


def fit(labelled: DataFrame, max_labelled: int = MAX_LABELLED, max_tokens: int = MAX_TOKENS) -> ToxicityModel:
    """A model from ``labelled(doc_id, text, toxic)`` with labels 0 and 1; null texts count as empty.

    Without labelled rows of both kinds every document gets the same score, the (smoothed) base rate.
    """
    ship(labelled.sparkSession)
    rows = bounded(labelled.filter("toxic IN (0, 1)").select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                                                            F.col("toxic").cast("bigint").alias("toxic")), max_labelled)
    rows = stored(rows, "labelled")  # read by five small passes
    fold = F.pmod(crc(), F.lit(FOLDS))
    kinds = {(r.toxic, r.late): r["count"] for r in rows.groupBy("toxic", (fold == CALIBRATION).alias("late")).count().collect()}
    toxic, clean = kinds.get((1, False), 0), kinds.get((0, False), 0)
    rate = (sum(n for (y, _), n in kinds.items() if y == 1) + 0.5) / (sum(kinds.values()) + 1)
    model = ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), rate, 1.0, 1.0, (float(np.log(rate / (1 - rate))), 0.0))
    if not toxic or not clean:
        return model
    text_label = rows.select("text", "toxic")
    early = rows.filter(fold != CALIBRATION).select("text", "toxic")
    base = toxic / (toxic + clean)
    words = _clearest(early, None, base, max_tokens, toxic + clean)
    prefixes = _clearest(early, words[0], base, max_tokens, toxic + clean)
    tokens, odds = np.concatenate([words[0], prefixes[0]]), np.concatenate([words[1], prefixes[1]])
    order = np.argsort(tokens)
    model.tokens, model.odds = tokens[order], odds[order]

    late = rows.filter(fold == CALIBRATION).select("text", "toxic")
    late = late if {y for y, is_late in kinds if is_late} == {0, 1} else text_label
    seen = late.mapInArrow(lambda b, m=model: _background(b, m), "toxic bigint, n bigint, best double").groupBy("toxic", "n", "best").agg(
        F.count("*").alias("rows")).toPandas()
    hist = seen[seen["toxic"] == -1]
    weight = hist["n"].to_numpy(float) * hist["rows"].to_numpy(float)
    # One smoothed count at the highest log-odds: clean text may hold any token.
    values = np.append(hist["best"].to_numpy(float), (model.odds.max() if len(model.odds) else 1.0) - DRIFT)
    weight = np.append(weight, 1.0)
    model.scale = _solve_scale(values, weight / weight.sum())
    good = seen[(seen["toxic"] == 0) & (seen["n"] > 0)]
    expected = np.exp(-model.scale * good["best"].to_numpy(float)) * good["n"].to_numpy(float)
    # Under the law K n exp(-lambda S) is exponential with mean 1, so K is one over the mean of the rest.
    model.k = float(good["rows"].sum() / max(np.sum(expected * good["rows"].to_numpy(float)), 1e-9)) if len(good) else 1.0
    points = late.mapInArrow(lambda b, m=model: _evidences(b, m), "toxic bigint, evidence double").toPandas()
    model.curve = _logistic(points["evidence"].to_numpy(float), points["toxic"].to_numpy(float))
    return model


def _score(blocks, model: ToxicityModel):
    for block in batches(blocks):
        counts, found, _ = _scan(block, model)
        passages, total = zip(*(_evidence(n, f, model) for n, f in zip(counts, found)))
        score = 1 / (1 + np.exp(-np.clip(model.curve[0] + model.curve[1] * np.array(total), -30, 30)))
        rest = [c for c in block.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays(
            [block.column(c) for c in rest] + [pa.array(score), pa.array((score >= 0.5).astype(np.int32)),
                                               pa.array(list(passages), pa.list_(_PASSAGE))],
            names=[*rest, "score", "predicted", "passages"])


def score(docs: DataFrame, model: ToxicityModel, *keep: str) -> DataFrame:
    """``keep`` columns of ``docs(text, ...)`` with ``score`` (0 to 1), ``predicted`` and the significant ``passages``.

    Passages give first and last word, score and p-value.  A null or empty text has no passage and
    gets the score of no evidence.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    frame = docs.select(*keep, F.col("text").cast("string").alias("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema if f.name != "text")
    extra = "score double, predicted int, passages array<struct<first_word:bigint,last_word:bigint,score:double,p_value:double>>"
    return frame.mapInArrow(lambda b: _score(b, shared.value), f"{schema}, {extra}")


def _clean(blocks, model: ToxicityModel):
    for block in batches(blocks):
        counts, found, _ = _scan(block, model)
        total = np.array([_evidence(n, f, model)[1] for n, f in zip(counts, found)])
        score = 1 / (1 + np.exp(-np.clip(model.curve[0] + model.curve[1] * total, -30, 30)))
        yield block.filter(pa.array(score < 0.5))


def without_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows of ``docs(text, ...)`` that :func:`score` doesn't predict toxic, with all their columns.

    Every text goes to the Python worker once and comes back once; no passages do.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    frame = docs.withColumn("text", F.col("text").cast("string"))
    return frame.mapInArrow(lambda b: _clean(b, shared.value), frame.schema)
