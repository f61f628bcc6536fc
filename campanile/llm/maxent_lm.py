"""A hashed maximum-entropy language model with a class-factored softmax.

Tokens are words and one end per text.  The ``HEAD`` most frequent tokens stand for
themselves, in classes of ``WIDTH``; every other word belongs to one of ``RARE`` classes, dealt by a
hash of its ending.  The probability of a token is that of its class, times that of the token
within its class.  Both are log-linear in hashed features of the two tokens before: the last
token, the one before it (a skip), and the pair of them.  Within a rare class a word has its
share of the smoothed counts, so the model is a full distribution over all words.

Counts come from all training texts.  Training passes once over all of them in ``ROUNDS``
rounds: every task makes adaptive gradient steps on its texts from the round's weights, the
weight changes are averaged by key, and the next round starts from there.  Tables have fixed
sizes.  Counts of words outside a bounded broadcast are joined by word hash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campanile.llm.ship import ship
from campanile.llm.store import stored
from campanile.llm.words import batches, mix, split_words

WIDTH, HEAD_CLASSES, RARE = 32, 16, 32
HEAD, CLASSES = WIDTH * HEAD_CLASSES, HEAD_CLASSES + RARE
#: Contexts: head tokens, rare classes, the start of a text.
CONTEXTS = HEAD + RARE + 1
PAIRS = 1 << 13
ROUNDS = 2
RATE = 0.25
#: Tokens of a gradient step, and of a row of counts that a task sends.
STEP, COUNTED = 8192, 4_000_000
#: Frequent words whose counts every task gets.
SHARED = 1 << 18
SMOOTHING = 0.1
#: Numbers in a row of weights that is sent.
BLOCK = 1 << 13
END = np.uint64(0)

_SHAPES = {"last": (CONTEXTS, CLASSES), "skip": (CONTEXTS, CLASSES), "pair": (PAIRS, CLASSES),
           "word_last": (CONTEXTS * HEAD_CLASSES, WIDTH), "word_skip": (CONTEXTS * HEAD_CLASSES, WIDTH)}


@dataclass
class Vocabulary:
    """``head``: hashes of the head tokens, sorted, with their ids; frequent words' hashes, sorted, with their counts."""

    head: np.ndarray
    head_id: np.ndarray
    words: np.ndarray
    counts: np.ndarray
    total: int
    distinct: int
    class_bias: np.ndarray
    word_bias: np.ndarray
    rare_mass: np.ndarray


def _tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes of all texts in order (the end is 0), each token's rare class, and the tokens of each text."""
    words = split_words(texts, lower=True)
    hashes = np.maximum(words.hashes(), np.uint64(1))
    tail = words.end - 1
    for _ in range(2):  # the ending before closing punctuation
        byte = words.data[np.maximum(tail, 0)]
        tail = tail - (((byte < 48) | (byte == 58) | (byte == 59)) & (tail > words.start))
    code = words.data[tail].astype(np.uint64) if len(tail) else np.zeros(0, np.uint64)
    for back in (1, 2):
        here = tail - back >= words.start
        code = code * np.uint64(257) + np.where(here, words.data[np.maximum(tail - back, 0)], 0).astype(np.uint64)
    rare = (mix(code) % np.uint64(RARE)).astype(np.int32)
    place = words.first[1:]
    return np.insert(hashes, place, END), np.insert(rare, place, 0), words.counts + 1


def _count(blocks):
    held, number = [], 0

    def flush():
        tokens, rare = (np.concatenate(c) for c in zip(*held))
        tokens, first, n = np.unique(tokens, return_index=True, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(tokens.astype(np.int64)), pa.array(rare[first]), pa.array(n)], names=["token", "rare", "n"])

    for block in batches(blocks):
        tokens, rare, _ = _tokens(block.column("text").to_pylist())
        held.append((tokens, rare))
        number += len(tokens)
        if number >= COUNTED:
            yield flush()
            held, number = [], 0
    if held:
        yield flush()


def token_counts(texts: DataFrame) -> DataFrame:
    """``token, rare, n``: every distinct token of ``texts(text)``, by 64-bit hash, with its number."""
    ship(texts.sparkSession)
    sent = texts.select("text").mapInArrow(_count, "token bigint, rare int, n bigint")
    return stored(sent.groupBy("token").agg(F.min("rare").alias("rare"), F.sum("n").alias("n")), "counts")


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Totals, the head and the frequent words; sizes are fixed, whatever the corpus."""
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # A histogram finds how frequent a word must be for at most SHARED words to reach the driver: an ordered
    # limit would send so many from every partition.
    level = F.floor(F.log2("n") * 256)
    seen, floor = 1, None
    for row in sorted(counts.groupBy(level.alias("level")).count().collect(), key=lambda r: -r.level):
        seen += row["count"]
        if seen > SHARED:
            break
        floor = row.level
    frequent = F.col("token") == int(END)
    top = counts.filter(frequent if floor is None else frequent | (level >= floor)).toPandas()
    top = top.assign(end=top["token"] == int(END)).sort_values(["end", "n", "token"], ascending=[False, False, True])
    token, n = top["token"].to_numpy(np.int64).astype(np.uint64), top["n"].to_numpy(np.int64)
    head, head_n = token[:HEAD], n[:HEAD]
    mass = np.full(RARE, SMOOTHING)
    for row in counts.groupBy("rare").agg(F.sum(F.col("n") + SMOOTHING).alias("mass")).collect():
        mass[row.rare] += row.mass
    np.subtract.at(mass, top["rare"].to_numpy(int)[:HEAD], head_n + SMOOTHING)
    # Classes of equal width by frequency; places that no token fills have no probability.
    share = np.zeros(HEAD)
    share[:len(head)] = head_n + SMOOTHING
    with np.errstate(divide="ignore"):
        word_bias = np.log(share.reshape(HEAD_CLASSES, WIDTH))
        class_bias = np.log(np.concatenate([share.reshape(HEAD_CLASSES, WIDTH).sum(axis=1), mass]))
    order, every = np.argsort(head), np.argsort(token)
    return Vocabulary(head[order], order.astype(np.int32), token[every], n[every], int(total), int(distinct),
                      np.maximum(class_bias, -60).astype(np.float32), np.maximum(word_bias, -60).astype(np.float32), mass)


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: int) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), missing, values.dtype)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], missing)


def _encoded(tokens: np.ndarray, rare: np.ndarray, lengths: np.ndarray, v: Vocabulary):
    """Ids below ``HEAD`` for head tokens, else ``HEAD`` plus the rare class; and the two ids before each."""
    ids = _lookup(v.head, v.head_id, tokens, -1)
    ids = np.where(ids < 0, HEAD + rare, ids).astype(np.int32)
    start = np.cumsum(lengths) - lengths
    last, skip = np.roll(ids, 1), np.roll(ids, 2)
    last[start] = skip[start] = CONTEXTS - 1
    second = start[lengths > 1] + 1
    skip[second] = CONTEXTS - 1
    return ids, last, skip


def _softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def _forward(ids, last, skip, v: Vocabulary, w: dict[str, np.ndarray]):
    """Class probabilities, each token's class; rows of the head tokens, their word features and probabilities."""
    pair = (last * np.int32(CONTEXTS) + skip) * np.int64(0x9E3779B1) >> 7 & (PAIRS - 1)
    classes = np.where(ids < HEAD, ids // WIDTH, HEAD_CLASSES + ids - HEAD)
    p = _softmax(w["last"][last] + w["skip"][skip] + w["pair"][pair] + v.class_bias)
    in_head = np.flatnonzero(ids < HEAD)
    of = classes[in_head]
    one, two = last[in_head] * HEAD_CLASSES + of, skip[in_head] * HEAD_CLASSES + of
    q = _softmax(w["word_last"][one] + w["word_skip"][two] + v.word_bias[of])
    return pair, classes, p, in_head, one, two, q


def _add(weights: np.ndarray, squares: np.ndarray, rows: np.ndarray, gradient: np.ndarray) -> None:
    """One adaptive step on the rows' summed gradients."""
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    start = np.flatnonzero(np.diff(rows, prepend=-1))
    rows, total = rows[start], np.add.reduceat(gradient[order], start, axis=0)
    squares[rows] += total * total
    weights[rows] -= RATE * total / np.sqrt(squares[rows] + 1.0)


def _train(blocks, v: Vocabulary, start: dict[str, np.ndarray]):
    weights = {k: x.copy() for k, x in start.items()}
    squares = {k: np.zeros_like(x) for k, x in start.items()}
    seen = False
    for block in batches(blocks):
        every = _encoded(*_tokens(block.column("text").to_pylist()), v)
        for at in range(0, len(every[0]), STEP):
            ids, last, skip = (x[at:at + STEP] for x in every)
            pair, classes, p, in_head, one, two, q = _forward(ids, last, skip, v, weights)
            p[np.arange(len(ids)), classes] -= 1
            for name, rows in (("last", last), ("skip", skip), ("pair", pair)):
                _add(weights[name], squares[name], rows, p)
            if len(in_head):
                q[np.arange(len(in_head)), ids[in_head] % WIDTH] -= 1
                _add(weights["word_last"], squares["word_last"], one, q)
                _add(weights["word_skip"], squares["word_skip"], two, q)
            seen = True
    if seen:
        flat = np.concatenate([(weights[k] - start[k]).ravel() for k in _SHAPES])
        for i in range(0, len(flat), BLOCK):
            yield pa.RecordBatch.from_arrays([pa.array([i // BLOCK], pa.int32()), pa.array([1], pa.int64()), pa.array([flat[i:i + BLOCK].tobytes()], pa.binary())],
                                             names=["block", "n", "change"])


def _sum_blocks(rows):
    """Sums of weight changes by block: a partition holds one sum of each block, whatever arrives."""
    total: dict[int, list] = {}
    for batch in rows:
        for row in batch.to_pylist():
            held = total.setdefault(row["block"], [0, np.zeros(len(row["change"]) // 4, np.float32)])
            held[0] += row["n"]
            held[1] += np.frombuffer(row["change"], np.float32)
    if total:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([h[0] for h in total.values()], pa.int64()),
             pa.array([h[1].tobytes() for h in total.values()], pa.binary())], names=["block", "n", "change"])


def train(texts: DataFrame, v: Vocabulary) -> dict[str, np.ndarray]:
    """Weights after ``ROUNDS`` averaged rounds over ``texts(doc_id, text)``, each text in one of them."""
    spark = texts.sparkSession
    ship(spark)
    weights = {k: np.zeros(shape, np.float32) for k, shape in _SHAPES.items()}
    schema = "block int, n bigint, change binary"
    turn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS))
    for r in range(ROUNDS):
        shared = spark.sparkContext.broadcast((v, weights))
        changes = texts.filter(turn == r).select("text").mapInArrow(lambda b, s=shared: _train(b, *s.value), schema)
        # Two levels of sums, so no task reads more than its share of the tasks' tables.
        part = changes.withColumn("salt", F.pmod(F.monotonically_increasing_id().bitwiseAND((1 << 40) - 1) + F.shiftright(F.monotonically_increasing_id(), 33), F.lit(8)))
        part = part.repartition("block", "salt").drop("salt").mapInArrow(_sum_blocks, schema)
        rows = part.repartition("block").mapInArrow(_sum_blocks, schema).collect()
        flat = np.concatenate([x.ravel() for x in weights.values()])
        for row in rows:
            change = np.frombuffer(row.change, np.float32)
            flat[row.block * BLOCK:row.block * BLOCK + len(change)] += change / row.n
        at = 0
        for k, shape in _SHAPES.items():
            size = shape[0] * shape[1]
            weights[k] = flat[at:at + size].reshape(shape).copy()
            at += size
        shared.unpersist()
    return weights


def _score(blocks, v: Vocabulary, weights: dict[str, np.ndarray]):
    uid = TaskContext.get().partitionId() << 33
    log_total = np.log10(v.total + SMOOTHING * (v.distinct + 1))
    for block in batches(blocks):
        tokens, rare, lengths = _tokens(block.column("text").to_pylist())
        ids, last, skip = _encoded(tokens, rare, lengths, v)
        logp = np.zeros(len(ids))
        if v.total:
            for at in range(0, len(ids), STEP):
                here = slice(at, at + STEP)
                _, classes, p, in_head, _, _, q = _forward(ids[here], last[here], skip[here], v, weights)
                part = np.log10(np.maximum(p[np.arange(len(classes)), classes], 1e-30).astype(np.float64))
                part[in_head] += np.log10(np.maximum(q[np.arange(len(in_head)), ids[here][in_head] % WIDTH], 1e-30).astype(np.float64))
                logp[here] = part
        else:
            logp -= log_total
        count = _lookup(v.words, v.counts, tokens, 0)
        known = count > 0
        add = np.log10(np.where(known, count, 0) + SMOOTHING)
        # A word that the broadcast lacks gets its count by a join; until then it adds nothing.
        base = np.where(known, add, 0.0) - log_total
        if v.total:
            logp += np.where(ids >= HEAD, np.where(known, add, 0.0) - np.log10(v.rare_mass)[np.maximum(ids - HEAD, 0)], 0.0)
        elif len(ids):
            logp += np.where(known, add, 0.0)
        start = np.cumsum(lengths) - lengths
        text = np.repeat(np.arange(len(lengths)), lengths)
        missing = np.flatnonzero(~known)
        offsets = np.searchsorted(text[missing], np.arange(len(lengths) + 1))
        rest = [c for c in block.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays(
            [block.column(c) for c in rest] + [
                pa.array(uid + np.arange(len(lengths))), pa.array(lengths.astype(np.int64)), pa.array(np.add.reduceat(known.astype(np.int64), start)),
                pa.array(np.add.reduceat(base, start)), pa.array(np.add.reduceat(logp, start)),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(tokens[missing].astype(np.int64)))],
            names=[*rest, "uid", "n_tokens", "n_known", "base_score", "score", "missing"])
        uid += len(lengths)


def score(docs: DataFrame, counts: DataFrame, v: Vocabulary, weights: dict[str, np.ndarray], *keep: str) -> DataFrame:
    """``keep`` columns of ``docs(text, ...)`` with ``n_tokens, n_known, train_tokens, base_score, score``.

    Scores are sums of log10 probabilities over the whole text and its end.  A null text counts as empty: its end
    alone.  Without training texts both scores are those of one unseen token after another, 0.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast((v, weights))
    frame = docs.select(*keep, F.col("text").cast("string").alias("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema if f.name != "text")
    parts = stored(frame.mapInArrow(lambda b: _score(b, *shared.value), f"{schema}, uid bigint, n_tokens bigint, n_known bigint, "
                                    "base_score double, score double, missing array<bigint>"), "scored")
    asked = parts.select("uid", F.explode("missing").alias("token")).groupBy("uid", "token").agg(F.count("*").alias("k"))
    found = asked.join(counts.select("token", "n"), "token", "left").groupBy("uid").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("k")).otherwise(0)).alias("more"),
        F.sum(F.col("k") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(SMOOTHING))).alias("add"))
    add, more = F.coalesce("add", F.lit(0.0)), F.coalesce("more", F.lit(0))
    return parts.drop("missing").join(found, "uid", "left").select(
        *keep, "n_tokens", (F.col("n_known") + more).alias("n_known"), F.lit(v.total).cast("bigint").alias("train_tokens"),
        (F.col("base_score") + add).alias("base_score"), (F.col("score") + add).alias("score"))
