"""Exact top-k search by distributed histogram selection.

Every query is scored against every vector, in numpy, block by block.  The first pass counts
each query's scores in equal bins over all scores possible; the bin that holds the k-th
highest is cut into bins again, until bins hold one score.  Then the k-th score is known
exactly: a last pass keeps what is above it and, of those equal to it, the smallest ids
that are still wanted.  Only counts and the final rows are shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from campanile.llm.ship import ship

#: Queries that are scored in one pass; they are a broadcast of this size at most.
QUERY_BLOCK = 2048
BINS = 2048
#: Scores that a task holds at once.
SCORES = 1 << 21


def integer_vectors(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """``vec_id, v``: components as ``floor(scale * x)``; vectors null, or with a null or non-finite component, are left out."""
    sound = F.expr("forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))")
    return vectors.filter(F.col("embedding").isNotNull()).filter(sound).select(
        "vec_id", F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("bigint")).alias("v"))


def _product(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where all sums stay below 2**53, else in 64-bit integers."""
    most = np.abs(queries).max(initial=0).astype(float) * np.abs(vectors).max(initial=0).astype(float) * queries.shape[1]
    if most < 2.0**53:
        return (queries.astype(np.float64) @ vectors.astype(np.float64).T).astype(np.int64)
    return queries @ vectors.T


def _scored(blocks, ids: np.ndarray, queries: np.ndarray):
    """``vec_id`` and scores of a few vectors at a time; a query's own row is masked."""
    dim, step = queries.shape[1], max(1, SCORES // max(len(queries), 1))
    for block in blocks:
        for at in range(0, block.num_rows, step):
            part = block.slice(at, step)
            lists = part.column("v")
            vectors = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)
            vec_id = part.column("vec_id").to_numpy(zero_copy_only=False)
            yield vec_id, _product(queries, vectors), ids[:, None] != vec_id[None, :]


def _histogram(blocks, ids, queries, low, width, high):
    """Per query: counts of scores in ``BINS`` bins of ``width`` from ``low``; bin ``BINS`` holds those above ``high``."""
    counts = np.zeros(len(ids) * (BINS + 2), np.int64)
    for _, scores, other in _scored(blocks, ids, queries):
        bins = (scores - low[:, None]) // width[:, None]
        bins = np.where(scores > high[:, None], BINS, np.where(scores < low[:, None], BINS + 1, bins))
        place = np.arange(len(ids))[:, None] * (BINS + 2) + bins
        counts += np.bincount(place[other], minlength=len(counts))
    found = np.flatnonzero(counts)
    query, bin_ = np.divmod(found, BINS + 2)
    kept = bin_ <= BINS
    yield pa.RecordBatch.from_arrays([pa.array(query[kept]), pa.array(bin_[kept]), pa.array(counts[found][kept])], names=["query", "bin", "n"])


def _select(blocks, ids, queries, kth, wanted):
    """Scores above ``kth``, and per task the ``wanted`` smallest ids of those equal to it."""
    ties: list[list] = [[] for _ in ids]
    for vec_id, scores, other in _scored(blocks, ids, queries):
        q, c = np.nonzero((scores > kth[:, None]) & other)
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(vec_id[c]), pa.array(scores[q, c])], names=["query", "vec_id", "score"])
        q, c = np.nonzero((scores == kth[:, None]) & other)
        for query in np.unique(q):
            ties[query] = sorted(ties[query] + vec_id[c[q == query]].tolist())[:wanted[query]]
    rows = [(query, v, int(kth[query])) for query, found in enumerate(ties) for v in found]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["query", "vec_id", "score"])


def _block_top(candidates: DataFrame, ids: np.ndarray, queries: np.ndarray, reach: int, k: int) -> DataFrame:
    """Top k of one block of queries; no score is further from 0 than ``reach``."""
    spark = candidates.sparkSession
    fixed = spark.sparkContext.broadcast((ids, queries))
    low, high = np.full(len(ids), -reach), np.full(len(ids), reach)
    above = np.zeros(len(ids), np.int64)  # scores known to be above ``high``
    few = np.zeros(len(ids), bool)
    while True:
        width = (high - low) // BINS + 1
        bounds = spark.sparkContext.broadcast((low, width, high))
        counted = candidates.mapInArrow(lambda b, x=fixed, y=bounds: _histogram(b, *x.value, *y.value), "query bigint, bin bigint, n bigint")
        counts = counted.groupBy("query", "bin").agg(F.sum("n").alias("n")).toPandas()
        table = np.zeros((len(ids), BINS + 1), np.int64)
        table[counts["query"].to_numpy(int), counts["bin"].to_numpy(int)] = counts["n"].to_numpy(np.int64)
        from_top = table[:, ::-1].cumsum(axis=1)  # first the scores above ``high``
        few |= from_top[:, -1] < k
        at = (from_top >= k).argmax(axis=1)
        bin_ = np.where(few, 0, BINS - at)
        above = np.where(few, 0, np.take_along_axis(from_top, np.maximum(at - 1, 0)[:, None], 1)[:, 0])
        one = few | (width == 1)
        new_low = low + bin_ * width
        low, high = np.where(few, low, new_low), np.where(few, high, np.minimum(new_low + width - 1, high))
        if one.all():
            break
    kth = np.where(few, -reach - 1, low)
    wanted = np.where(few, 0, k - above)
    last = spark.sparkContext.broadcast((kth, wanted))
    found = candidates.mapInArrow(lambda b, x=fixed, y=last: _select(b, *x.value, *y.value), "query bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    names = spark.createDataFrame(list(enumerate(ids.tolist())), "query bigint, query_id bigint")
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).join(names, "query").select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, scale: int = 1024) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` highest inner products (all, if fewer).

    Both tables have ``vec_id`` and ``embedding``.  Rows with a query's vec_id are its own and never its answers;
    ties go to the smaller vec_id; repeated rows are answers each.  Vectors null or holding null or non-finite
    components, a null vec_id, or a length other than the query's take no part; an empty table gives
    no rows.  Queries are taken ``QUERY_BLOCK`` at a time, each block against all vectors.
    """
    spark = vectors.sparkSession
    ship(spark)
    every = integer_vectors(vectors, scale).filter(F.col("vec_id").isNotNull())
    asked = integer_vectors(queries, scale).filter(F.col("vec_id").isNotNull()).withColumn("dim", F.size("v"))
    sizes = asked.groupBy("dim").count().collect()
    result = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    for row in sorted(r for r in sizes if r.dim > 0):
        candidates = every.filter(F.size("v") == row.dim)
        length = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
        longest = candidates.agg(F.max(length)).first()[0] or 0.0
        blocks = -(-row["count"] // QUERY_BLOCK) if row["count"] <= QUERY_BLOCK else -(-2 * row["count"] // QUERY_BLOCK)
        for b in range(blocks):
            part = asked.filter((F.col("dim") == row.dim) & (F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b)).select("vec_id", "v").toPandas()
            if not len(part):
                continue
            ids, q = part["vec_id"].to_numpy(np.int64), np.stack(part["v"].to_numpy()).astype(np.int64)
            reach = int(min(np.sqrt((q.astype(float) ** 2).sum(axis=1).max() * longest) * (1 + 1e-9) + 1, 2.0**62))
            result = result.unionByName(_block_top(candidates, ids, q, reach, k))
    return result
