"""Hard-negative mining: Strassen products of anchor and candidate tiles, merged heaps of positives and of windows.

Rows are cut into blocks of candidates, anchors into blocks of anchors, and every pair of blocks is one group: the
cells of a block product, each of bounded size whatever the table.  Rows of the smaller side are sent to a cell as often as
there are blocks of the other.  Within a cell tiles of 64-bit integers are multiplied by Strassen's recursion.  It adds,
subtracts and multiplies in the ring of integers modulo 2**64, so every score that fits 64 bits is exact, whatever
its intermediate sums are; a score beyond them wraps around.

Two passes: the first keeps a heap of the best same-label rows of each anchor, the second one heap for each anchor and
positive, of the best other-label rows within the positive's window of scores.  Heaps of cells are merged by a rank filter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from campanile.llm.ship import ship
from campanile.llm.store import stored
from campanile.llm.top_k import integer_vectors

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: A negative's score is between these percentages of the positive's.
LOW, HIGH = 50, 95
#: Rows of a block, and of a tile of candidates within it.
ANCHOR_BLOCK, CANDIDATE_BLOCK, TILE = 1024, 8192, 1024
#: Strassen's recursion ends where a side is no longer than this.
LEAF = 16
_LEAST = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` of 64-bit integers by seven half-size products; odd sides are padded with zeros."""
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
    h, i, j = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:h, :i], a[:h, i:], a[h:, :i], a[h:, i:]
    b11, b12, b21, b22 = b[:i, :j], b[:i, j:], b[i:, :j], b[i:, j:]
    out = np.empty((2 * h, 2 * j), np.int64)
    p = strassen(a11 + a22, b11 + b22, leaf)
    out[:h, :j] = p
    out[h:, j:] = p
    p = strassen(a21 + a22, np.ascontiguousarray(b11), leaf)
    out[h:, :j] = p
    out[h:, j:] -= p
    p = strassen(np.ascontiguousarray(a11), b12 - b22, leaf)
    out[:h, j:] = p
    out[h:, j:] += p
    p = strassen(np.ascontiguousarray(a22), b21 - b11, leaf)
    out[:h, :j] += p
    out[h:, :j] += p
    p = strassen(a11 + a12, np.ascontiguousarray(b22), leaf)
    out[:h, :j] -= p
    out[:h, j:] += p
    out[h:, j:] += strassen(a21 - a11, b11 + b12, leaf)
    out[:h, :j] += strassen(a12 - a22, b21 + b22, leaf)
    return out[:m, :n]


class Heaps:
    """The ``k`` best entries of each of ``n`` owners: higher scores first, ties by smaller id.  Heaps may be merged."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.owner, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        #: Scores below an owner's floor can't enter its heap any more.
        self.floor = np.full(n, _LEAST)

    def merge(self, owner: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(owner):
            return
        owner, score, ids = (np.concatenate(x) for x in ((self.owner, owner), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, ~score, owner))  # ~x falls as x rises, without overflow
        owner, score, ids = owner[order], score[order], ids[order]
        start = np.flatnonzero(np.diff(owner, prepend=-1))
        rank = np.arange(len(owner)) - np.repeat(start, np.diff(np.append(start, len(owner))))
        kept = rank < self.k
        self.owner, self.score, self.id = owner[kept], score[kept], ids[kept]
        full = rank == self.k - 1
        self.floor[owner[full]] = score[full]


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64)


def _tiles(table: pa.Table, dim: int):
    """Anchors of one cell, and tiles of its candidates with their scores."""
    is_anchor = table.column("anchor").to_numpy(zero_copy_only=False).astype(bool)
    anchors, candidates = table.filter(pa.array(is_anchor)), table.filter(pa.array(~is_anchor))
    if not anchors.num_rows or not candidates.num_rows:
        return
    left = _matrix(anchors.column("v").combine_chunks(), dim)
    for at in range(0, candidates.num_rows, TILE):
        part = candidates.slice(at, TILE)
        right = np.ascontiguousarray(_matrix(part.column("v").combine_chunks(), dim).T)
        yield anchors, part, left, right


def _best_positives(cell: pa.Table) -> pa.Table:
    """``row, vec_id, score``: the cell's best same-label rows of each anchor; only equal labels are multiplied."""
    dim = len(cell.column("v")[0])
    heaps = None
    for anchors, part, left, right in _tiles(cell, dim):
        if heaps is None:
            heaps, rows = Heaps(anchors.num_rows, POSITIVES), _column(anchors, "row")
            own, label = _column(anchors, "vec_id"), _column(anchors, "label")
        ids, labels = _column(part, "vec_id"), _column(part, "label")
        for value in np.intersect1d(label, labels):
            i, j = np.flatnonzero(label == value), np.flatnonzero(labels == value)
            scores = strassen(left[i], np.ascontiguousarray(right[:, j]))
            a, c = np.nonzero((scores >= heaps.floor[i][:, None]) & (own[i][:, None] != ids[j][None, :]))
            heaps.merge(i[a], scores[a, c], ids[j[c]])
    if heaps is None:
        return pa.table({n: pa.array([], pa.int64()) for n in ("row", "vec_id", "score")})
    return pa.table({"row": rows[heaps.owner], "vec_id": heaps.id, "score": heaps.score})


def _best_negatives(cell: pa.Table) -> pa.Table:
    """``row, place, vec_id, score``: the cell's best other-label rows within each window of each anchor."""
    dim = len(cell.column("v")[0])
    heaps: list[Heaps] = []
    for anchors, part, left, right in _tiles(cell, dim):
        if not heaps:
            rows, own, label = (_column(anchors, n) for n in ("row", "vec_id", "label"))
            windows = [w or [] for w in anchors.column("windows").to_pylist()]
            number = max(map(len, windows), default=0)
            low, high = np.full((number, len(rows)), 1, np.int64), np.zeros((number, len(rows)), np.int64)
            for i, scores in enumerate(windows):
                for place, score in enumerate(scores):
                    low[place, i], high[place, i] = -(-LOW * score // 100), HIGH * score // 100
            heaps = [Heaps(len(rows), NEGATIVES) for _ in range(number)]
        ids, labels = _column(part, "vec_id"), _column(part, "label")
        scores = strassen(left, right)
        other = (label[:, None] != labels[None, :]) & (own[:, None] != ids[None, :])
        for place, heap in enumerate(heaps):
            least = np.maximum(low[place], heap.floor)
            a, c = np.nonzero((scores >= least[:, None]) & (scores <= high[place][:, None]) & other)
            heap.merge(a, scores[a, c], ids[c])
    if not heaps:
        return pa.table({n: pa.array([], pa.int64()) for n in ("row", "place", "vec_id", "score")})
    return pa.table({"row": np.concatenate([rows[h.owner] for h in heaps]),
                     "place": np.concatenate([np.full(len(h.owner), p) for p, h in enumerate(heaps)]),
                     "vec_id": np.concatenate([h.id for h in heaps]), "score": np.concatenate([h.score for h in heaps])})


def _cells(rows: DataFrame, anchors: DataFrame, anchor_blocks: int, candidate_blocks: int) -> DataFrame:
    """All rows and anchors, each beside the blocks of the other side that it meets."""
    candidates = rows.select("row", "vec_id", "label", "v", "dim", F.lit(False).alias("anchor"), F.lit(None).cast("array<bigint>").alias("windows"),
                             F.pmod("row", F.lit(candidate_blocks)).alias("c"), F.explode(F.expr(f"sequence(0L, {anchor_blocks - 1}L)")).alias("a"))
    sent = anchors.select("row", "vec_id", "label", "v", "dim", F.lit(True).alias("anchor"), "windows",
                          F.explode(F.expr(f"sequence(0L, {candidate_blocks - 1}L)")).alias("c"), F.pmod(F.xxhash64("row"), F.lit(anchor_blocks)).alias("a"))
    return candidates.unionByName(sent).groupBy("dim", "a", "c")


def mine(vectors: DataFrame, every: int = 50, relabel: int = 7) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of ``vectors(vec_id, embedding, label)``.

    Rows whose vec_id is divisible by ``every`` are anchors; where it is divisible by ``relabel`` the label first becomes
    ``(label + 1) % 10``.  Rows with a null vec_id or label, or a vector that is null, empty or holds a null or non-finite
    component, take no part; only vectors of the anchor's length are its partners.  Rows of the anchor's own vec_id are never
    its partners; repeated rows are partners each, and repeated anchors have answers each.  An anchor without
    positives, or a positive without negatives in its window, has no row; an empty table gives none.
    Other columns are ignored.
    """
    ship(vectors.sparkSession)
    label = F.when(F.col("vec_id") % relabel == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("bigint")
    sound = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    sound = sound.select(F.struct(F.col("vec_id").cast("bigint").alias("id"), label.alias("label")).alias("vec_id"), "embedding")
    rows = integer_vectors(sound, SCALE).select(F.monotonically_increasing_id().alias("row"), F.col("vec_id.id").alias("vec_id"),
                                                F.col("vec_id.label").alias("label"), "v", F.size("v").alias("dim"))
    rows = stored(rows.filter("dim > 0"), "vectors")
    anchors = rows.filter(F.col("vec_id") % every == 0)
    candidate_blocks, anchor_blocks = -(-rows.count() // CANDIDATE_BLOCK) or 1, -(-anchors.count() // ANCHOR_BLOCK) or 1

    first = _cells(rows, anchors.withColumn("windows", F.lit(None).cast("array<bigint>")), anchor_blocks, candidate_blocks)
    found = first.applyInArrow(_best_positives, "row bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id"))
    positives = stored(found.withColumn("place", rank - 1).filter(F.col("place") < POSITIVES), "positives")

    # At most five positives an anchor.
    of_anchor = positives.groupBy("row").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "score"))), lambda p: p["score"]).alias("windows"))
    second = _cells(rows, anchors.join(of_anchor, "row"), anchor_blocks, candidate_blocks)
    found = second.applyInArrow(_best_negatives, "row bigint, place bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("row", "place").orderBy(F.desc("score"), "vec_id"))
    negatives = found.withColumn("rank", rank).filter(F.col("rank") <= NEGATIVES).select(
        "row", "place", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = positives.select("row", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    own = anchors.select("row", F.col("vec_id").alias("anchor_id"))
    return negatives.join(named, ["row", "place"]).join(own, "row").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


SQL = """
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
pos AS (
  SELECT a, anchor_id, vec_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) AS place
  FROM pair WHERE same QUALIFY place <= 5),
neg AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, n.vec_id AS negative_id, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.a, p.place ORDER BY n.score DESC, n.vec_id) AS rank
  FROM pos p JOIN pair n ON p.a = n.a AND NOT n.same
    AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
  QUALIFY rank <= 3)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM neg
"""
