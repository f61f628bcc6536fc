"""Exact Jaccard self-join of documents on word n-grams, by set-relation skipping.

1. *Repeated grams.*  A document can only have a partner if enough of its grams occur
   elsewhere.  Every batch of texts sends each of its distinct gram hashes once, packed, to
   the task that owns the hash range, and gets back per set how many of them are repeated.
   The rest leaves.  The count may be too high (32-bit remainders), never too low.
2. *Index lists.*  The sets that remain are indexed by the grams of their prefix (grams are
   ordered by hash; a link must share one).  Each list has a centre, its set with the most
   repeated grams, and every member is compared exactly with its centres only.
3. *Answers from a similar set's answers.*  Let ``x`` and ``y`` share a centre ``c``.  From the
   overlaps with ``c`` follows ``|x & y| <= min(|x & c|, |y & c|) + min(out_x, out_y)``, where
   ``out`` counts a set's repeated grams outside ``c``.  A pair that this bound refutes, or
   that is in one component already, is never formed.
4. *Block skipping.*  A centre's list is cut into blocks by size, overlap and ``out``.  The
   bound over whole blocks tells which blocks can meet at all; the others are skipped.

Equal sets are one set from the start; a batch of texts sends a set once.  Everything is joined and summed by key; no
list, component or group of copies is gathered in one task, and the driver only counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campanile.llm.components import components
from campanile.llm.ship import ship
from campanile.llm.store import stored
from campanile.llm.words import batches, mix, shingles, split_words

#: Grams that one task holds when it looks for repeated ones.
GRAMS_PER_PART = 4_000_000
#: Grams that a task gathers before it sends them out.
GRAMS_PER_BATCH = 1_000_000

_SENT = "part int, set binary, number binary, runs binary, grams binary, others binary"
_REPLY = "part int, set binary, number binary"
_KNOWN = "doc_id bigint, set bigint, check bigint, n bigint"
_REPEATED = "set bigint, repeated bigint"


def _sets_of(block: pa.RecordBatch, size: int):
    """Per text of a batch: its sorted distinct gram hashes, two fingerprints of them and their number."""
    texts = block.column("text").to_pylist()
    grams, text = shingles(split_words(texts, lower=True), size)
    grams = [np.unique(part) for part in np.split(grams, np.cumsum(np.bincount(text, minlength=len(texts)))[:-1])]
    n = np.array([len(g) for g in grams], np.int64)
    total = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
    ends = np.cumsum(n)
    prints = []
    for salt in (1, 2):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(total + np.uint64(salt)), dtype=np.uint64)])
        prints.append(mix((sums[ends] - sums[ends - n]) ^ n.astype(np.uint64)).astype(np.int64))
    return total, n, prints[0], prints[1]


def _known(blocks, size: int):
    """Each document with its set, as told by two fingerprints, and the set's size."""
    for block in batches(blocks):
        _, n, sets, checks = _sets_of(block, size)
        yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(sets), pa.array(checks), pa.array(n)], names=["doc_id", "set", "check", "n"])


def _send(blocks, size: int, parts: int):
    """Pack the distinct grams of a few thousand texts by hash range; a gram with one owner names it."""
    held: list[tuple] = []

    def flush():
        n, sets = (np.concatenate([h[k] for h in held]) for k in range(2))
        grams = np.concatenate([h[2] for h in held])
        # Equal sets of the batch are sent once.
        _, first = np.unique(sets, return_index=True)
        once = np.zeros(len(sets), bool)
        once[first] = True
        owner = np.repeat(np.arange(len(sets)), n)
        kept = once[owner]
        grams, owner = grams[kept], owner[kept]
        order = np.argsort(grams, kind="stable")
        grams, owner = grams[order], owner[order]
        new = np.ones(len(grams), bool)
        new[1:] = grams[1:] != grams[:-1]
        many = ~new
        many[:-1] |= many[1:].copy()  # every gram that a second set of this batch has
        local = np.bincount(owner[many], minlength=len(sets))
        # The sets' numbers go to the parts that sum them up, once a batch however many documents have the set.
        to = (mix(sets.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
        rows = []
        for k in np.unique(to[first]):
            here = first[to[first] == k]
            rows.append((int(k), sets[here].tobytes(), local[here].astype(np.int64).tobytes(), None, None, None))
        grams, owner, single = grams[new], owner[new], ~many[new]
        # Hash ranges of equal width: the high bits name the part, the rest goes in 32 bits.
        part = ((grams >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        rest = mix(grams).astype(np.uint32)
        bounds = np.searchsorted(part, np.arange(parts + 1))
        for k in range(parts):
            here = slice(bounds[k], bounds[k + 1])
            if bounds[k] == bounds[k + 1]:
                continue
            own, alone, low = owner[here], single[here], rest[here]
            order = np.argsort(own[alone], kind="stable")
            by = own[alone][order]
            start = np.flatnonzero(np.diff(by, prepend=-1))
            rows.append((k, sets[by[start]].tobytes(), None, np.diff(np.append(start, len(by))).astype(np.uint32).tobytes(),
                         low[alone][order].tobytes(), low[~alone].tobytes()))
        held.clear()
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32())] + [pa.array(c, pa.binary()) for c in columns[1:]],
            names=["part", "set", "number", "runs", "grams", "others"])

    gathered = 0
    for block in batches(blocks):
        grams, n, sets, _ = _sets_of(block, size)
        held.append((n, sets, grams))
        gathered += len(grams)
        if gathered >= GRAMS_PER_BATCH:
            yield flush()
            gathered = 0
    if held:
        yield flush()


def _reply(key, table, parts: int):
    """For one hash range: how many of each set's grams another set has as well, packed by set."""
    sent = [row for row in table.to_pylist() if row["number"] is None]
    out = [[int(row["part"]), row["set"], row["number"]] for row in table.to_pylist() if row["number"] is not None]
    if sent:
        sets = np.concatenate([np.frombuffer(row["set"], np.int64) for row in sent])
        runs = np.concatenate([np.frombuffer(row["runs"], np.uint32) for row in sent])
        grams = np.concatenate([np.frombuffer(row["grams"], np.uint32) for row in sent])
        shared = np.concatenate([np.frombuffer(row["others"], np.uint32) for row in sent])
        owner = np.repeat(sets, runs)
        order = np.lexsort((owner, grams))
        grams, owner = grams[order], owner[order]
        once = np.ones(len(grams), bool)  # equal sets of several batches count once
        once[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
        grams, owner = grams[once], owner[once]
        many = np.zeros(len(grams), bool)
        many[1:] = grams[1:] == grams[:-1]
        many[:-1] |= many[1:].copy()
        many |= np.isin(grams, shared)
        of, number = np.unique(owner[many], return_counts=True)
        to = (mix(of.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        of, number, to = of[order], number[order], to[order]
        start = np.flatnonzero(np.diff(to, prepend=-1))
        for i, j in zip(start, np.append(start[1:], len(to))):
            out.append([int(to[i]), of[i:j].tobytes(), number[i:j].astype(np.int64).tobytes()])
    return pa.table({name: pa.array([r[i] for r in out], pa.binary() if i else pa.int32()) for i, name in enumerate(("part", "set", "number"))})


def _gather(key, table):
    """One row per set of the part, with its number of repeated grams."""
    sets, number = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for column, out in (("set", sets), ("number", number)):
        out.extend(np.frombuffer(packed, np.int64) for packed in table.column(column).to_pylist())
    every, place = np.unique(np.concatenate(sets), return_inverse=True)
    return pa.table({"set": every, "repeated": np.bincount(place, np.concatenate(number), minlength=len(every)).astype(np.int64)})


def _load(blocks, size: int):
    for block in batches(blocks):
        grams, n, sets, _ = _sets_of(block, size)
        offsets = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(sets), pa.array(n), pa.ListArray.from_arrays(offsets, pa.array(grams.astype(np.int64)))],
            names=["set", "n", "grams"])


def _similar(overlap: str, a: str, b: str, percent: int) -> F.Column:
    return F.expr(f"100 * {overlap} >= {percent} * ({a} + {b} - {overlap})")


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs(a, b)`` with the sizes and the exact number of common grams."""
    right = sets.select(F.col("set").alias("b"), F.col("n").alias("n_b"), F.col("grams").alias("grams_b"))
    left = sets.select(F.col("set").alias("a"), F.col("n").alias("n_a"), F.col("grams").alias("grams_a"))
    return pairs.join(right, "b").join(left, "a").select(
        "a", "b", "n_a", "n_b", F.size(F.array_intersect("grams_a", "grams_b")).cast("bigint").alias("overlap"))


def _step(column: str) -> F.Column:
    """Blocks a sixteenth of a power of two wide, so that bounds over a block are tight."""
    return F.floor(F.log2(F.col(column) + 1) * 16).cast("int")


def set_links(sets: DataFrame, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Links among distinct sets.

    ``sets(set, n, grams)`` has sorted distinct 64-bit grams.  Returns ``links(u, v)``, enough of
    the links to give all components (links inside a known component are not looked for), and
    those components.
    """
    # Grams are in hash order, so a gram's index is its position in the set.
    every = sets.select("set", "n", F.posexplode("grams").alias("at", "gram"))
    shared = every.groupBy("gram").agg(F.min("set").alias("x"), F.max("set").alias("y")).filter("x <> y").select("gram")
    lists = stored(every.join(shared, "gram"), "lists")
    enough = f"floor(({percent} * n + 99) / 100)"
    repeated = stored(lists.groupBy("set", "n").agg(F.count("*").alias("repeated")).filter(f"repeated >= {enough}"), "repeated")
    prefix = lists.filter(f"at <= n - {enough}").join(repeated.drop("n"), "set")
    centre = prefix.groupBy("gram").agg(F.max(F.struct("repeated", "set")).alias("top"), F.min("set").alias("x"),
                                        F.max("set").alias("y")).filter("x <> y")
    near = prefix.join(centre.select("gram", F.col("top.set").alias("a")), "gram").filter("a <> set")
    pairs = near.select("a", F.col("set").alias("b")).distinct()
    alive = sets.join(repeated.select("set"), "set", "left_semi")
    stars = stored(_overlaps(pairs, alive), "stars")
    first = stars.filter(_similar("overlap", "n_a", "n_b", percent)).select(F.col("a").alias("u"), F.col("b").alias("v"))
    roots = components(first)

    members = stars.join(repeated.select(F.col("set").alias("b"), "repeated"), "b").join(
        roots.select(F.col("node").alias("b"), "root"), "b", "left").select(
        F.col("a").alias("centre"), F.col("b").alias("member"), F.col("n_b").alias("n"), "overlap",
        (F.col("repeated") - F.col("overlap")).alias("out"), F.coalesce("root", "b").alias("root"))
    members = stored(members.withColumn("block", F.struct(_step("n"), _step("overlap"), _step("out"))), "members")
    blocks = members.groupBy("centre", "block").agg(
        F.min("n").alias("n"), F.max("n").alias("n_max"), F.max("overlap").alias("overlap"), F.max("out").alias("out"),
        F.min("root").alias("root_min"), F.max("root").alias("root_max"))
    one, two = blocks.alias("x"), blocks.alias("y")
    bound = "(least(x.overlap, y.overlap) + least(x.out, y.out))"
    meeting = one.join(two, F.expr(
        f"x.centre = y.centre AND x.block <= y.block AND 100 * {bound} >= {percent} * (x.n + y.n - {bound})"
        f" AND 100 * x.n_max >= {percent} * y.n AND 100 * y.n_max >= {percent} * x.n"
        " AND NOT (x.root_min = x.root_max AND y.root_min = y.root_max AND x.root_min = y.root_min)")).select(
        F.col("x.centre").alias("centre"), F.col("x.block").alias("block"), F.col("y.block").alias("other"))
    left = members.join(meeting, ["centre", "block"]).alias("x")
    right = members.alias("y")
    rest = left.join(right, F.expr(
        "x.centre = y.centre AND x.other = y.block AND x.root <> y.root AND (x.block <> y.block OR x.member < y.member)"
        f" AND 100 * {bound} >= {percent} * (x.n + y.n - {bound})")).select(
        F.least("x.member", "y.member").alias("a"), F.greatest("x.member", "y.member").alias("b")).distinct()
    # A link must share a gram of the prefixes: 32 bits of each are enough to refute most pairs before whole sets move.
    short = stored(prefix.groupBy("set").agg(F.collect_list(F.hash("gram")).alias("short")), "prefixes")
    rest = stored(rest.join(short.select(F.col("set").alias("b"), F.col("short").alias("short_b")), "b").join(
        short.select(F.col("set").alias("a"), "short"), "a").filter(F.arrays_overlap("short", "short_b")).select("a", "b"), "rest")
    later = _overlaps(rest, alive).filter(_similar("overlap", "n_a", "n_b", percent)).select(
        F.col("a").alias("u"), F.col("b").alias("v"))
    links = stored(first.unionByName(later), "links")
    # Known components shrink to one edge per member, so the second run only joins what is new.
    merged = roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(links)
    return links, components(merged)


def jaccard_components(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs(doc_id, text)``.

    A text's set holds its distinct runs of ``size`` words (A-Z folded); with fewer words the
    whole sequence is the one gram.  Two documents link when their sets' Jaccard similarity is
    at least ``percent`` %, ties included; ``component_id`` is the least doc_id that links reach.

    Defined cases: texts that are null, empty or without words have 0 grams and are linked with
    nothing; a repeated row is one more document, with its own row in the result; a row with a null
    doc_id is returned with 0 grams and a null component, as nothing can name it; other columns
    are ignored; an empty table gives an empty result.  Sets are told apart by 64-bit
    fingerprints with a second one checked.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    some = texts.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    length = some.agg(F.sum(F.octet_length("text")).alias("bytes")).first().bytes or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-length // (4 * GRAMS_PER_PART)))
    sent = some.mapInArrow(lambda b: _send(b, size, parts), _SENT)
    replies = sent.groupBy("part").applyInArrow(lambda key, table: _reply(key, table, parts), _REPLY)
    repeated = replies.groupBy("part").applyInArrow(_gather, _REPEATED)
    # Documents are rows from the start, so however many have one set, no task gathers them.
    known = stored(some.mapInArrow(lambda b: _known(b, size), _KNOWN), "known")
    classes = known.filter("n > 0").groupBy("set").agg(
        F.max("n").alias("n"), F.min("doc_id").alias("doc_id"), F.min("check").alias("check"), F.max("check").alias("other"))
    classes = stored(classes.join(repeated, "set"), "classes")
    if not classes.filter("check <> other").isEmpty():
        raise ValueError("two different gram sets have one 64-bit fingerprint; change the hash base")
    wanted = classes.filter(f"repeated >= floor(({percent} * n + 99) / 100)").select("doc_id")
    loaded = some.join(wanted, "doc_id", "left_semi").mapInArrow(
        lambda b: _load(b, size), "set bigint, n bigint, grams array<bigint>")
    # A Bloom filter of the wanted ids, bounded by Spark, spares most texts the shuffle.
    small = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    before = spark.conf.get(small)
    spark.conf.set(small, "0")
    try:
        sets = stored(loaded.filter("n > 0").dropDuplicates(["set"]), "sets")
    finally:
        spark.conf.set(small, before)
    _, roots = set_links(sets, percent)
    least = classes.select("set", "doc_id").join(roots.withColumnRenamed("node", "set"), "set", "left")
    component = least.groupBy(F.coalesce("root", "set").alias("root")).agg(F.min("doc_id").alias("component_id"))
    named = least.select("set", F.coalesce("root", "set").alias("root")).join(component, "root").select("set", "component_id")
    linked = known.join(named, "set", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    rest = texts.filter(F.col("doc_id").isNull() | F.col("text").isNull()).select(
        "doc_id", F.lit(0).cast("bigint").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(rest)
