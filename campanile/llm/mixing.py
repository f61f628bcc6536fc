"""Mixing sources to target weights with a low-discrepancy schedule.

A source that is to give ``t`` words gets ``ceil(t / BLOCK_WORDS)`` slots.  Slots are dealt by van
der Corput points: the bit-reversed numbers ``0 .. 2**k - 1`` visit every place of the
cumulative slot counts once and evenly, so any stretch of the schedule holds the sources in
nearly their shares, and each source gets its slots exactly.  A source's documents, in an
order shuffled by hash and repeated as often as needed, are cut into blocks of equal length;
its ``r``-th slot takes its ``r``-th block.

Running sums over documents or slots go through two levels of buckets, so a source with most of
the rows is summed by many tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campanile.llm.store import stored

BLOCK_WORDS = 1024
#: A source is repeated at most so many times.
MAX_REPEATS = 3
#: Rows of a source that one task sorts for a running sum, about.
BUCKET_ROWS = 256
WORD = r"[^\x20\x09-\x0D]+"


def running_sum(rows: DataFrame, group: str, value: str, coarse: Column, fine: Column, order: list[str]) -> DataFrame:
    """``rows`` with ``before``: the sum of ``value`` over the group's earlier rows.

    ``coarse`` and ``fine`` are bucket numbers that rise with ``order``; only a bucket's rows meet in a task.
    """
    rows = rows.withColumns({"coarse": coarse, "fine": fine})
    fines = rows.groupBy(group, "coarse", "fine").agg(F.sum(value).alias("total"))
    coarses = fines.groupBy(group, "coarse").agg(F.sum("total").alias("total"))

    def earlier(name: str, *keys: str, by: list[str]) -> Column:
        over = Window.partitionBy(*keys).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(name).over(over), F.lit(0)).cast("bigint")

    coarses = coarses.select(group, "coarse", earlier("total", group, by=["coarse"]).alias("in_coarse"))
    fines = fines.select(group, "coarse", "fine", earlier("total", group, "coarse", by=["fine"]).alias("in_fine"))
    starts = fines.join(coarses, [group, "coarse"]).select(group, "coarse", "fine", (F.col("in_coarse") + F.col("in_fine")).alias("start"))
    inside = rows.withColumn("inside", earlier(value, group, "coarse", "fine", by=order))
    return inside.join(starts, [group, "coarse", "fine"]).withColumn("before", F.col("start") + F.col("inside")).drop(
        "coarse", "fine", "start", "inside")


def targets(sources: DataFrame) -> DataFrame:
    """``target`` for each row of ``sources(weight, source_size)``: the total size, shared by weight.

    A target above ``MAX_REPEATS`` times the source's size stops there; what is over is shared out again by
    weight until none is above.  Only totals reach the driver.
    """
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    cap, level = F.col("source_size") * MAX_REPEATS, 0.0
    while True:
        capped = F.col("weight") * level >= cap
        fixed, open_weight = sources.agg(F.sum(F.when(capped, cap)), F.sum(F.when(~capped, F.col("weight")))).first()
        found = (total - (fixed or 0)) / open_weight if open_weight else level
        if found <= level:
            break
        level = found
    return sources.withColumn("target", F.least(cap.cast("double"), F.col("weight") * F.lit(float(level))))


def _slots(sources: DataFrame) -> DataFrame:
    """``slot, place, turn``: the schedule's slots in order, their source's place and which of its slots they are."""
    quota = stored(running_sum(sources.withColumn("slots", F.ceil(F.col("words") / BLOCK_WORDS)).withColumn("all", F.lit(0)),
                               "all", "slots", F.floor(F.col("place") / (1 << 20)), F.floor(F.col("place") / (1 << 10)), ["place"]), "quota")
    number, count = quota.agg(F.sum("slots"), F.count("*")).first()
    bits = max(1, math.ceil(math.log2(max(number or 0, 1) + 1)))
    # The bit-reversed slot number: a permutation of 0 .. 2**bits - 1, of which the first ``number`` are used.
    point = F.conv(F.reverse(F.lpad(F.bin("id"), bits, "0")), 2, 10).cast("bigint")
    points = sources.sparkSession.range(1 << bits).select(F.col("id").alias("slot"), point.alias("point")).filter(
        F.col("point") < F.lit(number or 0))
    # Points meet their source in cells of equal width: an equality join, whatever the number of sources.
    width = max(1, -(-(number or 1) // (4 * (count or 1) + 1024)))
    cells = quota.filter("slots > 0").select("place", F.col("before").alias("low"), (F.col("before") + F.col("slots")).alias("high"))
    cells = cells.withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width))))
    dealt = points.withColumn("cell", F.floor(F.col("point") / width)).join(cells, "cell").filter(
        "point >= low AND point < high").select("slot", "place", F.lit(1).cast("bigint").alias("one"))
    ranked = running_sum(dealt, "place", "one", F.floor(F.col("slot") / (1 << 20)), F.floor(F.col("slot") / 1024), ["slot"])
    return ranked.select("slot", "place", F.col("before").alias("turn"))


def sized(docs: DataFrame, *keep: str) -> tuple[DataFrame, DataFrame]:
    """Documents with ``size``, ``place`` of their source and ``start`` in its shuffled order; and the sources.

    Sources are placed by code point, the null source last, and weigh 1, 2, 3 in turn.
    """
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint")
    rows = stored(docs.select("doc_id", F.col("source").cast("string").alias("source"), size.alias("size"), *keep), "sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
    # One row per source; the order of sources is what the weights are defined by.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    sources = stored(sources.withColumn("place", place.cast("bigint")).withColumn("weight", F.col("place") % 3 + 1), "sources")
    sources = stored(targets(sources).withColumn("words", F.floor(F.col("target") + F.lit(1e-6)).cast("bigint")), "targets")
    placed = rows.join(sources, rows["source"].eqNullSafe(sources["source"])).select(
        rows["*"], "place", "source_size", "source_rows", "target", "words")
    order = F.xxhash64(F.lit("order"), F.col("doc_id"), F.col("size"))
    placed = placed.withColumn("order", F.pmod(order, F.lit(1 << 40)))
    side = F.ceil(F.sqrt(F.col("source_rows") / BUCKET_ROWS))
    fine = F.floor(F.col("order") / (1 << 40) * side * side)
    return running_sum(placed, "place", "size", F.floor(fine / side), fine, ["order", "doc_id", "size"]).withColumnRenamed(
        "before", "start").drop("order", "source_rows"), sources


def schedule(placed: DataFrame, sources: DataFrame) -> DataFrame:
    """All rows of ``placed`` with at least one word, once for each slot that takes some of their words.

    Adds ``slot``, ``first`` (word of the document, from 0) and ``part_words``; rows that no slot takes have nulls.
    """
    epoch = F.explode(F.sequence(F.lit(0), F.lit(MAX_REPEATS - 1)))
    runs = placed.filter("size > 0").withColumn("epoch", epoch).withColumn("from", F.col("start") + F.col("epoch") * F.col("source_size"))
    runs = runs.withColumn("to", F.least(F.col("from") + F.col("size"), F.col("words"))).filter("epoch = 0 OR to > from")
    turns = F.when(F.col("to") > F.col("from"), F.sequence(F.floor(F.col("from") / BLOCK_WORDS), F.floor((F.col("to") - 1) / BLOCK_WORDS)))
    parts = runs.withColumn("turn", F.explode_outer(turns))
    low = F.greatest("from", F.col("turn") * BLOCK_WORDS)
    high = F.least("to", (F.col("turn") + 1) * BLOCK_WORDS)
    parts = parts.withColumns({"first": low - F.col("from"), "part_words": high - low}).drop("from", "to", "epoch")
    return parts.join(_slots(sources), ["place", "turn"], "left").drop("turn")


def mix(docs: DataFrame, *keep: str) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` and ``keep`` columns for every row of ``docs(doc_id, text, source)``.

    Every source gives its target to the word (rounded down), no document more than ``MAX_REPEATS`` times its size.
    Null and empty texts have size 0 and take nothing; a null source is a source; rows with a null or
    repeated doc_id count like any other; equal ones are interchangeable.  An empty table gives an empty
    result.  Runs agree: the order is a hash of the rows.
    """
    placed, sources = sized(docs, *keep)
    placed = stored(placed, "placed")
    keys = ["doc_id", "place", "start", "size", "source_size", "target", *keep]
    taken = schedule(placed, sources).groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(F.col("slot").isNotNull(), F.col("part_words"))), F.lit(0)).cast("bigint").alias("taken"))
    empty = placed.filter("size = 0").withColumn("taken", F.lit(0).cast("bigint"))
    columns = ["doc_id", "size", "source_size", "target", "taken", *keep]
    return taken.select(*columns).unionByName(empty.select(*columns))
