"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campanile.llm.store import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above ``u`` is tied to the least of ``u`` and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """``u`` and its smaller neighbours are tied to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).filter("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(u, v)``; the root is the component's least node.

    Each round halves the depth at least, sums and minima combine before the shuffle, and
    no component is ever gathered in one task.  Self-loops and repeated edges are harmless;
    nodes without an edge to another node are not returned.
    """
    current = stored(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    print_of = None
    while True:
        current = stored(_small_star(_large_star(current)), "stars")
        found = current.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(found) == print_of:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        print_of = tuple(found)
