"""Connected components of an undirected graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablehaul.sources.files import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node are tied to its smallest one."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("low"))
    joined = down.join(least, "a")
    tied = joined.select("a", F.col("low").alias("b")).union(
        joined.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    )
    return tied.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the (a, b) edges, root being the smallest node reachable.

    Alternating large-star and small-star rounds; each round is written to the shared
    folder, so lineage stays short and a lost executor costs one round. Rounds grow with
    the logarithm of the longest path. The edge table never grows: a star step emits at
    most one row per edge end. Loops and edges with a NULL end are dropped.
    """
    edges = staged(
        edges.select(F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b"))
        .where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    state = _state(edges)
    while state[0]:
        edges = staged(_small_star(_large_star(edges)), "edges")
        last, state = state, _state(edges)
        if state == last:
            break
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _state(edges: DataFrame) -> tuple:
    """Equal for equal edge tables; three sums, so nothing large is compared."""
    mixed = F.xxhash64("a", "b")
    low = F.sum(mixed.bitwiseAND(F.lit(0xFFFFFFFF)))
    high = F.sum(F.shiftrightunsigned(mixed, 32))
    return tuple(edges.agg(F.count(F.lit(1)), low, high).first())
