"""Connected components: the grouping primitive behind duplicate classes and leak-free partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialise


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", nodes: DataFrame | None = None, max_rounds: int = 100) -> DataFrame:
    """(node, component): the representative is the least node of the component, whatever the order of the edges.

    Alternates large-star and small-star until the edges stay the same, which takes O(log^2 n) rounds. A star step is
    one aggregate with map-side combine and one join, so a hub with any number of neighbours is never gathered in one
    task. Each round is written to the shared folder. Self loops and repeated edges are allowed; edges with a null end
    are ignored. `nodes` (first column) adds nodes without edges, as their own components.
    """
    current = materialise(_oriented(edges.select(F.col(src).alias("a"), F.col(dst).alias("b"))), "cc")
    mark = _mark(current)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        last, current = current, materialise(_small_star(_large_star(current)), "cc")
        discard(last)
        before, mark = mark, _mark(current)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    own = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    out = own.unionByName(roots)
    if nodes is not None:
        key = nodes.columns[0]
        alone = nodes.select(F.col(key).alias("node")).where(F.col("node").isNotNull()).distinct()
        out = alone.join(out, "node", "full").select("node", F.coalesce("component", "node").alias("component"))
    return out


def component_edges(items: DataFrame, item: Column, identity: Column) -> DataFrame:
    """(src, dst) star edges from every item to the least item that shares its identity; null identities link nothing."""
    rows = items.select(item.alias("src"), identity.alias("_identity")).where("src IS NOT NULL AND _identity IS NOT NULL")
    least = rows.groupBy("_identity").agg(F.min("src").alias("dst"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    return rows.join(least, "_identity").where("src <> dst").select("src", "dst").distinct()


def _oriented(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    moved = both.where("b > a").join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())
