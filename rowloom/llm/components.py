"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.tables import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest of its neighbours and itself."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours and itself to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b"))).where("a != b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first())


def connected_components(links: DataFrame, most_rounds: int = 50) -> DataFrame:
    """node, root for every node that has a link; root is the smallest node of its component.

    links: a, b (long). Rounds of large star and small star, each written to the shared folder, until nothing changes;
    their number grows with the logarithm of the longest path. Only a count and a checksum come to the driver.
    A hot node is one key of the joins, which adaptive execution splits."""
    edges = written(links.where("a != b"), "links")
    state = _state(edges)
    for _ in range(most_rounds):
        edges = written(_small_star(_large_star(edges)), "stars")
        last, state = state, _state(edges)
        if state == last:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
