"""Connected components by alternating large-star and small-star rounds.

Every round is a partial aggregate (minimum neighbour per node) joined back
to the edges; rounds are logarithmic in practice. Edges never reach the
driver: it only sees a count and a checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut


def _signature(e: DataFrame) -> tuple:
    row = e.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"),
                F.sum(F.col("a").cast("decimal(38,0)")).alias("s")).head()
    return row["n"], row["x"], row["s"]


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges`` (a, b: long) -> (node, component): the smallest node that
    can be reached, for every node that has an edge to another node.
    Self-loops and repeated edges are ignored; no edges gives no rows."""
    e = cut(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .where("a < b").distinct())
    before = _signature(e)
    for _ in range(max_rounds):
        # large star: link every larger neighbour to the smallest one around
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = cut(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = both.join(least, "u").where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        large = cut(large)
        # small star: link every smaller neighbour and the node to the smallest
        least = cut(large.groupBy("b").agg(F.min("a").alias("m")))
        down = large.join(least, "b").where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
        e = cut(down.unionAll(least.select(F.col("m").alias("a"), F.col("b"))).distinct())
        after = _signature(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("b").alias("node"), F.col("a").alias("component")).unionAll(
        e.select(F.col("a").alias("node"), F.col("a").alias("component"))).distinct()
