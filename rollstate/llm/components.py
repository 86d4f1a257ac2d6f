"""Connected components of a graph of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollstate.session import scratch_dir


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's least neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("_least"))
    tied = both.join(least, "a").filter(F.col("b") > F.col("a"))
    return tied.select(F.col("b").alias("a"), F.col("_least").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is tied to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("_least"))
    tied = down.join(least, "a")
    ends = tied.select(F.explode(F.array(F.struct("a", F.col("_least").alias("b")), F.struct(F.col("b").alias("a"), F.col("_least").alias("b")))).alias("e"))
    return ends.select("e.a", "e.b").filter("a <> b").distinct()


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``node`` and ``component`` (its least node) of every node on an edge (``a``, ``b``), both long.

    Alternating star contractions: stars shrink every path about by half each round, and a round
    moves only edges.  Each round's edges are written to the shared folder, which cuts the lineage.
    Self-loops and null ends are ignored; repeated edges count once.
    """
    spark = edges.sparkSession
    base = scratch_dir(spark, label)
    current, mark, r = edges.select("a", "b").filter("a <> b").distinct(), None, 0
    while True:
        _small_star(_large_star(current)).write.parquet(f"{base}/{r}")
        current = spark.read.parquet(f"{base}/{r}")
        now = tuple(current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").bitwiseAND(F.lit((1 << 40) - 1)))).first())
        if now == mark:
            break
        mark, r = now, r + 1
    leaves = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.union(current.select("b", "b").distinct())
