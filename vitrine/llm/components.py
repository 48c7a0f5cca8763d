"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours link to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours link to the least of those."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return joined.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (long columns ``a``, ``b``):
    the root is the smallest node of its component. A node that is its own
    root has no row. Each round is written to the shared folder, so lineage
    stays short and a lost executor costs one round's work at most; only a
    count and a checksum reach the driver. Self-links and nulls are ignored."""
    clean = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, seen = written(clean, "edges"), None
    state = _state(now)
    while state != seen and state[0]:
        seen = state
        now = written(_small_star(_large_star(now)), "stars")
        state = _state(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
