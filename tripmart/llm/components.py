"""Connected components of an edge table by alternating stars.

A large star links a node's larger neighbours to its smallest one, a small star the
smaller ones. Both are an aggregation with a partial step and a join. The least
neighbours are stored before the join, so that both of its sides are dealt out by
their own shuffle and a node with very many edges can be split. Each round is stored
in the shared folder; only two numbers a round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.mixing import stored

_ROUNDS = 60


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m")), "least")
    joined = both.join(least, both["a"] == least["n"]).where(F.col("b") > F.col("a"))
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = stored(down.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")), "least")
    joined = down.join(least, F.col("a") == F.col("n"))
    others = joined.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)``: every node that has an edge, and the least node it reaches.

    ``edges`` has columns ``a`` and ``b`` of one orderable type, in any direction,
    repeated or not; edges to a node itself and nulls are ignored.
    """
    edges = stored(edges.where("a <> b").select("a", "b").distinct(), "edges")
    before = None
    for _ in range(_ROUNDS):
        edges = stored(_small(_large(edges)), "edges")
        now = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if now == before or not now[0]:
            break
        before = now
    else:
        raise RuntimeError("the components did not settle")
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return leaves.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
