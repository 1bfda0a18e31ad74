"""Connected components of an edge table, in rounds of joins that each end in a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkgraph.llm.common import stash


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``: root is the smallest node it is linked to.

    Alternates two steps until nothing changes: every node hands the smallest
    node of its neighbourhood to its larger neighbours (large star), then to its
    smaller ones (small star).  The number of rounds grows with the logarithm of
    the component size; every round is an aggregate with map-side minimum and a
    join, and is stored in the checkpoint folder, so a lost executor repeats one
    round at most.  A hub's edges are joined with one row, which Spark can split.
    Edges with a null end and loops are ignored.
    """
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).alias("x"), F.col(b).alias("y"))
         .where(F.col("x").isNotNull() & F.col("y").isNotNull() & (F.col("x") != F.col("y"))).select("u", "v").distinct())
    def state(t: DataFrame) -> tuple:
        return tuple(t.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())

    e = stash(e, "cc")
    now = state(e)
    while now[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("m", "u").alias("m"))
        large = stash(both.where("v > u").join(least, F.col("u") == F.col("n"))
                      .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "cc-large")
        low = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), "m")
        e = stash(large.join(low, F.col("u") == F.col("n")).where("v != m")
                  .select(F.col("v").alias("u"), F.col("m").alias("v"))
                  .union(low).distinct(), "cc-small")
        before, now = now, state(e)
        if now == before:  # every component is a star around its smallest node
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
