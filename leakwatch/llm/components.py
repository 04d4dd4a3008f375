"""Connected components of an edge table, in Spark.

Large-star and small-star rounds (alternating) until nothing moves: every
round hangs the larger neighbours of a node on its smallest one. The depth of
the graph halves at least, so a chain of a million links takes about twenty
rounds. Sums over neighbours are partial aggregates and the joins back can be
split by adaptive execution, so a node with very many neighbours is no hot
task. Nothing is collected but one row of counts a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that has an edge to a smaller one in its
    component; the smallest node of a component is its root and has no row.
    Null ends, loops and repeated edges are allowed."""
    e = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("node"), F.least(a, b).alias("root"))
    e = e.distinct().checkpoint()
    seen = None
    while True:
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "root"))).first()
        if now == seen or not now[0]:
            return e
        seen = now
        both = e.select(F.col("node").alias("u"), F.col("root").alias("v")).union(e.select(F.col("root").alias("u"), F.col("node").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("node"), F.col("m").alias("root")).distinct()
        top = large.groupBy("node").agg(F.min("root").alias("m"))
        small = large.join(top, "node").where(F.col("root") != F.col("m")).select(F.col("root").alias("node"), F.col("m").alias("root"))
        e = small.union(top.select("node", F.col("m").alias("root"))).distinct().checkpoint()
