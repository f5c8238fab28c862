"""Connected components of an edge table, all in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); the root is the smallest node reachable.

    Alternates large-star and small-star: each node points its larger, then its smaller
    neighbours at its smallest one, until nothing changes; the rounds grow with the
    logarithm of a component's size.  A hot node's neighbours are only aggregated.
    """
    now = materialize(edges.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).filter("lo < hi").distinct(), "edges")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("hi").alias("lo"), F.col("lo").alias("hi")))  # lo: the node, hi: its neighbour
        least = both.groupBy("lo").agg(F.min("hi").alias("m")).select(F.col("lo").alias("u"), F.least("lo", "m").alias("m"))
        large = both.join(least, both.lo == least.u).filter("hi > lo").select(F.col("m").alias("lo"), "hi").filter("lo < hi").distinct()
        down = large.select(F.col("hi").alias("u"), F.col("lo").alias("v"))  # u: the node, v: a smaller neighbour
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).unionByName(low.select(F.col("m").alias("lo"), F.col("u").alias("hi"))).filter("lo < hi").distinct()
        now = materialize(small, "edges")
        state = now.agg(F.count("*"), F.sum(F.hash("lo", "hi").cast("long")), F.bit_xor(F.xxhash64("lo", "hi"))).first()
        if state == before:
            break
        before = state
    pairs = now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return pairs.unionByName(now.select(F.col("lo").alias("node"), F.col("lo").alias("root"))).groupBy("node").agg(F.min("root").alias("root"))
