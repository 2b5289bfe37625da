"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b), two columns of one orderable type; root is the component's least node.

    Each round keeps at most as many edges as there were; rounds grow with
    the logarithm of the longest chain. Rounds are written to the shared folder.
    """
    edges = stored(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        nxt = stored(small.filter("a != b").distinct())
        if sums(nxt) == sums(edges):
            return nxt.select(F.col("a").alias("node"), F.col("b").alias("root")).union(nxt.select("b", "b").distinct())
        edges = nxt


def sums(edges: DataFrame) -> tuple:
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.bit_xor(h), F.sum((h % 1000003).cast("long"))).first())
