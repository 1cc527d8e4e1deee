"""Connected components of a graph given as links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import store


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """Links every larger (or smaller and own) neighbour of a node to the smallest of its neighbourhood.

    Only the minimum of a neighbourhood is gathered; the links are joined with it, so a hot node is a skewed join that
    Spark splits and no list of neighbours is ever built.
    """
    if larger:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hubs = both.groupBy("a").agg(F.least("a", F.min("b")).alias("hub"))
        return both.filter("b > a").join(hubs, "a").select(F.col("b").alias("a"), F.col("hub").alias("b")).filter("a != b").distinct()
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    hubs = down.groupBy("a").agg(F.min("b").alias("hub"))
    joined = down.join(hubs, "a")
    kept = joined.select(F.col("b").alias("a"), F.col("hub").alias("b")).filter("a != b")
    return kept.union(hubs.select("a", F.col("hub").alias("b"))).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) for every node with a link to another node."""
    now = store(links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a != b").distinct(), "links")
    before = None
    while True:
        # Small stars leave each node with links to smaller nodes only; the sums tell whether anything moved.
        now = store(_star(_star(now, True), False), "links")
        got = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s")).first()
        if (got.n, got.s) == before:
            break
        before = (got.n, got.s)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
