"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodtide.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every end of ``a, b`` links: the smallest node each can reach.

    Alternating star contraction: every node hands its larger neighbours, then its smaller ones,
    to the smallest of them, until nothing changes; the rounds grow with the logarithm of the
    longest path. A round is two minima, folded map-side, and two joins on a node, which Spark
    splits where a node has very many links. No neighbourhood is ever gathered. Rounds are written
    to the shared folder, so no lineage builds up. Ends are not null; self-links do nothing.
    """
    edges = stored(
        links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        large = stored(large.distinct(), "links")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct(), "links")
        # Equal sums over all links mean, but for a chance of 2**-64, the same links.
        after = edges.agg(F.count("*"), F.expr("sum(CAST(xxhash64(u, v) AS DECIMAL(38, 0)))")).first()
        if after == before:
            roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
        before = after
