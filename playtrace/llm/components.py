"""Connected components of a distributed list of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrace.llm.common import stored


def _star(links: DataFrame, label: str) -> tuple[DataFrame, tuple]:
    kept = stored(links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    return kept, tuple(kept.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1000003)).first())


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """``node, root`` for every node that has a link, from links ``a, b``; the root is the smallest node reached.

    Each turn replaces the links by the stars of their neighbourhoods (each written to the shared folder), until a turn
    changes nothing. A node with many links is a key of an aggregation with partial sums and of a join that Spark can split.
    """
    links, state = _star(links, label)
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
        links, now = _star(small, label)
        if now == state:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        state = now
