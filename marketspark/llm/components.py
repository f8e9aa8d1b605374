"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketspark.llm.common import discard, keep


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node reachable) of every node of ``links`` (a, b); nodes are longs, not null.

    Alternates the large and the small star (Kiveris and others, 2014): each round links a node's neighbours to the least of them,
    so chains shorten geometrically. A node with very many links costs a partial minimum and a join that AQE can split.
    Each round is a written table, and every join a sort-merge join: both sides grow with the links.
    Links with a null end are left out; no links give no nodes.
    """
    stars = keep(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "links")
    state = None
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest.hint("merge"), "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = keep(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct(), "links")
        discard(stars)
        stars = after
        now = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            break
        state = now
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
