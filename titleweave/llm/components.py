"""Connected components of a link table, by alternating star contraction.

Each round replaces a node's links by links to its smallest neighbour, first towards larger
neighbours, then towards smaller ones, until every link points at the smallest node of its
component. A round is two groupings and two joins over the links; the number of rounds grows
with the logarithm of the nodes. Hub nodes are met by grouping with map-side combination and
by joins that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titleweave.llm.common import stage


def _star(links: DataFrame) -> DataFrame:
    """links (u, v) -> for every u, the smallest of u and its neighbours as ``m``, joined back."""
    least = links.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    return links.join(least, "u")


def components(links: DataFrame) -> DataFrame:
    """links (u, v) of bigint -> (node, root): each linked node with the smallest of its component.

    Loops, repeated links and both directions are allowed; null ends are ignored; no links give
    no rows.
    """
    now = stage(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = None
    while True:
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _star(large)
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))
        )
        now = stage(small.where("u <> v").distinct(), "links")
        # Order-free digest of the links: unchanged links are the fixed point.
        facts = now.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first()
        if tuple(facts) == state:
            break
        state = tuple(facts)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
