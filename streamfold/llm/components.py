"""Connected components of links, as rounds of joins.

Each round points every node at the smallest node it knows (large star,
then small star) until nothing changes; the rounds grow with the logarithm
of the longest chain.  Links stay in Spark; each round is written to the
shared folder, and so are the minima, so that a join with them deals both
sides anew and AQE can split the links of a hot node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """(u, v) with u > v to the links of one star step, again u > v."""
    if large:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        # Larger neighbours only: a node's larger neighbours are those it is linked from.
        moved = links.select(F.col("v").alias("u"), F.col("u").alias("w")).join(least, "u").select(
            F.col("w").alias("u"), F.col("m").alias("v"))
    else:
        least = stored(links.groupBy("u").agg(F.min("v").alias("m")), "least")
        moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return moved.filter("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): for every node with a link to another, the
    smallest node it reaches.  ``links``: columns u and v, any direction."""
    now = stored(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .filter("u > v").distinct(), "links")
    state = None
    while True:
        now = stored(_star(stored(_star(now, True), "large_star"), False), "small_star")
        got = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(got) == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        state = tuple(got)
