"""Connected components of a graph given by links, as a few rounds of joins.

Large-star and small-star rounds (Kiveris and others, 2014): each node's neighbours are
linked to the smallest one, until every component is a star around its smallest node.
Links and labels stay in stored tables; only two numbers a round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.sources.staging import Staging


def components(links: DataFrame, staging: Staging) -> DataFrame:
    """(node, component) for every node in `links` (a, b): its component's smallest node.

    Links with a null end, to oneself, or repeated change nothing.
    """
    stars = staging.pin(
        links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    before = None
    while True:
        state = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        least = stars.unionAll(stars.select(F.col("v").alias("u"), F.col("u").alias("v"))).groupBy("u").agg(
            F.min("v").alias("low")
        )
        nearest = least.select(F.col("u").alias("_node"), F.least("u", "low").alias("_low"))
        large = stars.join(nearest, F.col("v") == F.col("_node")).select("u", F.col("_low").alias("v"))
        lowest = large.groupBy("u").agg(F.min("v").alias("_low")).withColumnRenamed("u", "_node")
        small = large.join(lowest, F.col("u") == F.col("_node"))
        spokes = small.where("v != _low").select(F.col("v").alias("u"), F.col("_low").alias("v"))
        hubs = lowest.select(F.col("_node").alias("u"), F.col("_low").alias("v"))
        stars = staging.pin(spokes.unionAll(hubs).distinct(), "stars")
    ends = stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.unionAll(stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
