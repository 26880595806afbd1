"""Connected components of links between ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id of ``links`` (a, b): the smallest id it is connected to.

    Rounds of two steps: each id hands its larger neighbours to its smallest one, then
    its smaller neighbours.  Links become stars around the smallest ids in a number of
    rounds that grows with the logarithm of the size.  Each round is a stored table; a
    hub is a key of aggregates and of joins that can be split, never one row or group.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while (now := tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head())) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(smallest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a")
        edges = stored(
            small.select("a", F.col("m").alias("b")).unionByName(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct(),
            "edges",
        )
    stars = edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("id"), "component").distinct())
