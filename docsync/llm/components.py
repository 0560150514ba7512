"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsync.llm.common import drop, stage


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in links (a, b): the smallest id it is connected with.

    Alternates large-star and small-star steps, which halve long chains, until nothing changes.
    Each step is a written table. Every step only groups links by one end, and a hub's minimum is
    taken before the shuffle and joined back, so no group is ever gathered.
    """
    edges = stage(links.filter("a <> b").select(F.greatest("a", "b").alias("u"),
                                                F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        both = edges.union(edges.select(F.col("v"), F.col("u"))).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low"))
        # Large star: larger neighbours of u move to the least of u and its neighbours.
        large = both.filter("v > u").join(least, "u").select(
            F.col("v").alias("u"), F.col("low").alias("v")).filter("u <> v").distinct()
        large = stage(large, "large")
        # Small star: u and its smaller neighbours move to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct(F.col("u"), F.col("low").alias("v")),
                              F.struct(F.col("v").alias("u"), F.col("low").alias("v")))).alias("e")
        ).select("e.*").filter("u <> v").distinct()
        small = stage(small, "small")
        changed = small.join(edges, ["u", "v"], "left_anti").limit(1).count() \
            or edges.join(small, ["u", "v"], "left_anti").limit(1).count()
        drop(edges)
        drop(large)
        edges = small
        if not changed:
            break
    ids = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return ids.union(roots)
