"""Components of a link table: every step is a join or a map-side combined aggregate, each round is written and reread."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortspark.llm.common import settle


def components(links: DataFrame) -> DataFrame:
    """(node, root) of all nodes of the undirected links (u, v); root is the smallest node of the component.

    Each round hooks a node, and the root above it, to the smallest root next to it, then shortens the paths.
    """
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    edges = settle(both.filter("u <> v").distinct(), "links")
    now = settle(edges.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.least("u", "v").alias("root")), "roots")
    while True:
        beside = now.select(F.col("node").alias("v"), F.col("root").alias("near"))
        near = edges.join(beside, "v").groupBy(F.col("u").alias("node")).agg(F.min("near").alias("near"))
        hooked = settle(now.join(near, "node").select("node", "root", F.least("root", "near").alias("near")), "roots")
        above = hooked.groupBy(F.col("root").alias("node")).agg(F.min("near").alias("over"))
        lower = hooked.join(above, "node", "left").select("node", F.col("root").alias("old"), F.least("near", "over").alias("root"))
        lower = settle(lower, "roots")
        top = lower.select(F.col("node").alias("root"), F.col("root").alias("next"))
        short = lower.join(top, "root", "left").select("node", F.coalesce("next", "root").alias("root"), "old")
        now = settle(short, "roots")
        if not now.filter("root <> old").take(1):
            return now.select("node", "root")
        now = now.select("node", "root")
