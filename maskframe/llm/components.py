"""Connected components of a table of links: no link, label or component passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def components(links: DataFrame, scratch: Scratch, rounds: list[str] | None = None) -> DataFrame:
    """links (a long, b long) -> (id, root): for each linked node the smallest node reachable.

    Each node points to the smallest of itself and its neighbours. Pointers are then doubled (a node takes its target's
    target) until all end at a local minimum, and links are contracted to those minima; at least half of the nodes go with
    each contraction. A chain of n nodes in the order of their ids takes one contraction and log2(n) doublings. Hubs are
    safe: minima combine before the shuffle, and joins on a hub are inner or left joins that adaptive execution may split.
    `rounds`, if given, gets a word for each step."""
    told = rounds if rounds is not None else []
    edges = scratch.save(links.filter("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct())
    roots: DataFrame | None = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hooks = scratch.save(both.groupBy(F.col("u").alias("id")).agg(F.least(F.min("v"), F.col("id")).alias("hook")))
        told.append("contract")
        moved = True
        while moved:
            further = hooks.join(hooks.select(F.col("id").alias("hook"), F.col("hook").alias("next")), "hook")
            jumped = scratch.save(further.select("id", F.col("next").alias("hook"), F.expr("next <> hook").alias("moved")))
            scratch.drop(hooks)
            hooks, moved = jumped, not jumped.filter("moved").isEmpty()
            told.append("double")
        if roots is None:
            roots = scratch.save(hooks.select("id", F.col("hook").alias("root")))
        else:
            old = roots
            roots = scratch.save(old.join(hooks.select(F.col("id").alias("root"), "hook"), "root", "left").select("id", F.coalesce("hook", "root").alias("root")))
            scratch.drop(old)
        ends = edges.join(hooks.select(F.col("id").alias("u"), F.col("hook").alias("x")), "u").join(hooks.select(F.col("id").alias("v"), F.col("hook").alias("y")), "v")
        fewer = scratch.save(ends.filter("x <> y").select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).distinct())
        scratch.drop(edges, hooks)
        edges = fewer
        if edges.isEmpty():
            scratch.drop(edges)
            return roots
