"""Connected components of links between numbered nodes, group by group: no link, node or component passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import written


def components(links: DataFrame, within: list[str]) -> DataFrame:
    """links (within..., a long, b long) -> (within..., id, root): for each linked node the smallest that it reaches in its group.

    Every node points to the least of itself and its neighbours; pointers are doubled until all end at a node that points to
    itself, and links are drawn between these, of which at least half go each time. Steps are written, so lineage stays short."""

    def to(pointers: DataFrame, node: str, name: str) -> DataFrame:
        return pointers.select(*within, F.col("id").alias(node), F.col("to").alias(name)).hint("merge")

    left = written(links.filter("a <> b").select(*within, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    roots = None
    while not left.isEmpty():
        both = left.unionByName(left.select(*within, F.col("b").alias("a"), F.col("a").alias("b")))
        pointers = written(both.groupBy(*within, F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("to")))
        while True:
            further = written(pointers.join(to(pointers, "to", "next"), [*within, "to"]).select(*within, "id", "to", "next"))
            pointers = further.select(*within, "id", F.col("next").alias("to"))
            if further.filter("next <> to").isEmpty():
                break
        roots = pointers.select(*within, "id", F.col("to").alias("root")) if roots is None else written(roots.join(to(pointers, "root", "next"), [*within, "root"], "left").select(*within, "id", F.coalesce("next", "root").alias("root")))
        ends = left.join(to(pointers, "a", "p"), [*within, "a"]).join(to(pointers, "b", "q"), [*within, "b"]).filter("p <> q")
        left = written(ends.select(*within, F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct())
    return left.select(*within, F.col("a").alias("id"), F.col("b").alias("root")) if roots is None else roots
