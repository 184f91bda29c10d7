"""Star-convex polygons (a centre, and distances to the outline along evenly spaced rays) as labels.

An outline meets a row of pixels at places that the edges give; between the first and the second of them, the third and the fourth,
and so on the row lies inside. All of it is expressions on a polygon's own row, then a row for each pixel; where polygons overlap,
the more probable one has the pixel, and of equally probable ones the later.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What a polygon is besides its plane's key: its number, centre, probability and distances.
POLYGON = ["point", "py", "px", "prob", "dist"]


def in_cores(polygons: DataFrame, tile: int) -> DataFrame:
    """Polygons (tile_y, tile_x, py, px, ...) found in tiles with halos, without those whose centre lies in another tile's core."""
    return polygons.filter((F.floor(F.col("py") / tile) == F.col("tile_y")) & (F.floor(F.col("px") / tile) == F.col("tile_x")))


def outlines(polygons: DataFrame, scale_y: float = 1.0, scale_x: float = 1.0) -> DataFrame:
    """With `outline`, an array of corners (y, x). Centres and distances are in pixels that are scale_y by scale_x pixels of the result."""
    turn = lambda k: k * (2 * math.pi) / F.size("dist")
    corner = lambda d, k: F.struct((F.col("py") * scale_y + d * scale_y * F.sin(turn(k))).alias("y"), (F.col("px") * scale_x + d * scale_x * F.cos(turn(k))).alias("x"))
    return polygons.withColumn("outline", F.transform("dist", corner))


def rows_inside(shapes: DataFrame, height: int, width: int) -> DataFrame:
    """A row (all columns but the outline, y, first, last) for each stretch of pixels inside an outline. An edge counts for the rows
    from its lower end, which it includes, to its upper end, which it doesn't."""
    ends = [F.array_min(F.col("outline.y")), F.array_max(F.col("outline.y"))]
    low, high = F.greatest(F.ceil(ends[0]), F.lit(0)), F.least(F.floor(ends[1]), F.lit(height - 1))
    some = shapes.filter(F.size("outline") > 2).withColumn("y", F.explode(F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))))
    edges = F.expr("zip_with(outline, concat(slice(outline, 2, size(outline)), slice(outline, 1, 1)), (a, b) -> struct(a, b))")
    crossed = F.expr("array_sort(transform(filter(edges, e -> (e.a.y <= y) <> (e.b.y <= y)), e -> e.a.x + (y - e.a.y) * (e.b.x - e.a.x) / (e.b.y - e.a.y)))")
    pairs = F.expr("transform(filter(sequence(0, size(crossed)), k -> k % 2 = 0 and k + 1 < size(crossed)), k -> struct(crossed[k] as a, crossed[k + 1] as b))")
    rows = some.withColumn("edges", edges).withColumn("crossed", crossed).withColumn("p", F.explode(pairs))
    kept = [c for c in shapes.columns if c != "outline"]
    stretch = rows.select(*kept, "y", F.greatest(F.ceil("p.a"), F.lit(0)).alias("first"), F.least(F.floor("p.b"), F.lit(width - 1)).alias("last"))
    return stretch.filter("first <= last")


def polygons_to_labels(polygons: DataFrame, height: int, width: int, scale_y: float = 1.0, scale_x: float = 1.0) -> DataFrame:
    """Labels (plane's key, y, x, label) of polygons (plane's key, point, py, px, prob, dist): the numbers of the points."""
    keys = [c for c in polygons.columns if c not in POLYGON]
    rows = rows_inside(outlines(polygons, scale_y, scale_x), height, width)
    pixels = rows.select(*keys, "point", "prob", "y", F.explode(F.sequence("first", "last")).alias("x"))
    return pixels.groupBy(*keys, "y", "x").agg(F.max_by("point", F.struct("prob", "point")).alias("label"))
