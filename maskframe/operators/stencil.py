"""Neighbourhood and resampling operations on pixel tables. A plane is what image, timepoint, channel and z name, as far as a
table has them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tiles


def plane_of(pixels: DataFrame, *without: str) -> list[str]:
    return [c for c in ("image_id", "t", "channel_index", "z") if c in pixels.columns and c not in without]


def binomial_smooth(pixels: DataFrame, height: int, width: int, tile: int = 512, finite: bool = False) -> DataFrame:
    """3 by 3 binomial smoothing (1-2-1 both ways, over 16); edges repeat; what isn't finite counts as the plane's median, for which
    the values are looked at first unless the caller knows that all are finite.

    Pixels meet as blocks, and blocks exchange one pixel at their edges; a place that isn't named counts as 0."""
    plane = plane_of(pixels)
    rows = pixels.select(*plane, "y", "x", F.col("value").cast("double").alias("value"))
    known = F.coalesce(~F.isnan("value") & (F.abs("value") != float("inf")), F.lit(False))
    if not finite and not (odd := rows.filter(~known).select(*plane).distinct()).isEmpty():
        fill = rows.join(odd.hint("merge"), plane, "left_semi").groupBy(*plane).agg(F.percentile(F.when(known, F.col("value")), F.lit(0.5)).alias("fill"))
        rows = rows.join(fill.hint("merge"), plane, "left").withColumn("value", F.when(known, F.col("value")).otherwise(F.coalesce("fill", F.lit(0.0)))).drop("fill")
    blocks = tiles.to_blocks(rows, height, width, tile)
    return tiles.to_pixels(tiles.mapped(blocks, tiles.binomial) if max(height, width) <= tile else tiles.smoothed(blocks, tile))


def stretched(pixels: DataFrame) -> DataFrame:
    """Values between the 0.5 and 99.8 percentile of the finite pixels as 0 to 255, cut off and truncated."""
    finite = ~F.isnan("value") & (F.abs("value") != float("inf"))
    ends = pixels.filter(finite).groupBy("image_id", "channel_index").agg(F.percentile("value", F.array(F.lit(0.005), F.lit(0.998))).alias("p"))
    low = F.col("p")[0]
    high = F.when(F.col("p")[1] <= low, low + 1.0).otherwise(F.col("p")[1])
    scaled = (F.col("value") - low) * 255.0 / (high - low)
    return pixels.join(ends.hint("merge"), ["image_id", "channel_index"]).withColumn("value", F.floor(F.least(F.greatest(scaled, F.lit(0.0)), F.lit(255.0))).cast("int")).drop("p")


def projected(pixels: DataFrame) -> DataFrame:
    """The largest value over all planes."""
    return pixels.groupBy(*plane_of(pixels, "z"), "y", "x").agg(F.max("value").alias("value"))


def decimated(pixels: DataFrame) -> DataFrame:
    """The next pyramid level: every second row and column."""
    return pixels.filter((F.col("y") % 2 == 0) & (F.col("x") % 2 == 0)).withColumns({"y": F.floor(F.col("y") / 2), "x": F.floor(F.col("x") / 2)})


def pyramid(pixels: DataFrame, height: int, width: int, least: int = 512, most: int = 5) -> list[DataFrame]:
    """Levels, the whole picture first, while its shorter side has `least` pixels, `most` levels at most."""
    levels = [pixels]
    while min(height, width) >= least and len(levels) < most:
        levels.append(decimated(levels[-1]))
        height, width = (height + 1) // 2, (width + 1) // 2
    return levels


def centre_crop(pixels: DataFrame, height: int, width: int, size: int) -> DataFrame:
    """The middle of the picture, `size` at most each way, with positions from 0."""
    ch, cw = min(height, size), min(width, size)
    y0, x0 = (height - ch) // 2, (width - cw) // 2
    inside = pixels.filter(F.col("y").between(y0, y0 + ch - 1) & F.col("x").between(x0, x0 + cw - 1))
    return inside.withColumns({"y": F.col("y") - y0, "x": F.col("x") - x0})


def resized_nearest(pixels: DataFrame, height: int, width: int, to_height: int, to_width: int) -> DataFrame:
    """Each target place k with the pixel floor(k n / m) of n onto m. Sources emit their targets; there is no join."""
    def targets(v: Column, n: int, m: int) -> Column:
        first = lambda k: F.floor((k * m + n - 1) / n)
        # a source that no target names has none
        near = F.sequence(F.greatest(F.lit(0).cast("long"), first(v) - 1), F.least(F.lit(m - 1).cast("long"), first(v + 1)))
        return F.filter(near, lambda k: F.floor(k * n / m) == v)

    rows = pixels.withColumn("ty", F.explode(targets(F.col("y"), height, to_height)))
    return rows.withColumn("tx", F.explode(targets(F.col("x"), width, to_width))).withColumns({"y": F.col("ty"), "x": F.col("tx")}).drop("ty", "tx")


def bilinear_weights(n: int, m: int) -> list[tuple[int, int, float]]:
    """(target, source, weight) of a bilinear resize of n places onto m: a triangle about the target's centre, as wide as a target where
    there are fewer of these (so that no source is passed over), cut at the ends and brought to a sum of one."""
    scale, out = n / m, []
    reach = max(1.0, scale)
    for k in range(m):
        centre = scale * (k + 0.5)
        first, last = max(int(centre - reach + 0.5), 0), min(int(centre + reach + 0.5), n)
        weights = [max(0.0, 1.0 - abs(j - centre + 0.5) / reach) for j in range(first, last)]
        out += [(k, j, w / sum(weights)) for j, w in zip(range(first, last), weights, strict=True)]
    return out


def bilinear_matrix(n: int, m: int) -> np.ndarray:
    out = np.zeros((m, n))
    for k, j, w in bilinear_weights(n, m):
        out[k, j] = w
    return out


def resized_bilinear(pixels: DataFrame, height: int, width: int, to_height: int, to_width: int) -> DataFrame:
    """Bilinear with antialiasing, one axis after the other: each is a join with a table of weights, of a few rows for each target, and
    a sum that combines before it is shuffled."""
    spark, out = pixels.sparkSession, pixels
    for axis, n, m in (("x", width, to_width), ("y", height, to_height)):
        if n != m:
            weights = F.broadcast(spark.createDataFrame(bilinear_weights(n, m), "to long, from long, w double"))  # as long as a side of a plane
            other = [c for c in (*plane_of(pixels), "y", "x") if c != axis]
            out = out.join(weights, F.col(axis) == F.col("from")).groupBy(*other, F.col("to").alias(axis)).agg(F.sum(F.col("value") * F.col("w")).alias("value"))
    return out.select(*plane_of(pixels), "y", "x", "value")


def resized_planes(blocks: DataFrame, to_height: int, to_width: int, dtype: str = "<f4") -> DataFrame:
    """The same for blocks: whole planes (a block for each) of the new size."""
    keys = tiles.plane_key(blocks)

    def resize(row):
        values = bilinear_matrix(row["size_y"], to_height) @ tiles.values_of(row).astype(float) @ bilinear_matrix(row["size_x"], to_width).T
        yield {k: row[k] for k in keys} | {"y": 0, "x": 0, "height": to_height, "width": to_width, "size_y": to_height, "size_x": to_width, "dtype": dtype, "data": values.astype(dtype).tobytes()}

    return tiles.each(tiles.retiled(blocks, None), resize, tiles.declared(blocks, keys, tiles.OWN))


def tiled(points: DataFrame, tile: int, halo: int, height: int, width: int) -> DataFrame:
    """Each place once for every tile whose halo holds it, and whether it lies in the tile's core."""
    def near(v: Column, n: int) -> Column:
        last = (n - 1) // tile
        return F.sequence(F.greatest(F.lit(0), F.floor((v - halo) / tile)), F.least(F.lit(last), F.floor((v + halo) / tile)))

    rows = points.withColumn("tile_y", F.explode(near(F.col("y"), height))).withColumn("tile_x", F.explode(near(F.col("x"), width)))
    return rows.withColumn("core", (F.floor(F.col("y") / tile) == F.col("tile_y")) & (F.floor(F.col("x") / tile) == F.col("tile_x")))
