"""Spots grown from seeds by a local adaptive threshold, and connected components of a plane.

A seed's neighbourhood is a join of the seed's offsets with the smoothed pixels; its background, noise, peak and threshold are
aggregations over that join. What is left for Python is the component around the seed, one row for each candidate, and the
competition for places of candidates that meet.
"""

from __future__ import annotations

import math
from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.workspace import written
from . import graph, tiles
from .postprocess import PLANE
from .stencil import binomial_smooth

# The reach in micrometres, the share of the contrast, and the noise levels above background.
REACH_UM, CONTRAST_SHARE, NOISE_LEVELS = 1.0, 0.30, 3.0
# Fixed value: from a median absolute deviation to a standard deviation.
DEVIATION = 1.4826


def label_mask(mask: np.ndarray) -> np.ndarray:
    """8-connected components of a mask, labelled from 1 by their first place in reading order (row * width + column + 1); 0 elsewhere.

    Runs of a row are joined with those of the next that they touch; runs then take the least of their neighbours' labels and
    of what that label's run has, until nothing changes."""
    wide = np.zeros((mask.shape[0], mask.shape[1] + 2), np.int8)
    wide[:, 1:-1] = mask
    turn = np.diff(wide, axis=1)
    row, first = np.nonzero(turn == 1)
    last = np.nonzero(turn == -1)[1]  # exclusive; runs stand in the same order
    stride = mask.shape[1] + 2
    # of each run, those of the next row that begin no later than it ends and end no sooner than it begins
    low, high = np.searchsorted(row * stride + last, (row + 1) * stride + first, "left"), np.searchsorted(row * stride + first, (row + 1) * stride + last, "right")
    n = np.maximum(high - low, 0)
    a = np.repeat(np.arange(len(row)), n)
    b = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(n.cumsum() - n, n)
    root = np.arange(len(row))
    while True:
        least = np.minimum(root[a], root[b])
        now = root.copy()
        np.minimum.at(now, root[a], least)
        np.minimum.at(now, root[b], least)
        while (now[now] != now).any():
            now = now[now]
        now = now[root]
        if (now == root).all():
            break
        root = now
    out = np.zeros(mask.shape, np.int64)
    out[mask] = np.repeat((row * mask.shape[1] + first + 1)[root], last - first)
    return out


def components_of_blocks(blocks: DataFrame, tile: int = 1024) -> DataFrame:
    """8-connected components (plane's key, y, x, label) of what isn't 0 in planes of blocks, labelled by their first place in reading
    order, from 1. Tiles are labelled each by itself; pixels at their edges say which labels of two tiles are one component, and a
    graph of these labels, not the pixels, is what is joined across tiles."""
    keys = tiles.plane_key(blocks)

    def label(values: np.ndarray, row: dict) -> np.ndarray:
        own = label_mask(values != 0)
        y, x = np.divmod(own - 1, max(1, own.shape[1]))
        return np.where(own > 0, (y + row["y"]) * row["size_x"] + x + row["x"] + 1, 0)

    cut = tiles.mapped(tiles.retiled(blocks, tile).drop(*tiles.CORE), label)

    def edges(row):
        """A block's edge pixels at their own places, and at those of their neighbours outside the block."""
        block, (height, width) = tiles.values_of(row), (row["height"], row["width"])
        for y, x in np.argwhere(block):
            if (y in (0, height - 1) and row["height"] < row["size_y"]) or (x in (0, width - 1) and row["width"] < row["size_x"]):
                for v in (-1, 0, 1):
                    for u in (-1, 0, 1):
                        inside = 0 <= y + v < height and 0 <= x + u < width
                        if not (inside and (v or u)):
                            yield {k: row[k] for k in keys} | {"y": row["y"] + int(y) + v, "x": row["x"] + int(x) + u, "own": inside, "label": int(block[y, x])}

    # of a block only its frame is looked at
    def frame(values: np.ndarray, row: dict) -> np.ndarray:
        out = np.zeros_like(values)
        for part in (np.s_[0], np.s_[-1], np.s_[:, 0], np.s_[:, -1]):
            out[part] = values[part]
        return out

    several = cut.filter("height < size_y or width < size_x")
    ends = tiles.each(tiles.mapped(several, frame), edges, tiles.declared(blocks, keys, {"y": "long", "x": "long", "own": "boolean", "label": "long"}))
    met = ends.groupBy(*keys, "y", "x").agg(F.max(F.when(F.col("own"), F.col("label"))).alias("a"), F.collect_set(F.when(~F.col("own"), F.col("label"))).alias("others"))
    links = met.filter("a is not null").select(*keys, "a", F.explode("others").alias("b"))
    roots = graph.components(links, keys).withColumnRenamed("id", "label")
    return tiles.to_pixels(cut, "label", "long", sparse=True).join(roots.hint("merge"), [*keys, "label"], "left").select(*keys, "y", "x", F.coalesce("root", "label").alias("label"))


def components(pixels: DataFrame, height: int, width: int, tile: int = 1024) -> DataFrame:
    """components_of_blocks() of positions (plane's key, y, x)."""
    ones = pixels.withColumn("value", F.lit(1))
    return components_of_blocks(tiles.to_blocks(ones, height, width, tile, dtype="|u1"), tile)


def joined_to_seed(places: set[tuple[int, int]]) -> list[tuple[int, int]]:
    """Those offsets that steps to any of eight neighbours join to (0, 0), which is one of them if it is there at all."""
    if (0, 0) not in places:
        return []
    found, open_ends = {(0, 0)}, deque([(0, 0)])
    while open_ends:
        y, x = open_ends.popleft()
        for near in ((y + dy, x + dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1)):
            if near in places and near not in found:
                found.add(near)
                open_ends.append(near)
    return sorted(found)


def candidates(smooth: DataFrame, points: DataFrame, ry: float, rx: float, height: int, width: int) -> DataFrame:
    """A row for each point (image_id, t, z, point, py, px): its rounded seed, the score (contrast over noise), the offsets
    of its mask and whether that is a mere fallback to the seed's own pixel.

    Within an ellipse of half axes ry and rx a pixel counts if it exceeds the background by NOISE_LEVELS deviations and by
    CONTRAST_SHARE of the peak's contrast. Background and noise are medians over the ring from the ellipse to one and a half
    times its size; where the image has no such pixels, over all outside the ellipse, and else over all of the patch."""
    oy, ox = (max(2, math.ceil(1.5 * r)) for r in (ry, rx))
    offsets = [(dy, dx, (dy / ry) ** 2 + (dx / rx) ** 2) for dy in range(-oy, oy + 1) for dx in range(-ox, ox + 1)]
    whole = lambda c, n: F.least(F.greatest(F.rint(c), F.lit(0.0)), F.lit(n - 1.0)).cast("long")
    seeds = points.select(*PLANE, "point", whole("py", height).alias("sy"), whole("px", width).alias("sx"))
    around = F.explode(F.array(*(F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx"), F.lit(d).alias("d")) for dy, dx, d in offsets)))
    places = seeds.select("*", around.alias("o")).select("*", (F.col("sy") + F.col("o.dy")).alias("y"), (F.col("sx") + F.col("o.dx")).alias("x"))
    seen = places.join(smooth.select(*PLANE, "y", "x", "value").hint("merge"), [*PLANE, "y", "x"])
    key = [*PLANE, "point", "sy", "sx"]
    rings = [F.col("o.d").between(1.0, 2.25), F.col("o.d") > 1, F.lit(True)]
    middle = lambda c: F.percentile(c, F.lit(0.5))
    ground = seen.groupBy(*key).agg(
        F.array(*(middle(F.when(r, F.col("value"))) for r in rings)).alias("grounds"),
        F.collect_list(F.struct(F.col("o.dy").alias("dy"), F.col("o.dx").alias("dx"), F.col("o.d").alias("d"), F.col("value").alias("v"))).alias("patch"),
    )
    level = ground.withColumn("ring", F.expr("if(grounds[0] is not null, 0, if(grounds[1] is not null, 1, 2))")).withColumn("ground", F.expr("grounds[ring]"))
    one = level.select(*key, "ring", "ground", "patch", F.explode("patch").alias("o"))
    in_ring = F.when(F.col("ring") == 0, F.col("o.d").between(1.0, 2.25)).when(F.col("ring") == 1, F.col("o.d") > 1).otherwise(True)
    told = one.groupBy(*key).agg(
        (DEVIATION * middle(F.when(in_ring, F.abs(F.col("o.v") - F.col("ground"))))).alias("noise"),
        F.greatest(F.lit(0.0), F.max(F.when((F.abs(F.col("o.dy")) <= 1) & (F.abs(F.col("o.dx")) <= 1), F.col("o.v") - F.col("ground")))).alias("contrast"),
        F.first("ground").alias("ground"),
        F.first("patch").alias("patch"),
    )
    least = F.col("ground") + F.greatest(NOISE_LEVELS * F.col("noise"), CONTRAST_SHARE * F.col("contrast"))
    bright = told.withColumn("least", least).withColumn("bright", F.expr("transform(filter(patch, o -> o.d <= 1 and o.v >= least), o -> struct(o.dy as dy, o.dx as dx))"))
    scored = bright.select(*key, (F.col("contrast") / F.greatest(F.col("noise"), F.lit(1e-6))).alias("score"), "bright")

    def work(batches):
        for b in batches:
            masks = [joined_to_seed({(o["dy"], o["dx"]) for o in offsets}) for offsets in b["bright"]]
            out = b.drop(columns="bright")
            out["fallback"] = [not m for m in masks]
            out["mask"] = [[list(o) for o in m or [(0, 0)]] for m in masks]
            yield out

    kinds = dict(scored.dtypes)
    return scored.mapInPandas(work, ", ".join(f"{c} {kinds[c]}" for c in (*key, "score")) + ", fallback boolean, mask array<array<int>>")


OUTCOME = {"point": "long", "score": "double", "fallback": "boolean", "removed": "long", "places": "array<array<long>>"}


def conflicts(found: DataFrame) -> DataFrame:
    """(plane's key, id, root): the candidates whose masks meet another's, by the least of those that they meet directly or not."""
    offset = F.explode("mask")
    places = found.select(*PLANE, "point", "sy", "sx", offset.alias("m")).select(*PLANE, "point", (F.col("sy") + F.col("m")[0]).alias("y"), (F.col("sx") + F.col("m")[1]).alias("x"))
    first = places.groupBy(*PLANE, "y", "x").agg(F.min("point").alias("a"), F.max("point").alias("last")).filter("a < last").drop("last").hint("merge")
    return graph.components(places.join(first, [*PLANE, "y", "x"]).select(*PLANE, "a", F.col("point").alias("b")), PLANE)


def settled(found: DataFrame) -> DataFrame:
    """What becomes of each candidate: the label it gets in its plane (null if its seed is taken or nothing is left for it), the
    places it takes and how many others had taken. Candidates choose in order of their scores, equal ones in order of points.

    Only candidates whose masks meet depend on each other: they settle group by group, and what meets no other keeps its mask. Labels
    then number a plane's successful candidates in order of their scores."""
    kinds = dict(found.dtypes)
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in PLANE), *(f"{n} {k}" for n, k in OUTCOME.items())])
    groups = conflicts(found).withColumnRenamed("id", "point").hint("merge")

    def contest(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        taken: set[tuple[int, int]] = set()
        rows = []
        for r in group.sort_values(["score", "point"], ascending=[False, True]).itertuples():
            wanted = [(int(r.sy + dy), int(r.sx + dx)) for dy, dx in r.mask]
            free = [] if (r.sy, r.sx) in taken else [p for p in wanted if p not in taken]
            taken.update(free)
            rows.append((*key[: len(PLANE)], r.point, r.score, r.fallback, len(wanted) - len(free) if free else 0, [list(p) for p in free]))
        return pd.DataFrame(rows, columns=[*PLANE, *OUTCOME])

    alone = found.join(groups, [*PLANE, "point"], "left_anti")
    places = F.transform("mask", lambda m: F.array(F.col("sy") + m[0], F.col("sx") + m[1]).cast("array<bigint>"))
    kept = alone.select(*PLANE, "point", "score", "fallback", F.lit(0).cast("long").alias("removed"), places.alias("places"))
    crowd = found.join(groups, [*PLANE, "point"]).groupBy(*PLANE, "root").applyInPandas(contest, schema)
    whole = kept.unionByName(crowd).withColumn("lost", F.size("places") == 0)
    order = Window.partitionBy(*PLANE, "lost").orderBy(F.desc("score"), "point")
    label = F.when(~F.col("lost"), F.row_number().over(order).cast("long"))
    return whole.withColumn("label", label).select(*PLANE, "point", "label", "fallback", "removed", "places")


def planes_of(df: DataFrame) -> DataFrame:
    """With a timepoint and a plane of 0 where the rows name none."""
    return df.withColumns({c: F.lit(0).cast(k) for c, k in (("t", "int"), ("z", "long")) if c not in df.columns})


def outcomes(pixels: DataFrame, points: DataFrame, scale_y: float, scale_x: float, height: int, width: int, native_3d: bool = False, finite: bool = False) -> DataFrame:
    """settled() for points over one channel's smoothed pixels; each plane is refined alone, so a model that finds points in
    whole volumes has no planes to refine and is an error."""
    if native_3d:
        raise ValueError("points of a volume can't be refined plane by plane")
    ry, rx = max(1.0, REACH_UM / scale_y), max(1.0, REACH_UM / scale_x)
    smooth = binomial_smooth(planes_of(pixels), height, width, finite=finite)
    # written, as groups of candidates that meet are told first, and candidates aren't to be made twice
    return settled(written(candidates(smooth, planes_of(points), ry, rx, height, width)))


def masks(found: DataFrame) -> DataFrame:
    """(image_id, t, z, y, x, label) of the outcomes, with ids that run over an image's planes. A plane's labels are dense, so a
    candidate's id is its place among the image's, in order of planes and labels."""
    order = Window.partitionBy("image_id", "t").orderBy("z", "label")
    kept = found.filter("label is not null").withColumn("label", F.row_number().over(order).cast("long"))
    return kept.select(*PLANE, "label", F.explode("places").alias("p")).select(*PLANE, F.col("p")[0].alias("y"), F.col("p")[1].alias("x"), "label")


def totals(found: DataFrame) -> DataFrame:
    """By image and timepoint what refinement did."""
    n = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    kept = F.col("label").isNotNull()
    return found.groupBy("image_id", "t").agg(
        F.count("*").alias("detected_points"),
        n(kept).alias("refined_masks"),
        n(kept & ~F.col("fallback") & (F.size("places") > 1)).alias("grown_masks"),
        n(kept & F.col("fallback")).alias("single_pixel_fallbacks"),
        n(~kept).alias("suppressed_duplicate_seeds"),
        F.coalesce(F.sum("removed"), F.lit(0)).alias("overlap_pixels_removed"),
    )


def refined(pixels: DataFrame, points: DataFrame, scale_y: float, scale_x: float, height: int, width: int, finite: bool = False) -> DataFrame:
    """Masks grown from points over one channel's pixels."""
    return masks(outcomes(pixels, points, scale_y, scale_x, height, width, finite=finite))
