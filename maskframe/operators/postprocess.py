"""Label post-processing: borders, matching of nuclei to cells, cytoplasm, expansion, and offsets of ids."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.raster import VOXEL
from ..sources.workspace import written

PLACE = ["image_id", "t"]


def of_set(labels: DataFrame, index: int) -> DataFrame:
    return labels.filter(F.col("set_index") == index).select(*VOXEL, "label")


def border_labels(labels: DataFrame, height: int, width: int) -> DataFrame:
    """Labels that touch the first or last row or column of any plane."""
    return labels.filter(F.col("y").isin(0, height - 1) | F.col("x").isin(0, width - 1)).select(*PLACE, "set_index", "label").distinct()


def without_border(labels: DataFrame, height: int, width: int) -> DataFrame:
    return labels.join(border_labels(labels, height, width).hint("merge"), [*PLACE, "set_index", "label"], "left_anti")


def met(labels: DataFrame) -> DataFrame:
    """Each voxel's cell (set 1) and nucleus (set 2), null where there is none; one aggregation, as a voxel has one label of each set at most."""
    own = lambda k: F.max(F.when(F.col("set_index") == k, F.col("label")))
    return labels.filter(F.col("set_index").isin(1, 2)).groupBy(*VOXEL).agg(own(1).alias("cell"), own(2).alias("nucleus"))


def pairings(voxels: DataFrame, first_id: int = 1) -> DataFrame:
    """matches() of what met() gives. A nucleus' counts by cell, and by none, say its home and its size at once, so nothing is joined."""
    counts = voxels.filter("nucleus is not null").groupBy(*PLACE, "nucleus", "cell").agg(F.count("*").alias("n"))
    homes = counts.groupBy(*PLACE, "nucleus").agg(F.max_by("cell", F.when(F.col("cell").isNotNull(), F.struct("n", -F.col("cell")))).alias("cell"), F.sum("n").alias("size"))
    chosen = homes.filter("cell is not null").groupBy(*PLACE, "cell").agg(F.max_by("nucleus", F.struct("size", -F.col("nucleus"))).alias("nucleus"))
    return chosen.withColumn("new_id", F.dense_rank().over(Window.partitionBy(*PLACE).orderBy("cell")) + F.lit(first_id - 1))


def matches(cells: DataFrame, nuclei: DataFrame, first_id: int = 1) -> DataFrame:
    """(image_id, t, cell, nucleus, new_id): each nucleus goes to the cell it overlaps most (ties: lowest cell), each cell
    keeps its largest nucleus by full size (ties: lowest nucleus), and matched cells are numbered densely by id."""
    return pairings(met(cells.withColumn("set_index", F.lit(1)).unionByName(nuclei.withColumn("set_index", F.lit(2)))), first_id)


def matched_labels(labels: DataFrame, first_id: int = 1) -> DataFrame:
    """Cells, nuclei and cytoplasm (sets 1, 2, 3) that share ids. A retained nucleus keeps its voxels outside its cell;
    cytoplasm is a matched cell's voxels that no retained nucleus covers."""
    voxels = met(labels)
    found = pairings(voxels, first_id)
    ids = lambda c: found.select(*PLACE, c, F.col("new_id").cast("long").alias(f"new_{c}")).hint("merge")
    new = voxels.join(ids("cell"), [*PLACE, "cell"], "left").join(ids("nucleus"), [*PLACE, "nucleus"], "left")
    cell, nucleus = F.col("new_cell"), F.col("new_nucleus")
    parts = F.explode(F.array(*(F.struct(F.lit(k).alias("set_index"), v.alias("label")) for k, v in ((1, cell), (2, nucleus), (3, F.when(nucleus.isNull(), cell))))))
    return new.select(*VOXEL, parts.alias("p")).select(*VOXEL, "p.label", "p.set_index").filter("label is not null")


def expanded(seeds: DataFrame, distance: float, scale_y: float | None, scale_x: float | None, height: int, width: int) -> DataFrame:
    """Each position within the distance of a seed voxel, with the label (under 2**40) of the nearest (ties: lowest label).

    The nearest voxel lies on a seed's border, or is the place itself, so only border voxels spread; and they do so one axis at a
    time: in its row each place takes, for each number of steps to the side, the lowest label, then hands those on along its column.
    A row is spread over 2 r + 1 places twice, not over the (2 r + 1) ** 2 of a disk, and both spreads combine before they are
    shuffled. No range join."""
    sy = scale_y or scale_x or 1.0
    sx = scale_x or scale_y or 1.0
    ry, rx = math.floor(distance / sy), math.floor(distance / sx)
    # a squared distance by its rank above the label makes one number, whose minimum combines in a hash aggregation
    reach = {(dy, dx): (dy * sy) ** 2 + (dx * sx) ** 2 for dy in range(ry + 1) for dx in range(rx + 1)}
    rank = {d: i for i, d in enumerate(sorted({d for d in reach.values() if d <= distance**2}))}
    inner = seeds.select(*VOXEL, "label")
    faces = F.explode(F.array(*(F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in ((0, 0), (0, 1), (0, -1), (1, 0), (-1, 0)))))
    near = inner.select(*VOXEL, "label", faces.alias("f")).select("image_id", "t", "z", (F.col("y") + F.col("f.dy")).alias("y"), (F.col("x") + F.col("f.dx")).alias("x"), "label", (F.expr("f.dy = 0 and f.dx = 0")).cast("int").alias("own"))
    edge = near.groupBy(*VOXEL, "label").agg(F.count("*").alias("n"), F.max("own").alias("own")).filter("own = 1 and n < 5").select(*VOXEL, "label")
    sides = F.explode(F.sequence(F.greatest(F.lit(0), F.col("x") - rx), F.least(F.lit(width - 1), F.col("x") + rx)))
    rows = edge.select("image_id", "t", "z", "y", F.col("x").alias("from"), "label", sides.alias("x")).groupBy(*VOXEL, F.abs(F.col("x") - F.col("from")).alias("dx")).agg(F.min("label").alias("label"))
    # the rank of each pair of steps, by place in an array; null beyond the distance
    table = F.array(*(F.lit(rank.get(reach[dy, dx])).cast("long") for dy in range(ry + 1) for dx in range(rx + 1)))
    ups = F.explode(F.sequence(F.greatest(F.lit(0), F.col("y") - ry), F.least(F.lit(height - 1), F.col("y") + ry)))
    spread = rows.select("image_id", "t", "z", F.col("y").alias("from"), "x", "dx", "label", ups.alias("y"))
    at = F.element_at(table, (F.abs(F.col("y") - F.col("from")) * (rx + 1) + F.col("dx") + 1).cast("int"))
    grown = spread.select(*VOXEL, (F.shiftleft(at, 40) + F.col("label")).alias("m")).filter("m is not null")
    whole = grown.unionByName(inner.select(*VOXEL, F.col("label").alias("m")))
    return whole.groupBy(*VOXEL).agg(F.min("m").alias("m")).select(*VOXEL, F.expr(f"m & {(1 << 40) - 1}").alias("label"))


#: Images whose sums one task orders.
RANGE = 4096


def running_sums(rows: DataFrame, within: list[str], order: list[str], value: str) -> DataFrame:
    """The rows with `before`, the sum of `value` over all earlier rows of their group. The first column of `order`, an integer,
    is cut into ranges of RANGE: a task orders the rows of one range, and one row for each range is what is summed across them."""
    ranged = rows.withColumn("range", F.floor(F.col(order[0]) / RANGE))
    totals = ranged.groupBy(*within, "range").agg(F.sum(value).alias("total"))
    earlier = Window.partitionBy(*within).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*within, "range", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy(*within, "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return ranged.withColumn("sum", F.coalesce(F.sum(value).over(inside), F.lit(0))).join(starts.hint("merge"), [*within, "range"]).withColumn("before", F.col("start") + F.col("sum")).drop("range", "sum", "start")


def offset_ids(labels: DataFrame, within: list[str], slab: list[str]) -> DataFrame:
    """Ids made unique over slabs: a positive label grows by the largest ids of all slabs before it in its group.

    The running sum is over one row for each slab, which is written, so the labels are made for it once; the voxels only join it."""
    tops = written(labels.groupBy(*within, *slab).agg(F.max("label").alias("top")))
    offsets = running_sums(tops, within, slab, "top").select(*within, *slab, F.col("before").alias("offset"))
    return labels.join(offsets.hint("merge"), [*within, *slab]).withColumn("label", F.col("label") + F.col("offset")).drop("offset")


def same_shape(first: tuple[int, ...], second: tuple[int, ...]) -> None:
    """ValueError if two label images that are to be matched differ in shape."""
    if tuple(first) != tuple(second):
        raise ValueError(f"cells of shape {tuple(first)} can't be matched with nuclei of shape {tuple(second)}")


PLANE = ["image_id", "t", "z"]
#: Neighbours that a point tries, in order, when its place is taken.
TRIES = [(0, 0), (-1, 0), (1, 0), (0, -1), (0, 1)]


def points_to_labels(points: DataFrame, height: int, width: int) -> DataFrame:
    """Points (image_id, t, z, point, py, px) as one-voxel labels, numbered from 1 in their order in a plane, by rounding half to
    even and clamping. A point whose place an earlier one has takes the first of its free neighbours, or none.

    Only points that can meet depend on each other: those with a place of their own, and no other point within two steps, are
    placed in the JVM; the others are settled in their order, plane by plane."""
    columns = {c: F.lit(0).cast(k) for c, k in (("t", "int"), ("z", "long")) if c not in points.columns}
    clamp = lambda c, n: F.least(F.greatest(F.rint(c), F.lit(0.0)), F.lit(float(n - 1))).cast("long")
    rounded = points.withColumns(columns).select(*PLANE, "point", clamp("py", height).alias("y"), clamp("px", width).alias("x"))
    numbered = rounded.withColumn("label", F.row_number().over(Window.partitionBy(*PLANE).orderBy("point")).cast("long")).drop("point")
    around = F.explode(F.array(*(F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy in range(-2, 3) for dx in range(-2, 3) if abs(dy) + abs(dx) <= 2)))
    reach = numbered.select(*PLANE, (F.col("y") + F.lit(0)).alias("y0"), F.col("x").alias("x0"), around.alias("a")).select(*PLANE, (F.col("y0") + F.col("a.dy")).alias("y"), (F.col("x0") + F.col("a.dx")).alias("x"))
    crowd = reach.groupBy(*PLANE, "y", "x").agg(F.count("*").alias("n")).filter("n > 1").hint("merge")
    alone = numbered.join(crowd, [*PLANE, "y", "x"], "left_anti")
    crowded = numbered.join(crowd, [*PLANE, "y", "x"], "left_semi")
    schema = "image_id long, t int, z long, label long, y long, x long"

    def settle(key: tuple, plane: pd.DataFrame) -> pd.DataFrame:
        taken: dict[tuple[int, int], int] = {}
        for label, y, x in sorted(zip(plane["label"].tolist(), plane["y"].tolist(), plane["x"].tolist(), strict=True)):
            free = ((y + dy, x + dx) for dy, dx in TRIES if 0 <= y + dy < height and 0 <= x + dx < width and (y + dy, x + dx) not in taken)
            if (at := next(free, None)) is not None:
                taken[at] = label
        return pd.DataFrame([(*key, k, y, x) for (y, x), k in taken.items()], columns=[*PLANE, "label", "y", "x"])

    return alone.select(*PLANE, "label", "y", "x").unionByName(crowded.groupBy(*PLANE).applyInPandas(settle, schema))
