"""Objects from sparse labels: counts, centroids, boxes, sizes, moments, and shape from neighbourhoods."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import usable_scale
from ..sources.raster import OBJECT


AXES = "zyx"


def objects(labels: DataFrame, images: DataFrame) -> DataFrame:
    """One aggregation by object: size, centroid, half-open box and second moments, in pixels and, where scales are usable, in micrometres.

    Objects of one plane are 2D: an area and no volume; others are 3D. The voxels combine before the one shuffle."""
    known = [c for c in AXES if f"scale_{c}" in images.columns]
    scales = images.select("image_id", *((usable_scale(f"scale_{c}") if c in known else F.lit(None).cast("double")).alias(f"s{c}") for c in AXES))
    pairs = [(a, b) for i, a in enumerate(AXES) for b in AXES[i:]]
    sums = labels.groupBy(*OBJECT).agg(
        F.count("*").alias("voxel_count"),
        *(F.avg(c).alias(f"centroid_{c}_px") for c in AXES),
        *(F.min(c).alias(f"bbox_min_{c}_px") for c in AXES),
        *((F.max(c) + 1).alias(f"bbox_max_{c}_px") for c in AXES),
        # without the last digits' noise, so that equal axes are equal
        *((F.round(F.covar_pop(a, b), 9) + 0.0).alias(f"cov_{a}{b}") for a, b in pairs),
    )
    flat = F.col("bbox_max_z_px") - F.col("bbox_min_z_px") == 1
    size = F.col("voxel_count").cast("double")
    out = sums.join(scales.hint("merge"), "image_id")
    return out.select(
        *sums.columns,
        F.when(flat, 2).otherwise(3).alias("spatial_dimensions"),
        F.when(flat, size).alias("area_px2"),
        F.when(flat, size * F.col("sy") * F.col("sx")).alias("area_um2"),
        F.when(~flat, size).alias("volume_voxels"),
        F.when(~flat, size * F.col("sz") * F.col("sy") * F.col("sx")).alias("volume_um3"),
        *((F.col(f"centroid_{c}_px") * F.col(f"s{c}")).alias(f"centroid_{c}_um") for c in AXES),
        *((F.col(f"bbox_{m}_{c}_px") * F.col(f"s{c}")).alias(f"bbox_{m}_{c}_um") for m in ("min", "max") for c in AXES),
        ((F.col("sy") + F.col("sx")) / 2).alias("mean_scale"),
        (F.col("sy") * F.col("sx")).alias("pixel_um2"),
        (F.col("sz") * F.col("sy") * F.col("sx")).alias("voxel_um3"),
        *(f"s{c}" for c in AXES),
    )


def with_spans(table: DataFrame, name: str, scaled: bool) -> DataFrame:
    """The table with <name>_long and <name>_short, from the roots of the coordinates' covariance in space (closed form of a
    symmetric matrix), of the scaled coordinates if asked. One step a column, as each is read by several others."""
    c = lambda k: F.col(f"{name}_{k}")
    # greatest() passes over nulls
    root = lambda v: F.when(v.isNotNull(), F.sqrt(F.greatest(10 * v, F.lit(0.0))))
    pairs = ["zz", "yy", "xx", "zy", "zx", "yx"]
    steps = [
        {k: F.col(f"cov_{k}") * (F.col(f"s{k[0]}") * F.col(f"s{k[1]}") if scaled else 1.0) for k in pairs},
        {"q": (c("zz") + c("yy") + c("xx")) / 3},
        {k[0]: c(k) - c("q") for k in ("zz", "yy", "xx")},
        {"wide": F.sqrt((c("z") * c("z") + c("y") * c("y") + c("x") * c("x") + 2 * (c("zy") * c("zy") + c("zx") * c("zx") + c("yx") * c("yx"))) / 6)},
        {"det": c("z") * (c("y") * c("x") - c("yx") * c("yx")) - c("zy") * (c("zy") * c("x") - c("yx") * c("zx")) + c("zx") * (c("zy") * c("yx") - c("y") * c("zx"))},
        {"turn": F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.coalesce(c("det") / F.nullif(2 * c("wide") * c("wide") * c("wide"), F.lit(0.0)), F.lit(0.0))))) / 3},
        {"big": c("q") + 2 * c("wide") * F.cos(c("turn")), "small": c("q") + 2 * c("wide") * F.cos(c("turn") + 2 * math.pi / 3)},
        {"middle": 3 * c("q") - c("big") - c("small")},
        {"long": root(c("big") + c("middle") - c("small")), "short": root(c("small") + c("middle") - c("big"))},
    ]
    out = table
    for step in steps:
        out = out.withColumns({f"{name}_{k}": v for k, v in step.items()})
    return out.drop(*(f"{name}_{k}" for step in steps[:-1] for k in step))


def moment_shape(table: DataFrame) -> DataFrame:
    """Closed forms of the moments: diameter of the equal circle or ball, axes of the equal ellipse or ellipsoid, extent and
    aspect ratio; of flat objects eccentricity and orientation too. Lengths of flat objects scale by the mean of y and x, those
    of volumes are taken of the scaled coordinates."""
    flat = F.col("spatial_dimensions") == 2
    half = (F.col("cov_yy") + F.col("cov_xx")) / 2
    root = F.sqrt(F.pow((F.col("cov_yy") - F.col("cov_xx")) / 2, 2) + F.pow("cov_yx", 2))
    big, small = half + root, F.greatest(half - root, F.lit(0.0))
    # from the row axis to the major axis
    tilt, apart = F.col("cov_yx"), F.col("cov_yy") - F.col("cov_xx")
    angle = F.when(apart == 0, F.when(tilt > 0, math.pi / 4).otherwise(-math.pi / 4)).otherwise(0.5 * F.atan2(2 * tilt, apart))
    sides = [F.col(f"bbox_max_{c}_px") - F.col(f"bbox_min_{c}_px") for c in AXES]
    ball = lambda v: F.cbrt(6 * v / math.pi)
    table = with_spans(with_spans(table, "px", False), "um", True)
    out = table.withColumns({"major_axis_length_px": F.when(flat, 4 * F.sqrt(big)).otherwise(F.col("px_long")), "minor_axis_length_px": F.when(flat, 4 * F.sqrt(small)).otherwise(F.col("px_short"))})
    return out.withColumns(
        {
            "equivalent_diameter_px": F.when(flat, F.sqrt(4 * F.col("area_px2") / math.pi)).otherwise(ball(F.col("volume_voxels"))),
            "equivalent_diameter_um": F.when(flat, F.sqrt(4 * F.col("area_px2") / math.pi) * F.col("mean_scale")).otherwise(ball(F.col("volume_um3"))),
            "major_axis_length_um": F.when(flat, F.col("major_axis_length_px") * F.col("mean_scale")).otherwise(F.col("um_long")),
            "minor_axis_length_um": F.when(flat, F.col("minor_axis_length_px") * F.col("mean_scale")).otherwise(F.col("um_short")),
            "eccentricity": F.when(flat, F.when(big == 0, F.lit(0.0)).otherwise(F.sqrt(1 - small / F.nullif(big, F.lit(0.0))))),
            "orientation_degrees": F.when(flat, F.degrees(angle)),
            "extent": F.col("voxel_count") / (sides[0] * sides[1] * sides[2]),
            "aspect_ratio": F.col("major_axis_length_px") / F.nullif("minor_axis_length_px", F.lit(0.0)),
        }
    ).drop("px_long", "px_short", "um_long", "um_short")


def _spread(labels: DataFrame, steps: list[tuple[int, int, int]]) -> DataFrame:
    """Each voxel once for every step (dy, dx, code), at the place it steps to."""
    moves = F.explode(F.array(*(F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx"), F.lit(w).alias("w")) for dy, dx, w in steps)))
    return labels.select(*OBJECT, "z", "y", "x", moves.alias("m")).select(*OBJECT, "z", (F.col("y") + F.col("m.dy")).alias("y"), (F.col("x") + F.col("m.dx")).alias("x"), F.col("m.w").alias("w"))


def _count(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def quads(labels: DataFrame) -> DataFrame:
    """From the codes of all 2 by 2 windows: Euler number (8-connected) and Crofton perimeter over four directions.

    Rows are dealt by place, after neighbours' codes combine, so an object of any size spreads over all tasks; what is then
    summed by object is one row for each object and task."""
    codes = _spread(labels, [(0, 0, 1), (0, 1, 4), (1, 0, 2), (1, 1, 8)]).groupBy(*OBJECT, "y", "x").agg(F.sum("w").alias("code"))
    ones, threes, cross = F.col("code").isin(1, 2, 4, 8), F.col("code").isin(7, 11, 13, 14), F.col("code").isin(6, 9)
    quarter, root = math.pi / 4, math.sqrt(2)
    # Weights of the window codes.
    weight = {1: quarter * (1 + 1 / root), 2: quarter / root, 3: quarter * root, 5: quarter * (1 + 1 / root), 7: quarter / root, 8: quarter, 9: 2 * quarter, 10: quarter / root, 11: quarter / root, 12: quarter, 13: 2 * quarter}
    crofton = sum((F.lit(w) * _count(F.col("code") == k) for k, w in weight.items()), F.lit(0.0))
    return codes.groupBy(*OBJECT).agg(((_count(ones) - _count(threes) - 2 * _count(cross)) / 4).cast("int").alias("euler_number"), crofton.alias("perimeter_crofton_px"))


def perimeters(labels: DataFrame) -> DataFrame:
    """Length of the border (voxels with a face neighbour outside) by weights of its own 3 by 3 neighbourhoods."""
    faces = [(0, 1), (0, -1), (1, 0), (-1, 0)]
    corners = [(1, 1), (1, -1), (-1, 1), (-1, -1)]
    near = _spread(labels, [(0, 0, 100), *((dy, dx, 1) for dy, dx in faces)])
    border = near.groupBy(*OBJECT, "z", "y", "x").agg(F.sum("w").alias("n")).filter(F.col("n").between(100, 103))
    codes = _spread(border, [(0, 0, 1), *((dy, dx, 2) for dy, dx in faces), *((dy, dx, 10) for dy, dx in corners)]).groupBy(*OBJECT, "y", "x").agg(F.sum("w").alias("code"))
    weight = F.when(F.col("code").isin(5, 7, 15, 17, 25, 27), 1.0).when(F.col("code").isin(21, 33), math.sqrt(2)).when(F.col("code").isin(13, 23), (1 + math.sqrt(2)) / 2).otherwise(0.0)
    return codes.groupBy(*OBJECT).agg(F.sum(weight).alias("perimeter_px"))


def relational_shape(labels: DataFrame, images: DataFrame) -> DataFrame:
    """All shape features that need no geometry beyond neighbourhoods; those of planes are null for volumes."""
    table = moment_shape(objects(labels, images)).join(quads(labels).hint("merge"), OBJECT, "left").join(perimeters(labels).hint("merge"), OBJECT, "left")
    flat = lambda c: F.when(F.col("spatial_dimensions") == 2, c)
    return table.withColumns(
        {
            "circularity": flat(4 * math.pi * F.col("area_px2") / F.nullif(F.pow("perimeter_px", 2), F.lit(0.0))),
            "perimeter_um": flat(F.col("perimeter_px") * F.col("mean_scale")),
            "perimeter_crofton_um": flat(F.col("perimeter_crofton_px") * F.col("mean_scale")),
            **{c: flat(F.col(c)) for c in ("perimeter_px", "perimeter_crofton_px", "euler_number")},
        }
    )


#: What of the features needs more than an object's moments.
BEYOND_MOMENTS = ("perimeter", "circularity", "euler", "convex", "filled", "feret", "solidity", "surface", "sphericity")


def full_shape(labels: DataFrame, images: DataFrame, moments_only: bool = False) -> DataFrame:
    """All features of all objects: those of relational_shape, and hulls, holes, diameters and surfaces; or only those that one
    aggregation gives."""
    from . import geometry

    if moments_only:
        return moment_shape(objects(labels, images))
    table = relational_shape(labels, images).join(geometry.shapes(labels).hint("merge"), OBJECT, "left")
    scales = images.select("image_id", *((usable_scale(f"scale_{c}") if f"scale_{c}" in images.columns else F.lit(None).cast("double")).alias(f"s{c}") for c in AXES))
    surfaces = geometry.surfaces(labels, scales).select(*OBJECT, "surface_area_um2")
    table = table.join(surfaces.hint("merge"), OBJECT, "left")
    flat = F.col("spatial_dimensions") == 2
    in_plane, in_space = (lambda c: F.when(flat, F.col(c))), (lambda c: F.when(~flat, F.col(c)))
    out = {}
    for kind in ("convex", "filled"):
        out |= {f"{kind}_area_px2": in_plane(f"{kind}_size"), f"{kind}_area_um2": in_plane(f"{kind}_size") * F.col("pixel_um2")}
        out |= {f"{kind}_volume_voxels": in_space(f"{kind}_size"), f"{kind}_volume_um3": in_space(f"{kind}_size") * F.col("voxel_um3")}
    surface = F.when(~flat, F.col("surface_area_um2"))
    out |= {
        "feret_diameter_max_um": F.col("feret_diameter_max_px") * F.col("mean_scale"),
        "solidity": F.col("voxel_count") / F.col("convex_size"),
        "euler_number": F.coalesce("euler_number", "euler_number_3d"),
        "surface_area_um2": surface,
        "sphericity": math.pi ** (1 / 3) * F.pow(6 * F.col("volume_um3"), 2 / 3) / F.nullif(surface, F.lit(0.0)),
    }
    return table.withColumns(out)


def label_statistics(labels: DataFrame, voxels_per_image: int, images: DataFrame | None = None, sets: list[int] | None = None) -> DataFrame:
    """By image, timepoint and label set: labels, foreground, and their sizes; 0 where there is nothing to average. With images
    (and their scales) and sets, an image without labels of a set has a row too, and sizes and diameters of equal circles, or
    balls if the image's labels lie in several planes, are given in micrometres where the scales are usable."""
    group = ["image_id", "t", "set_index"]
    sizes = labels.groupBy(*OBJECT).agg(F.count("*").alias("n"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    out = sizes.groupBy(*group).agg(
        F.count("*").alias("label_count"),
        F.sum("n").alias("foreground_voxels"),
        (F.sum("n") * 100.0 / voxels_per_image).cast("double").alias("foreground_percent"),
        zero(F.avg("n")).alias("mean_size"),
        zero(F.percentile("n", F.lit(0.5))).alias("median_size"),
        F.min("n").alias("min_size"),
        F.max("n").alias("max_size"),
        zero(F.percentile(F.sqrt(4 * F.col("n") / math.pi), F.lit(0.5))).alias("median_equivalent_diameter"),
    )
    if images is None:
        return out
    scales = images.select("image_id", *((usable_scale(f"scale_{c}") if f"scale_{c}" in images.columns else F.lit(None).cast("double")).alias(f"s{c}") for c in AXES))
    wanted = scales.select("*", F.lit(0).alias("t"), F.explode(F.array(*map(F.lit, sets or []))).alias("set_index"))
    present = labels.select("image_id", "t").distinct().join(scales.hint("merge"), "image_id").select("image_id", "sz", "sy", "sx", "t", F.explode(F.array(*map(F.lit, sets or []))).alias("set_index"))
    deep = labels.groupBy("image_id").agg((F.max("z") > F.min("z")).alias("deep"))
    whole = wanted.unionByName(present).distinct().join(out.hint("merge"), group, "left").join(deep.hint("merge"), "image_id", "left")
    unit = F.when(F.coalesce("deep", F.lit(False)), F.col("sz") * F.col("sy") * F.col("sx")).otherwise(F.col("sy") * F.col("sx"))
    median = F.col("median_size") * F.col("unit")
    counted = [c for c in out.columns if c not in group]
    filled = whole.select(*group, "deep", *(F.coalesce(c, F.lit(0).cast(dict(out.dtypes)[c])).alias(c) for c in counted), unit.alias("unit"))
    diameter = F.when(F.coalesce("deep", F.lit(False)), F.cbrt(6 * median / math.pi)).otherwise(F.sqrt(4 * median / math.pi))
    return filled.select(*group, *counted, (F.col("mean_size") * F.col("unit")).alias("mean_size_um"), median.alias("median_size_um"), diameter.alias("median_equivalent_diameter_um"))


def object_counts(labels: DataFrame) -> DataFrame:
    """By image: labels over all sets, those that sets share counted once, and the largest label."""
    return labels.groupBy("image_id").agg(F.countDistinct("label").alias("distinct_labels"), F.max("label").alias("max_label"))
