"""Directed relationships between objects of two label sets that share voxels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.raster import VOXEL

PAIR = ["image_id", "t", "source_set", "source_label", "target_set", "target_label"]


def overlaps(labels: DataFrame) -> DataFrame:
    """Shared voxels of each pair of objects, the lower label set first. Labels are ordered by voxel once, and each meets those that
    come after it at its voxel; a voxel has one label of each set at most, so it makes at most a row for each pair of sets."""
    after = Window.partitionBy(*VOXEL).orderBy("set_index", "label").rowsBetween(1, Window.unboundedFollowing)
    one = F.struct("set_index", "label")
    met = labels.select("image_id", "t", one.alias("a"), F.collect_list(one).over(after).alias("later"))
    rows = met.select("image_id", "t", "a", F.explode("later").alias("b"))
    sides = [F.col(f"{k}.{c}").alias(f"{s}_{n}") for k, s in (("a", "source"), ("b", "target")) for c, n in (("set_index", "set"), ("label", "label"))]
    return rows.select("image_id", "t", *sides).groupBy(*PAIR).agg(F.count("*").alias("overlap_voxels"))


def relationships(labels: DataFrame, objects: DataFrame) -> DataFrame:
    """Both directions of each overlap with fractions, relation, whether it is the source's largest in the target's set
    (ties are all primary), whether the source's centroid lies in the target, and the distance of centroids.

    The overlap is an area if both objects are flat, else a volume. The distance takes z into account; without a scale of z it
    is given only if both centroids have the same z. An object_id of the objects, if there is one, is carried along."""
    extra = [c for c in ("object_id",) if c in objects.columns]
    ways = F.explode(F.array(*(F.struct(*(F.col(f"{x}_{c}").alias(f"{s}_{c}") for s, x in zip(("source", "target"), way, strict=True) for c in ("set", "label"))) for way in (("source", "target"), ("target", "source")))))
    directed = overlaps(labels).select("image_id", "t", "overlap_voxels", ways.alias("w")).select("image_id", "t", "w.*", "overlap_voxels")
    side = lambda s: objects.select("image_id", "t", F.col("set_index").alias(f"{s}_set"), F.col("label").alias(f"{s}_label"), *(F.col(c).alias(f"{s}_{c}") for c in (*extra, "voxel_count", "spatial_dimensions", "centroid_z_px", "centroid_y_px", "centroid_x_px", "centroid_z_um", "centroid_y_um", "centroid_x_um", "pixel_um2", "voxel_um3"))).hint("merge")
    both = directed.join(side("source"), ["image_id", "t", "source_set", "source_label"]).join(side("target"), ["image_id", "t", "target_set", "target_label"])
    n, whole_s, whole_t = F.col("overlap_voxels"), F.col("source_voxel_count"), F.col("target_voxel_count")
    best = F.max("overlap_voxels").over(Window.partitionBy("image_id", "t", "source_set", "source_label", "target_set"))
    at = [F.rint(f"source_centroid_{c}_px").cast("long").alias(c) for c in "zyx"]
    hit = labels.select(*VOXEL, F.col("set_index").alias("target_set"), F.col("label").alias("target_label"), F.lit(True).alias("hit")).hint("merge")
    near = both.select("*", *at).join(hit, [*VOXEL, "target_set", "target_label"], "left")
    flat = (F.col("source_spatial_dimensions") == 2) & (F.col("target_spatial_dimensions") == 2)
    away = lambda c: F.pow(F.col(f"source_centroid_{c}_um") - F.col(f"target_centroid_{c}_um"), 2)
    return near.select(
        *PAIR,
        *(f"{s}_{c}" for s in ("source", "target") for c in extra),
        F.when((n == whole_s) & (n == whole_t), "identical_extent").when(n == whole_s, "inside").when(n == whole_t, "contains").otherwise("overlaps").alias("relation"),
        "overlap_voxels",
        F.when(flat, n * F.col("source_pixel_um2")).alias("overlap_um2"),
        F.when(~flat, n * F.col("source_voxel_um3")).alias("overlap_um3"),
        (n / whole_s).alias("source_overlap_fraction"),
        (n / whole_t).alias("target_overlap_fraction"),
        F.coalesce("hit", F.lit(False)).alias("source_centroid_in_target"),
        F.sqrt(F.when(F.col("source_centroid_z_px") == F.col("target_centroid_z_px"), 0.0).otherwise(away("z")) + away("y") + away("x")).alias("centroid_distance_um"),
        (n == best).alias("is_primary_for_source"),
    )
