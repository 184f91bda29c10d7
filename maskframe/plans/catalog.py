"""Every query by name, as a function of (spark, sf_dir), beside the SQL that its result must equal."""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import models
from ..functions import scalars as S
from ..operators import geometry, intensity, polygons, postprocess, regions, relationships, runs, spots, stencil, tiles
from ..sources import raster
from ..sources.raster import SIDE, table
from ..sources.workspace import folder
from ..sources.zarr import Files
from . import measurements
from .oracles import BASE, MATCH, OVERLAPS, sql, with_more

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six places, and no negative zero."""
    return df.select(*((F.round(c, 6) + 0.0).alias(c) if kind in ("double", "float") else F.col(c) for c, kind in df.dtypes))


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: rounded(f(spark, sf_dir))
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return raster.labels(spark, sf_dir), raster.images(spark, sf_dir)


# Regions and shape -------------------------------------------------------------------------------------------------------


@query(
    sql(
        "SELECT image_id, 0 AS t, set_index, label, n AS voxel_count, cy AS centroid_y_px, cx AS centroid_x_px, y0 AS bbox_min_y_px, x0 AS bbox_min_x_px, y1 AS bbox_max_y_px, x1 AS bbox_max_x_px, 2 AS spatial_dimensions, CAST(n AS DOUBLE) AS area_px2, n * sy * sx AS area_um2, CAST(NULL AS DOUBLE) AS volume_voxels, cy * sy AS centroid_y_um, cx * sx AS centroid_x_um, y0 * sy AS bbox_min_y_um, x1 * sx AS bbox_max_x_um FROM objs",
        *"centroid_y_px centroid_x_px area_um2 centroid_y_um centroid_x_um bbox_min_y_um bbox_max_x_um".split(),
    )
)
def region_objects(spark, sf_dir):
    return regions.objects(*inputs(spark, sf_dir)).select("image_id", "t", "set_index", "label", "voxel_count", "centroid_y_px", "centroid_x_px", "bbox_min_y_px", "bbox_min_x_px", "bbox_max_y_px", "bbox_max_x_px", "spatial_dimensions", "area_px2", "area_um2", "volume_voxels", "centroid_y_um", "centroid_x_um", "bbox_min_y_um", "bbox_max_x_um")


@query(
    sql(
        """SELECT image_id, set_index, label, big AS b, 4 * sqrt(big) AS major_axis_length_px, 4 * sqrt(small) AS minor_axis_length_px, 4 * sqrt(big) * (sy + sx) / 2 AS major_axis_length_um,
        sqrt(4 * n / pi()) AS equivalent_diameter_px, sqrt(4 * n / pi()) * (sy + sx) / 2 AS equivalent_diameter_um, CASE WHEN big = 0 THEN 0 ELSE sqrt(1 - small / big) END AS eccentricity,
        degrees(CASE WHEN vy = vx THEN CASE WHEN vyx > 0 THEN pi() / 4 ELSE -pi() / 4 END ELSE 0.5 * atan2(2 * vyx, vy - vx) END) AS orientation_degrees,
        CAST(n AS DOUBLE) / ((y1 - y0) * (x1 - x0)) AS extent, 4 * sqrt(big) / nullif(4 * sqrt(small), 0) AS aspect_ratio
        FROM (SELECT *, (vy + vx) / 2 + sqrt(power((vy - vx) / 2, 2) + power(vyx, 2)) AS big, greatest((vy + vx) / 2 - sqrt(power((vy - vx) / 2, 2) + power(vyx, 2)), 0) AS small FROM objs)""",
        *"b major_axis_length_px minor_axis_length_px major_axis_length_um equivalent_diameter_px equivalent_diameter_um eccentricity orientation_degrees extent aspect_ratio".split(),
    )
)
def moment_shape(spark, sf_dir):
    out = regions.moment_shape(regions.objects(*inputs(spark, sf_dir)))
    return out.select("image_id", "set_index", "label", F.pow(F.col("major_axis_length_px") / 4, 2).alias("b"), "major_axis_length_px", "minor_axis_length_px", "major_axis_length_um", "equivalent_diameter_px", "equivalent_diameter_um", "eccentricity", "orientation_degrees", "extent", "aspect_ratio")


CODES = """codes AS (SELECT image_id, set_index, label, y + dy AS y, x + dx AS x, sum(w) AS code FROM labels, (VALUES (0, 0, 1), (0, 1, 4), (1, 0, 2), (1, 1, 8)) m(dy, dx, w) GROUP BY ALL)"""


@query(
    sql(
        """SELECT image_id, set_index, label, CAST((count(*) FILTER (code IN (1, 2, 4, 8)) - count(*) FILTER (code IN (7, 11, 13, 14)) - 2 * count(*) FILTER (code IN (6, 9))) / 4 AS INTEGER) AS euler_number,
        CAST(sum(CASE WHEN code IN (1, 5) THEN pi() / 4 * (1 + 1 / sqrt(2)) WHEN code IN (2, 7, 10, 11) THEN pi() / (4 * sqrt(2)) WHEN code = 3 THEN pi() / (2 * sqrt(2)) WHEN code IN (8, 12) THEN pi() / 4 WHEN code IN (9, 13) THEN pi() / 2 ELSE 0 END) AS DOUBLE) AS perimeter_crofton_px
        FROM codes GROUP BY 1, 2, 3""",
        "perimeter_crofton_px",
        base=with_more(CODES),
    )
)
def euler_and_crofton(spark, sf_dir):
    return regions.quads(raster.labels(spark, sf_dir)).drop("t")


PERIMETER = """near AS (SELECT image_id, set_index, label, y + dy AS y, x + dx AS x, sum(w) AS k FROM labels, (VALUES (0, 0, 100), (0, 1, 1), (0, -1, 1), (1, 0, 1), (-1, 0, 1)) m(dy, dx, w) GROUP BY ALL),
border AS (SELECT * FROM near WHERE k BETWEEN 100 AND 103),
pcodes AS (SELECT image_id, set_index, label, y + dy AS y, x + dx AS x, sum(w) AS code FROM border, (VALUES (0, 0, 1), (0, 1, 2), (0, -1, 2), (1, 0, 2), (-1, 0, 2), (1, 1, 10), (1, -1, 10), (-1, 1, 10), (-1, -1, 10)) m(dy, dx, w) GROUP BY ALL),
per AS (SELECT image_id, set_index, label, sum(CASE WHEN code IN (5, 7, 15, 17, 25, 27) THEN 1 WHEN code IN (21, 33) THEN sqrt(2) WHEN code IN (13, 23) THEN (1 + sqrt(2)) / 2 ELSE 0 END) AS p FROM pcodes GROUP BY 1, 2, 3)"""


@query(sql("SELECT image_id, set_index, label, p AS perimeter_px, p * (sy + sx) / 2 AS perimeter_um, 4 * pi() * n / nullif(p * p, 0) AS circularity FROM objs JOIN per USING (image_id, set_index, label)", "perimeter_px", "perimeter_um", "circularity", base=with_more(PERIMETER)))
def perimeter_and_circularity(spark, sf_dir):
    return regions.relational_shape(*inputs(spark, sf_dir)).select("image_id", "set_index", "label", "perimeter_px", "perimeter_um", "circularity")


#: Normals of all edges that the hull of an object of at most 8 by 8 pixels' extents can have.
_NORMALS = [(a, b) for a in range(-18, 19) for b in range(-18, 19) if math.gcd(a, b) == 1]
HULLS = f"""shapes AS (SELECT image_id, set_index, label, y - min(y) OVER w AS y, x - min(x) OVER w AS x FROM labels WINDOW w AS (PARTITION BY image_id, set_index, label)),
forms AS (SELECT image_id, set_index, label, string_agg(y || ',' || x, ' ' ORDER BY y, x) AS form, count(*) AS n FROM shapes GROUP BY 1, 2, 3),
kinds AS (SELECT form, row_number() OVER (ORDER BY form) AS k FROM (SELECT DISTINCT form FROM forms)),
cells AS (SELECT DISTINCT k, y, x FROM shapes JOIN forms USING (image_id, set_index, label) JOIN kinds USING (form)),
sides AS (SELECT k, 2 * y + dy AS y, 2 * x + dx AS x FROM cells, (VALUES (1, 0), (-1, 0), (0, 1), (0, -1)) d(dy, dx)),
reach AS (SELECT k, a, b, max(a * y + b * x) AS most FROM sides, (VALUES {', '.join(f'({a}, {b})' for a, b in _NORMALS)}) m(a, b) GROUP BY 1, 2, 3),
box AS (SELECT k, max(y) AS y1, max(x) AS x1 FROM cells GROUP BY 1),
inside AS (SELECT k, u.y, v.x FROM box, range(64) u(y), range(64) v(x) WHERE u.y <= y1 AND v.x <= x1 AND NOT EXISTS (SELECT 1 FROM reach r WHERE r.k = box.k AND r.a * 2 * u.y + r.b * 2 * v.x > r.most)),
convex AS (SELECT k, count(*) AS hull FROM inside GROUP BY 1),
outline AS (SELECT k, 2 * y + dy AS y, 2 * x + dx AS x FROM inside, (VALUES (1, 0), (-1, 0), (0, 1), (0, -1)) d(dy, dx)),
wide AS (SELECT p.k, max(sqrt((p.y - q.y) ** 2 + (p.x - q.x) ** 2)) / 2 AS feret FROM outline p JOIN outline q USING (k) GROUP BY 1),
around AS (SELECT k, CAST(u.y AS BIGINT) - 1 AS y, CAST(v.x AS BIGINT) - 1 AS x FROM box, range(66) u(y), range(66) v(x) WHERE u.y <= y1 + 2 AND v.x <= x1 + 2),
free AS (SELECT a.* FROM around a ANTI JOIN cells c ON c.k = a.k AND c.y = a.y AND c.x = a.x),
flow AS (SELECT k, y, x FROM free WHERE y = -1 AND x = -1 UNION SELECT f.k, f.y, f.x FROM flow g JOIN free f ON f.k = g.k AND abs(f.y - g.y) + abs(f.x - g.x) = 1),
whole AS (SELECT a.k, count(*) - any_value(o.n) AS filled FROM around a JOIN (SELECT k, count(*) AS n FROM flow GROUP BY 1) o ON o.k = a.k GROUP BY 1)"""


@query(
    sql(
        "SELECT image_id, 0 AS t, set_index, label, CAST(hull AS DOUBLE) AS convex_area_px2, n / hull AS solidity, CAST(filled AS DOUBLE) AS filled_area_px2, feret AS feret_diameter_max_px FROM forms JOIN kinds USING (form) JOIN convex USING (k) JOIN wide USING (k) JOIN whole USING (k)",
        "solidity",
        "feret_diameter_max_px",
        base=with_more(HULLS).replace("WITH img", "WITH RECURSIVE img"),
    )
)
def hull_shape(spark, sf_dir):
    labels, images = inputs(spark, sf_dir)
    out = regions.objects(labels, images).join(geometry.shapes(labels).hint("merge"), raster.OBJECT)
    return out.select(*raster.OBJECT, F.col("convex_size").alias("convex_area_px2"), (F.col("voxel_count") / F.col("convex_size")).alias("solidity"), F.col("filled_size").alias("filled_area_px2"), "feret_diameter_max_px")


VOLUMES = """vox AS (SELECT image_id, z, y, x, (y // 16) * 2 + x // 16 + 1 AS label FROM grid, range(3) p(z)
    WHERE y % 16 BETWEEN 1 AND 10 + image_id % 3 AND x % 16 BETWEEN 2 AND 9 AND NOT (z = 1 AND y % 16 BETWEEN 4 AND 6 AND x % 16 BETWEEN 4 AND 6))"""
#: Cells of the union of closed voxels: corners, edges, faces and bodies, at half steps.
SOLIDS = (
    VOLUMES
    + """,
place AS (SELECT image_id, label, 2 * z AS z, 2 * y - 2 * min(y) OVER w AS y, 2 * x - 2 * min(x) OVER w AS x FROM vox WINDOW w AS (PARTITION BY image_id, label)),
closed AS (SELECT DISTINCT image_id, label, p.z + a.d AS z, p.y + b.d AS y, p.x + c.d AS x FROM place p, (VALUES (-1), (0), (1)) a(d), (VALUES (-1), (0), (1)) b(d), (VALUES (-1), (0), (1)) c(d)),
euler AS (SELECT image_id, label, CAST(sum(CASE WHEN (z % 2 = 0)::INT + (y % 2 = 0)::INT + (x % 2 = 0)::INT IN (0, 2) THEN 1 ELSE -1 END) AS INTEGER) AS euler_number FROM closed GROUP BY 1, 2),
size AS (SELECT image_id, label, count(*) AS n, max(y) AS y1, max(x) AS x1 FROM place GROUP BY 1, 2),
around AS (SELECT image_id, label, 2 * a.v - 2 AS z, 2 * b.v - 2 AS y, 2 * c.v - 2 AS x FROM size, range(5) a(v), range(20) b(v), range(20) c(v) WHERE 2 * b.v - 2 <= y1 + 2 AND 2 * c.v - 2 <= x1 + 2),
free AS (SELECT a.* FROM around a ANTI JOIN place p ON p.image_id = a.image_id AND p.label = a.label AND p.z = a.z AND p.y = a.y AND p.x = a.x),
flow AS (SELECT image_id, label, z, y, x FROM free WHERE z = -2 AND y = -2 AND x = -2 UNION SELECT f.image_id, f.label, f.z, f.y, f.x FROM flow g JOIN free f ON f.image_id = g.image_id AND f.label = g.label AND abs(f.z - g.z) + abs(f.y - g.y) + abs(f.x - g.x) = 2),
filled AS (SELECT image_id, label, count(*) - any_value(o) AS filled FROM around JOIN (SELECT image_id, label, count(*) AS o FROM flow GROUP BY 1, 2) USING (image_id, label) GROUP BY 1, 2)"""
)


@query(
    sql(
        # the hull of a block with a hollow is the block: its box
        "SELECT image_id, 0 AS t, 1 AS set_index, label, CAST(n AS DOUBLE) AS volume_voxels, CAST(3 * (y1 // 2 + 1) * (x1 // 2 + 1) AS DOUBLE) AS convex_volume_voxels, n / (3 * (y1 // 2 + 1) * (x1 // 2 + 1)) AS solidity, CAST(filled AS DOUBLE) AS filled_volume_voxels, euler_number FROM size JOIN euler USING (image_id, label) JOIN filled USING (image_id, label)",
        "solidity",
        base=with_more(SOLIDS).replace("WITH img", "WITH RECURSIVE img"),
    )
)
def volume_shape(spark, sf_dir):
    volumes, images = raster.volumes(spark, sf_dir), raster.images(spark, sf_dir)
    out = regions.objects(volumes, images).join(geometry.shapes(volumes).hint("merge"), raster.OBJECT)
    return out.select(*raster.OBJECT, "volume_voxels", F.col("convex_size").alias("convex_volume_voxels"), (F.col("voxel_count") / F.col("convex_size")).alias("solidity"), F.col("filled_size").alias("filled_volume_voxels"), F.col("euler_number_3d").alias("euler_number"))


def _axes_sql(scales: str, name: str) -> str:
    """The axes of vox's objects by the roots of the characteristic polynomial, of coordinates that the scales multiply."""
    return f"""{name} AS (SELECT image_id, label, CASE WHEN q IS NOT NULL THEN sqrt(greatest(10 * (l1 + (3 * q - l1 - l3) - l3), 0)) END AS major, CASE WHEN q IS NOT NULL THEN sqrt(greatest(10 * (l3 + (3 * q - l1 - l3) - l1), 0)) END AS minor FROM (
    SELECT *, q + 2 * p * cos(f) AS l1, q + 2 * p * cos(f + 2 * pi() / 3) AS l3 FROM (
    SELECT *, acos(least(1, greatest(-1, coalesce(((zz - q) * ((yy - q) * (xx - q) - yx * yx) - zy * (zy * (xx - q) - yx * zx) + zx * (zy * yx - (yy - q) * zx)) / nullif(2 * p * p * p, 0), 0)))) / 3 AS f FROM (
    SELECT *, sqrt(((zz - q) * (zz - q) + (yy - q) * (yy - q) + (xx - q) * (xx - q) + 2 * (zy * zy + zx * zx + yx * yx)) / 6) AS p FROM (
    SELECT *, (zz + yy + xx) / 3 AS q FROM (SELECT image_id, label, zz * mz * mz AS zz, yy * my * my AS yy, xx * mx * mx AS xx, zy * mz * my AS zy, zx * mz * mx AS zx, yx * my * mx AS yx FROM {scales}))))))"""


SPANS = (
    VOLUMES
    + """,
cov AS (SELECT image_id, label, count(*) AS n, round(var_pop(z), 9) AS zz, round(var_pop(y), 9) AS yy, round(var_pop(x), 9) AS xx, round(covar_pop(z, y), 9) + 0.0 AS zy, round(covar_pop(z, x), 9) + 0.0 AS zx, round(covar_pop(y, x), 9) + 0.0 AS yx,
    max(z) - min(z) + 1 AS dz, max(y) - min(y) + 1 AS dy, max(x) - min(x) + 1 AS dx, sz, sy, sx FROM vox JOIN img USING (image_id) GROUP BY 1, 2, sz, sy, sx),
"""
    + _axes_sql("(SELECT *, 1 AS mz, 1 AS my, 1 AS mx FROM cov)", "px")
    + ",\n"
    + _axes_sql("(SELECT *, sz AS mz, sy AS my, sx AS mx FROM cov)", "um")
)
AXIS_COLUMNS = "major_axis_length_px minor_axis_length_px major_axis_length_um minor_axis_length_um equivalent_diameter_px equivalent_diameter_um volume_um3 extent aspect_ratio".split()


@query(
    sql(
        "SELECT image_id, 0 AS t, 1 AS set_index, label, px.major AS major_axis_length_px, px.minor AS minor_axis_length_px, um.major AS major_axis_length_um, um.minor AS minor_axis_length_um, cbrt(6 * n / pi()) AS equivalent_diameter_px, cbrt(6 * n * sz * sy * sx / pi()) AS equivalent_diameter_um, n * sz * sy * sx AS volume_um3, n / (dz * dy * dx) AS extent, px.major / nullif(px.minor, 0) AS aspect_ratio, CAST(NULL AS DOUBLE) AS eccentricity FROM cov JOIN px USING (image_id, label) JOIN um USING (image_id, label)",
        *AXIS_COLUMNS,
        base=with_more(SPANS),
    )
)
def volume_axes(spark, sf_dir):
    out = regions.moment_shape(regions.objects(raster.volumes(spark, sf_dir), raster.images(spark, sf_dir)))
    return out.select(*raster.OBJECT, *AXIS_COLUMNS, "eccentricity")


@query(sql("SELECT image_id, 0 AS t, set_index, count(*) AS label_count, CAST(sum(n) AS BIGINT) AS foreground_voxels, CAST(sum(n) AS DOUBLE) * 100 / 1024 AS foreground_percent, avg(n) AS mean_size, quantile_cont(n, 0.5) AS median_size, min(n) AS min_size, max(n) AS max_size, quantile_cont(sqrt(4 * n / pi()), 0.5) AS median_equivalent_diameter FROM obj GROUP BY 1, 3", "foreground_percent", "mean_size", "median_size", "median_equivalent_diameter"))
def label_statistics(spark, sf_dir):
    return regions.label_statistics(raster.labels(spark, sf_dir), SIDE * SIDE)


@query(sql("SELECT image_id, count(DISTINCT label) AS distinct_labels, max(label) AS max_label FROM labels GROUP BY 1"))
def object_counts(spark, sf_dir):
    return regions.object_counts(raster.labels(spark, sf_dir))


# Intensity and relationships ---------------------------------------------------------------------------------------------

VALUES = """vals AS (SELECT l.image_id, set_index, label, channel_index, value FROM labels l JOIN pixels p USING (image_id, y, x)),
stats AS (SELECT image_id, set_index, label, channel_index, count(*) AS sample_count, sum(value) AS intensity_sum, avg(value) AS intensity_mean, var_pop(value) AS intensity_variance, stddev_pop(value) AS intensity_stddev, min(value) AS intensity_min, max(value) AS intensity_max, median(value) AS intensity_median, mad(value) AS intensity_mad,
    quantile_cont(value, 0.1) AS intensity_p10, quantile_cont(value, 0.25) AS intensity_p25, quantile_cont(value, 0.75) AS intensity_p75, quantile_cont(value, 0.9) AS intensity_p90, stddev_pop(value) / nullif(avg(value), 0) AS coefficient_of_variation FROM vals GROUP BY 1, 2, 3, 4)"""
STATS = [f"intensity_{c}" for c in ("sum", "mean", "variance", "stddev", "min", "max", "median", "mad", "p10", "p25", "p75", "p90")] + ["coefficient_of_variation"]


@query(sql("SELECT 0 AS t, * FROM stats", *STATS, base=with_more(VALUES)))
def intensity_measurements(spark, sf_dir):
    return intensity.intensities(raster.labels(spark, sf_dir), raster.pixels(spark, sf_dir))


@query(sql("SELECT * FROM rel", "overlap_um2", "source_overlap_fraction", "target_overlap_fraction", "centroid_distance_um", base=OVERLAPS))
def mask_overlaps(spark, sf_dir):
    labels, images = inputs(spark, sf_dir)
    return relationships.relationships(labels, regions.objects(labels, images))


@query(sql("SELECT image_id, 0 AS t, ss AS source_set, sl AS source_label, ts AS target_set, tl AS target_label, n AS overlap_voxels FROM one WHERE ss < ts", base=OVERLAPS))
def overlap_counts(spark, sf_dir):
    return relationships.overlaps(raster.labels(spark, sf_dir))


# Post-processing ---------------------------------------------------------------------------------------------------------


@query(sql("SELECT DISTINCT image_id, 0 AS t, set_index, label FROM labels WHERE y IN (0, 31) OR x IN (0, 31)"))
def border_labels(spark, sf_dir):
    return postprocess.border_labels(raster.labels(spark, sf_dir), SIDE, SIDE)


@query(sql("SELECT image_id, set_index, label, n AS voxels FROM obj o WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.image_id = o.image_id AND l.set_index = o.set_index AND l.label = o.label AND (y IN (0, 31) OR x IN (0, 31)))"))
def border_removal(spark, sf_dir):
    return postprocess.without_border(raster.labels(spark, sf_dir), SIDE, SIDE).groupBy("image_id", "set_index", "label").agg(F.count("*").alias("voxels"))


@query(sql("SELECT image_id, 0 AS t, cell, nucleus, CAST(new_id AS BIGINT) AS new_id FROM ids", base=MATCH))
def nucleus_matching(spark, sf_dir):
    labels = raster.labels(spark, sf_dir)
    return postprocess.matches(postprocess.of_set(labels, 1), postprocess.of_set(labels, 2)).withColumn("new_id", F.col("new_id").cast("long"))


@query(
    sql(
        """SELECT image_id, set_index, label, count(*) AS voxels, CAST(sum(y * 32 + x) AS BIGINT) AS places FROM (
        SELECT image_id, 1 AS set_index, new_id AS label, y, x FROM nc UNION ALL SELECT image_id, 2, new_id, y, x FROM nn
        UNION ALL SELECT image_id, 3, new_id, y, x FROM nc WHERE NOT EXISTS (SELECT 1 FROM nn WHERE nn.image_id = nc.image_id AND nn.y = nc.y AND nn.x = nc.x)) GROUP BY 1, 2, 3""",
        base=MATCH,
    )
)
def compartments(spark, sf_dir):
    out = postprocess.matched_labels(raster.labels(spark, sf_dir))
    return out.groupBy("image_id", "set_index", "label").agg(F.count("*").alias("voxels"), F.sum(F.col("y") * SIDE + F.col("x")).alias("places"))


_REACH = [(dy, dx, dy * dy * 0.25 + dx * dx * 0.0625) for dy in range(-2, 3) for dx in range(-4, 5) if dy * dy * 0.25 + dx * dx * 0.0625 <= 1]


@query(
    sql(
        f"""SELECT image_id, y, x, label FROM (SELECT image_id, y + dy AS y, x + dx AS x, label, d2 FROM labels, (VALUES {', '.join(f'({dy}, {dx}, {d})' for dy, dx, d in _REACH)}) m(dy, dx, d2) WHERE set_index = 2)
        WHERE y BETWEEN 0 AND 31 AND x BETWEEN 0 AND 31 QUALIFY row_number() OVER (PARTITION BY image_id, y, x ORDER BY d2, label) = 1"""
    )
)
def nearest_seed_expansion(spark, sf_dir):
    seeds = postprocess.of_set(raster.labels(spark, sf_dir), 2)
    return postprocess.expanded(seeds, 1.0, 0.5, 0.25, SIDE, SIDE).drop("t", "z")


@query(sql("SELECT image_id, set_index, label + coalesce(before, 0) AS label, n AS voxels FROM obj JOIN (SELECT image_id, set_index, CAST(sum(top) OVER (PARTITION BY set_index ORDER BY image_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT) AS before FROM (SELECT image_id, set_index, max(label) AS top FROM obj GROUP BY 1, 2)) USING (image_id, set_index)"))
def id_offsets(spark, sf_dir):
    # slabs here are images; the running sum has one row for each
    out = postprocess.offset_ids(raster.labels(spark, sf_dir), ["set_index"], ["image_id"])
    return out.groupBy("image_id", "set_index", "label").agg(F.count("*").alias("voxels"))


@query(
    sql(
        """SELECT image_id, 0 AS t, CAST(0 AS BIGINT) AS z, k AS label, got // 32 AS y, got % 32 AS x FROM walk WHERE got IS NOT NULL""",
        base=BASE.replace("WITH img", "WITH RECURSIVE img").rstrip()
        + """,
places AS (SELECT image_id, row_number() OVER (PARTITION BY image_id ORDER BY y * 32 + x) AS k, CAST(least(greatest(round_even(y + 0.5::DOUBLE, 0), 0), 31) AS BIGINT) AS y, CAST(least(greatest(round_even(x - 0.5::DOUBLE, 0), 0), 31) AS BIGINT) AS x FROM sig WHERE v >= 50),
tries AS (SELECT image_id, k, list_filter([y * 32 + x, CASE WHEN y > 0 THEN (y - 1) * 32 + x END, CASE WHEN y < 31 THEN (y + 1) * 32 + x END, CASE WHEN x > 0 THEN y * 32 + x - 1 END, CASE WHEN x < 31 THEN y * 32 + x + 1 END], lambda p: p IS NOT NULL) AS ways FROM places),
walk AS (SELECT DISTINCT image_id, CAST(0 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS got, CAST([] AS BIGINT[]) AS taken FROM places
    UNION ALL SELECT w.image_id, t.k, list_filter(ways, lambda p: NOT list_contains(taken, p))[1], CASE WHEN list_filter(ways, lambda p: NOT list_contains(taken, p))[1] IS NULL THEN taken ELSE list_append(taken, list_filter(ways, lambda p: NOT list_contains(taken, p))[1]) END FROM walk w JOIN tries t ON t.image_id = w.image_id AND t.k = w.k + 1)
""",
    )
)
def points_to_labels(spark, sf_dir):
    points = raster.signal(spark, sf_dir).filter(F.col("v") >= 50).select("image_id", (F.col("y") * SIDE + F.col("x")).alias("point"), (F.col("y") + 0.5).alias("py"), (F.col("x") - 0.5).alias("px"))
    return postprocess.points_to_labels(points, SIDE, SIDE)


# Pixels ------------------------------------------------------------------------------------------------------------------


def channel_one(spark, sf_dir) -> DataFrame:
    return raster.pixels(spark, sf_dir).filter("channel_index = 1")


@query(
    sql(
        "SELECT p.image_id, 0 AS t, p.channel_index, CAST(0 AS BIGINT) AS z, p.y, p.x, sum(w * q.value) / 16 AS value FROM pixels p, (VALUES (-1, -1, 1), (-1, 0, 2), (-1, 1, 1), (0, -1, 2), (0, 0, 4), (0, 1, 2), (1, -1, 1), (1, 0, 2), (1, 1, 1)) m(dy, dx, w) JOIN pixels q ON q.image_id = p.image_id AND q.channel_index = p.channel_index AND q.y = least(greatest(p.y + dy, 0), 31) AND q.x = least(greatest(p.x + dx, 0), 31) GROUP BY p.image_id, p.channel_index, p.y, p.x",
        "value",
    )
)
def binomial_smooth(spark, sf_dir):
    # the raster's values are whole numbers
    return stencil.binomial_smooth(raster.pixels(spark, sf_dir), SIDE, SIDE, finite=True)


@query(sql("SELECT image_id, channel_index, y, x, CAST(floor(least(greatest((value - lo) * 255.0::DOUBLE / ((CASE WHEN hi <= lo THEN lo + 1 ELSE hi END) - lo), 0), 255)) AS INTEGER) AS value FROM pixels JOIN (SELECT image_id, channel_index, quantile_cont(value, 0.005) AS lo, quantile_cont(value, 0.998) AS hi FROM pixels GROUP BY 1, 2) USING (image_id, channel_index)"))
def percentile_stretch(spark, sf_dir):
    return stencil.stretched(raster.pixels(spark, sf_dir)).drop("t", "z")


@query("SELECT CAST(l_suppkey AS BIGINT) AS image_id, 1 AS channel_index, CAST(l_orderkey % 32 AS BIGINT) AS y, CAST(l_partkey % 32 AS BIGINT) AS x, max(CAST(l_quantity AS DOUBLE)) AS value FROM lineitem GROUP BY 1, 3, 4")
def max_projection(spark, sf_dir):
    stack = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("long").alias("image_id"), F.lit(1).alias("channel_index"), F.col("l_linenumber").alias("z"), (F.col("l_orderkey") % 32).cast("long").alias("y"), (F.col("l_partkey") % 32).cast("long").alias("x"), F.col("l_quantity").cast("double").alias("value"))
    return stencil.projected(stack)


@query(sql("SELECT image_id, k AS level, channel_index, y // (1 << k) AS y, x // (1 << k) AS x, value FROM pixels, (VALUES (0), (1), (2)) l(k) WHERE y % (1 << k) = 0 AND x % (1 << k) = 0"))
def pyramid_levels(spark, sf_dir):
    levels = stencil.pyramid(raster.pixels(spark, sf_dir), SIDE, SIDE, least=16, most=5)
    parts = [d.select("image_id", F.lit(k).alias("level"), "channel_index", "y", "x", "value") for k, d in enumerate(levels)]
    return functools.reduce(DataFrame.unionByName, parts)


@query(sql("SELECT image_id, channel_index, y - 6 AS y, x - 6 AS x, value FROM pixels WHERE y BETWEEN 6 AND 25 AND x BETWEEN 6 AND 25"))
def centre_crop(spark, sf_dir):
    return stencil.centre_crop(raster.pixels(spark, sf_dir), SIDE, SIDE, 20).select("image_id", "channel_index", "y", "x", "value")


@query(sql("SELECT p.image_id, p.channel_index, CAST(a.k AS BIGINT) AS y, CAST(b.k AS BIGINT) AS x, p.value FROM pixels p, range(20) a(k), range(48) b(k) WHERE p.y = (a.k * 32) // 20 AND p.x = (b.k * 32) // 48"))
def nearest_resize(spark, sf_dir):
    return stencil.resized_nearest(raster.pixels(spark, sf_dir), SIDE, SIDE, 20, 48).select("image_id", "channel_index", "y", "x", "value")


def _bilinear_sql(height: int, width: int) -> str:
    """Weights by the triangle's formula, for each target and source of an axis, and their sums."""
    def axis(name: str, m: int) -> str:
        scale, reach = SIDE / m, max(1.0, SIDE / m)
        return f"""{name} AS (SELECT k, j, w / sum(w) OVER (PARTITION BY k) AS w FROM (SELECT k, j, greatest(0, 1 - abs(j - {scale}::DOUBLE * (k + 0.5::DOUBLE) + 0.5::DOUBLE) / {reach}::DOUBLE) AS w FROM range({m}) a(k), range({SIDE}) b(j)
            WHERE j >= greatest(trunc({scale}::DOUBLE * (k + 0.5::DOUBLE) - {reach}::DOUBLE + 0.5::DOUBLE), 0) AND j < least(trunc({scale}::DOUBLE * (k + 0.5::DOUBLE) + {reach}::DOUBLE + 0.5::DOUBLE), {SIDE})))"""

    body = "SELECT image_id, channel_index, r.k AS y, c.k AS x, sum(value * r.w * c.w) AS value FROM pixels p JOIN wy r ON r.j = p.y JOIN wx c ON c.j = p.x GROUP BY 1, 2, 3, 4"
    return sql(body, "value", base=with_more(axis("wy", height) + ",\n" + axis("wx", width)))


@query(_bilinear_sql(20, 13))
def bilinear_shrink(spark, sf_dir):
    return stencil.resized_bilinear(raster.pixels(spark, sf_dir), SIDE, SIDE, 20, 13).select("image_id", "channel_index", "y", "x", "value")


@query(_bilinear_sql(45, 24))
def bilinear_grow(spark, sf_dir):
    """Finer rows and coarser columns, over blocks."""
    blocks = tiles.to_blocks(raster.pixels(spark, sf_dir), SIDE, SIDE)
    return tiles.to_pixels(stencil.resized_planes(blocks, 45, 24, "<f8")).select("image_id", "channel_index", "y", "x", "value")


RAYS = 8
STARS = f"""stars AS (SELECT image_id, y * 32 + x + 1 AS point, y AS py, x AS px, v % 7 AS prob, k, (1 + (v + k * k) % 5) * 0.8125::DOUBLE AS d FROM sig, range({RAYS}) r(k) WHERE v >= 60),
corners AS (SELECT *, py * 1.5::DOUBLE + d * 1.5::DOUBLE * sin(k * 2 * pi() / {RAYS}) AS cy, px * 1.25::DOUBLE + d * 1.25::DOUBLE * cos(k * 2 * pi() / {RAYS}) AS cx FROM stars),
sides AS (SELECT a.image_id, a.point, a.prob, a.cy AS ay, a.cx AS ax, b.cy AS ty, b.cx AS tx FROM corners a JOIN corners b ON a.image_id = b.image_id AND a.point = b.point AND b.k = (a.k + 1) % {RAYS}),
met AS (SELECT image_id, point, prob, r.y, ax + (r.y - ay) * (tx - ax) / (ty - ay) AS x FROM sides, range(48) r(y) WHERE (ay <= r.y) <> (ty <= r.y)),
ordered AS (SELECT *, row_number() OVER (PARTITION BY image_id, point, y ORDER BY x) AS n FROM met),
inside AS (SELECT a.image_id, a.point, a.prob, a.y, q.x FROM ordered a JOIN ordered b ON b.image_id = a.image_id AND b.point = a.point AND b.y = a.y AND b.n = a.n + 1 AND a.n % 2 = 1 JOIN range(40) q(x) ON q.x BETWEEN a.x AND b.x)"""


@query(sql("SELECT image_id, y, x, point AS label FROM inside QUALIFY row_number() OVER (PARTITION BY image_id, y, x ORDER BY prob DESC, point DESC) = 1", base=with_more(STARS)))
def polygon_labels(spark, sf_dir):
    """Stars about bright places, with rays of uneven lengths, drawn on a grid that is finer by 1.5 and 1.25."""
    lit = raster.signal(spark, sf_dir).filter("v >= 60")
    rays = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(RAYS - 1).cast("long")), lambda k: (1 + (F.col("v") + k * k) % 5) * 0.8125)
    stars = lit.select("image_id", (F.col("y") * SIDE + F.col("x") + 1).alias("point"), F.col("y").cast("double").alias("py"), F.col("x").cast("double").alias("px"), (F.col("v") % 7).cast("double").alias("prob"), rays.alias("dist"))
    return polygons.polygons_to_labels(stars, 48, 40, 1.5, 1.25)


@query(sql("SELECT image_id, set_index, label, y, x, a.k AS tile_y, b.k AS tile_x, y // 16 = a.k AND x // 16 = b.k AS core FROM labels, range(2) a(k), range(2) b(k) WHERE y BETWEEN a.k * 16 - 3 AND a.k * 16 + 18 AND x BETWEEN b.k * 16 - 3 AND b.k * 16 + 18"))
def halo_tiles(spark, sf_dir):
    return stencil.tiled(raster.labels(spark, sf_dir), 16, 3, SIDE, SIDE).drop("t", "z")


@query("SELECT l_orderkey, l_linenumber, CAST(round_even(CAST(l_extendedprice AS DOUBLE), 0) AS INTEGER) AS pixel FROM lineitem")
def exact_int_pixels(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", S.exact_int(F.col("l_extendedprice").cast("double")).alias("pixel"))


# Views and documented queries --------------------------------------------------------------------------------------------


def view_query(text: str):
    """Over published tables: those that the text's tables and views need are measured once a session and state of the input."""
    return lambda spark, sf_dir: spark.sql(measurements.over_published(spark, sf_dir, text))


KIND = "CASE set_index WHEN 1 THEN 'cells' WHEN 2 THEN 'nuclei' WHEN 3 THEN 'cytoplasm' ELSE 'spots' END"
NAME = "CASE set_index WHEN 1 THEN 'labels_cells' WHEN 2 THEN 'labels_nuclei' WHEN 3 THEN 'labels_cytoplasm' ELSE 'labels_spots_channel_1' END"
NUMBERS = """numbers AS (SELECT image_id, set_index, label, row_number() OVER (ORDER BY image_id, set_index, label) AS object_id FROM obj)"""
FOCI = OVERLAPS.rstrip() + """,
foci AS (SELECT *, CASE target_set WHEN 1 THEN 'cells' WHEN 2 THEN 'nuclei' ELSE 'cytoplasm' END AS target_object_type FROM rel WHERE source_set = 4 AND target_set < 4 AND is_primary_for_source)
"""

for _name, _text, _oracle in (
    ("object_features_view", "SELECT object_id, image_name, plate_row, plate_column, field_index, label_name, locations_only, object_type, voxel_count, area_um2, bbox_min_y_px, major_axis_length_px FROM object_features",
     sql(f"SELECT object_id, 'field_' || image_id AS image_name, plate_row, plate_column, CAST(image_id AS VARCHAR) AS field_index, {NAME} AS label_name, set_index = 4 AS locations_only, {KIND} AS object_type, n AS voxel_count, CASE WHEN set_index < 4 THEN n * sy * sx END AS area_um2, CASE WHEN set_index < 4 THEN y0 END AS bbox_min_y_px, CASE WHEN set_index < 4 THEN 4 * sqrt((vy + vx) / 2 + sqrt(power((vy - vx) / 2, 2) + power(vyx, 2))) END AS major_axis_length_px FROM objs JOIN numbers USING (image_id, set_index, label)", "area_um2", "major_axis_length_px", base=with_more(NUMBERS))),
    ("intensity_features_view", "SELECT object_id, label_value, object_type, channel_index, channel_name, sample_count, intensity_mean, intensity_mad FROM intensity_features",
     sql(f"SELECT object_id, label AS label_value, {KIND} AS object_type, channel_index, CASE channel_index WHEN 1 THEN 'Signal' ELSE 'Reference' END AS channel_name, sample_count, intensity_mean, intensity_mad FROM stats JOIN numbers USING (image_id, set_index, label)", "intensity_mean", "intensity_mad", base=with_more(VALUES + ",\n" + NUMBERS))),
    ("mask_relationships_view", "SELECT source_object_id, target_object_id, source_object_type, target_object_type, source_label_name, target_label_name, relation, overlap_voxels, is_primary_for_source FROM mask_relationships",
     sql(f"SELECT a.object_id AS source_object_id, b.object_id AS target_object_id, {KIND.replace('set_index', 'source_set')} AS source_object_type, {KIND.replace('set_index', 'target_set')} AS target_object_type, {NAME.replace('set_index', 'source_set')} AS source_label_name, {NAME.replace('set_index', 'target_set')} AS target_label_name, relation, overlap_voxels, is_primary_for_source FROM rel JOIN numbers a ON a.image_id = rel.image_id AND a.set_index = source_set AND a.label = source_label JOIN numbers b ON b.image_id = rel.image_id AND b.set_index = target_set AND b.label = target_label", base=OVERLAPS.rstrip() + ",\n" + NUMBERS + "\n")),
    ("foci_assignments_view", "SELECT source_object_id, target_object_id, target_object_type, relation, source_overlap_fraction FROM foci_assignments",
     sql("SELECT a.object_id AS source_object_id, b.object_id AS target_object_id, target_object_type, relation, source_overlap_fraction FROM foci JOIN numbers a ON a.image_id = foci.image_id AND a.set_index = source_set AND a.label = source_label JOIN numbers b ON b.image_id = foci.image_id AND b.set_index = target_set AND b.label = target_label", "source_overlap_fraction", base=FOCI.rstrip() + ",\n" + NUMBERS + "\n")),
    ("cells_with_area", "SELECT image_name, label_value, area_um2, centroid_y_um, centroid_x_um FROM object_features WHERE object_type = 'cells' AND area_um2 IS NOT NULL",
     sql("SELECT 'field_' || image_id AS image_name, label AS label_value, n * sy * sx AS area_um2, cy * sy AS centroid_y_um, cx * sx AS centroid_x_um FROM objs WHERE set_index = 1 AND sy IS NOT NULL", "area_um2", "centroid_y_um", "centroid_x_um")),
    ("cell_signal", "SELECT image_id, label_value, intensity_mean, intensity_median FROM intensity_features WHERE object_type = 'cells' AND channel_name = 'Signal'",
     sql("SELECT image_id, label AS label_value, intensity_mean, intensity_median FROM stats WHERE set_index = 1 AND channel_index = 1", "intensity_mean", "intensity_median", base=with_more(VALUES))),
    ("foci_by_compartment", "SELECT image_id, target_object_type, count(*) AS foci FROM foci_assignments GROUP BY image_id, target_object_type",
     sql("SELECT image_id, target_object_type, count(*) AS foci FROM foci GROUP BY 1, 2", base=FOCI)),
    ("per_well_summary", "SELECT plate_row, plate_column, count(*) AS cells, avg(area_um2) AS mean_area_um2 FROM object_features WHERE object_type = 'cells' GROUP BY plate_row, plate_column ORDER BY plate_row, plate_column",
     sql("SELECT plate_row, plate_column, count(*) AS cells, avg(n * sy * sx) AS mean_area_um2 FROM objs WHERE set_index = 1 GROUP BY 1, 2", "mean_area_um2")),
    ("cells_without_foci", "SELECT o.image_id, o.label_value, count(f.source_object_id) AS foci FROM objects o LEFT JOIN foci_assignments f ON f.target_object_id = o.object_id WHERE o.object_type = 'cells' GROUP BY o.image_id, o.label_value",
     sql("SELECT o.image_id, o.label AS label_value, count(f.source_label) AS foci FROM obj o LEFT JOIN foci f ON f.image_id = o.image_id AND f.target_set = 1 AND f.target_label = o.label WHERE o.set_index = 1 GROUP BY 1, 2", base=FOCI)),
):
    _f = view_query(_text)
    _f.__name__ = _name
    query(_oracle)(_f)


_OBJECTS = {
    "object_id": "object_id", "image_id": "image_id", "label_set_id": "(image_id << 16) + set_index", "timepoint": "0", "label_value": "label", "object_type": "KIND", "is_point": "set_index = 4", "spatial_dimensions": "2", "voxel_count": "n",
    **{f"centroid_{a}_px": c for a, c in (("z", "0.0::DOUBLE"), ("y", "cy"), ("x", "cx"))}, **{f"centroid_{a}_um": c for a, c in (("z", "0 * sz"), ("y", "cy * sy"), ("x", "cx * sx"))},
    **{f"bbox_{m}_{a}_px": f"set_index < 4 ? {v}" for m, a, v in (("min", "z", "CAST(0 AS BIGINT)"), ("min", "y", "y0"), ("min", "x", "x0"), ("max", "z", "CAST(1 AS BIGINT)"), ("max", "y", "y1"), ("max", "x", "x1"))},
    **{f"bbox_{m}_{a}_um": f"set_index < 4 ? {v}" for m, a, v in (("min", "z", "0 * sz"), ("min", "y", "y0 * sy"), ("min", "x", "x0 * sx"), ("max", "z", "1 * sz"), ("max", "y", "y1 * sy"), ("max", "x", "x1 * sx"))},
    "area_px2": "set_index < 4 ? CAST(n AS DOUBLE)", "area_um2": "set_index < 4 ? n * sy * sx",
    "convex_area_px2": "set_index < 4 ? CAST(hull AS DOUBLE)", "convex_area_um2": "set_index < 4 ? hull * sy * sx", "filled_area_px2": "set_index < 4 ? CAST(filled AS DOUBLE)", "filled_area_um2": "set_index < 4 ? filled * sy * sx",
    "equivalent_diameter_px": "set_index < 4 ? sqrt(4 * n / pi())", "equivalent_diameter_um": "set_index < 4 ? sqrt(4 * n / pi()) * (sy + sx) / 2",
    "major_axis_length_px": "set_index < 4 ? 4 * sqrt(big)", "major_axis_length_um": "set_index < 4 ? 4 * sqrt(big) * (sy + sx) / 2", "minor_axis_length_px": "set_index < 4 ? 4 * sqrt(small)", "minor_axis_length_um": "set_index < 4 ? 4 * sqrt(small) * (sy + sx) / 2",
    "feret_diameter_max_px": "set_index < 4 ? feret", "feret_diameter_max_um": "set_index < 4 ? feret * (sy + sx) / 2", "perimeter_px": "set_index < 4 ? p", "perimeter_um": "set_index < 4 ? p * (sy + sx) / 2", "perimeter_crofton_px": "set_index < 4 ? crofton", "perimeter_crofton_um": "set_index < 4 ? crofton * (sy + sx) / 2",
    "circularity": "set_index < 4 ? 4 * pi() * n / nullif(p * p, 0)", "eccentricity": "set_index < 4 ? (CASE WHEN big = 0 THEN 0 ELSE sqrt(1 - small / big) END)", "solidity": "set_index < 4 ? n / hull", "extent": "set_index < 4 ? n / ((y1 - y0) * (x1 - x0))",
    "orientation_degrees": "set_index < 4 ? degrees(CASE WHEN vy = vx THEN CASE WHEN vyx > 0 THEN pi() / 4 ELSE -pi() / 4 END ELSE 0.5 * atan2(2 * vyx, vy - vx) END)", "euler_number": "set_index < 4 ? euler", "aspect_ratio": "set_index < 4 ? 4 * sqrt(big) / nullif(4 * sqrt(small), 0)",
}
_EMPTY = ["volume_voxels", "volume_um3", "convex_volume_voxels", "convex_volume_um3", "filled_volume_voxels", "filled_volume_um3", "surface_area_um2", "sphericity"]
WINDOWS = """quads AS (SELECT image_id, set_index, label, CAST((count(*) FILTER (code IN (1, 2, 4, 8)) - count(*) FILTER (code IN (7, 11, 13, 14)) - 2 * count(*) FILTER (code IN (6, 9))) / 4 AS INTEGER) AS euler,
    sum(CASE WHEN code IN (1, 5) THEN pi() / 4 * (1 + 1 / sqrt(2)) WHEN code IN (2, 7, 10, 11) THEN pi() / (4 * sqrt(2)) WHEN code = 3 THEN pi() / (2 * sqrt(2)) WHEN code IN (8, 12) THEN pi() / 4 WHEN code IN (9, 13) THEN pi() / 2 ELSE 0 END) AS crofton FROM codes GROUP BY 1, 2, 3),
spans AS (SELECT *, (vy + vx) / 2 + sqrt(power((vy - vx) / 2, 2) + power(vyx, 2)) AS big, greatest((vy + vx) / 2 - sqrt(power((vy - vx) / 2, 2) + power(vyx, 2)), 0) AS small FROM objs)"""


def _objects_sql() -> str:
    shown = [(f"CASE WHEN {v.replace(' ? ', ' THEN ')} END" if " ? " in v else v.replace("KIND", KIND)) + f" AS {c}" for c, v in _OBJECTS.items()] + [f"CAST(NULL AS DOUBLE) AS {c}" for c in _EMPTY]
    kinds = dict(c.split(" ") for c in measurements.COLUMNS["objects"].split(", "))
    joins = "".join(f" JOIN {t} USING (image_id, set_index, label)" for t in ("numbers", "quads", "per", "forms"))
    body = f"SELECT {', '.join(shown)} FROM spans{joins.replace('JOIN forms', 'JOIN (SELECT image_id, set_index, label, form FROM forms) f')} JOIN kinds USING (form) JOIN convex USING (k) JOIN wide USING (k) JOIN whole USING (k)"
    return sql(body, *(c for c in _OBJECTS if kinds[c] == "double"), base=with_more(",\n".join([HULLS, CODES, PERIMETER, WINDOWS, NUMBERS])).replace("WITH img", "WITH RECURSIVE img"))


@query(_objects_sql())
def objects_full(spark, sf_dir):
    return spark.sql(measurements.over_published(spark, sf_dir, "SELECT * FROM objects"))


PAIRED = (
    VOLUMES
    + """,
sets AS (SELECT image_id, 1 AS s, label, z, y, x FROM vox UNION ALL SELECT image_id, 2, (y // 16) * 2 + x // 16 + 11, z, y, x FROM grid, range(1, 3) p(z) WHERE y % 16 BETWEEN 5 AND 12 AND x % 16 BETWEEN 6 AND 13 + image_id % 2
    UNION ALL SELECT image_id, 3, (y // 8) * 4 + x // 8 + 1, 1, y, x FROM grid WHERE y % 8 BETWEEN 2 AND 5 AND x % 8 BETWEEN 1 AND 6),
own AS (SELECT image_id, s, label, count(*) AS n, min(z) = max(z) AS flat, avg(z) AS cz, avg(y) AS cy, avg(x) AS cx FROM sets GROUP BY 1, 2, 3),
met AS (SELECT a.image_id, a.s AS ss, a.label AS sl, b.s AS ts, b.label AS tl, count(*) AS k FROM sets a JOIN sets b USING (image_id, z, y, x) WHERE a.s <> b.s GROUP BY 1, 2, 3, 4, 5)"""
)


@query(
    sql(
        """SELECT met.image_id, 0 AS t, ss AS source_set, sl AS source_label, ts AS target_set, tl AS target_label, CASE WHEN k = p.n AND k = q.n THEN 'identical_extent' WHEN k = p.n THEN 'inside' WHEN k = q.n THEN 'contains' ELSE 'overlaps' END AS relation,
        k AS overlap_voxels, CASE WHEN p.flat AND q.flat THEN k * sy * sx END AS overlap_um2, CASE WHEN NOT (p.flat AND q.flat) THEN k * sz * sy * sx END AS overlap_um3, k / p.n AS source_overlap_fraction, k / q.n AS target_overlap_fraction,
        EXISTS (SELECT 1 FROM sets v WHERE v.image_id = met.image_id AND v.s = ts AND v.label = tl AND v.z = CAST(round_even(p.cz, 0) AS BIGINT) AND v.y = CAST(round_even(p.cy, 0) AS BIGINT) AND v.x = CAST(round_even(p.cx, 0) AS BIGINT)) AS source_centroid_in_target,
        CASE WHEN p.cz = q.cz OR sz IS NOT NULL THEN sqrt(power((p.cz - q.cz) * coalesce(sz, 0), 2) + power((p.cy - q.cy) * sy, 2) + power((p.cx - q.cx) * sx, 2)) END AS centroid_distance_um,
        k = max(k) OVER (PARTITION BY met.image_id, ss, sl, ts) AS is_primary_for_source
        FROM met JOIN own p ON p.image_id = met.image_id AND p.s = ss AND p.label = sl JOIN own q ON q.image_id = met.image_id AND q.s = ts AND q.label = tl JOIN img ON img.image_id = met.image_id""",
        *"overlap_um2 overlap_um3 source_overlap_fraction target_overlap_fraction centroid_distance_um".split(),
        base=with_more(PAIRED),
    )
)
def volume_relationships(spark, sf_dir):
    labels = raster.volume_pairs(spark, sf_dir)
    return relationships.relationships(labels, regions.objects(labels, raster.images(spark, sf_dir)))


_KEYED_TABLES = [*measurements.KEYS.items(), *measurements.NATURAL_KEYS.items()]


@query(" UNION ALL ".join(f"SELECT '{name}' AS table_name, '{', '.join(keys)}' AS key, CAST(0 AS BIGINT) AS violations" for name, keys in _KEYED_TABLES))
def key_violations(spark, sf_dir):
    return measurements.violations(spark, measurements.prepared(spark, sf_dir, set(measurements.KEYS), light=True))


# Runs --------------------------------------------------------------------------------------------------------------------


def steps(spark, sf_dir) -> DataFrame:
    """Step records from events: the user is the run, the kind the step's key, the value its seconds."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").cast("long").alias("run"), F.lit(0).alias("timepoint"), F.col("event_id").cast("long").alias("seq"), F.col("event_type").alias("key"), F.col("value").cast("double").alias("seconds"), (F.col("event_id") % 11 == 0).alias("failed"), (F.col("event_id") % 3 == 0).alias("model_cache_hit"))


_KEYS = ["startup_seconds", "import_seconds", "load_seconds", "inference_seconds", "read_seconds", "detail_seconds"]


def keyed_steps(spark, sf_dir) -> DataFrame:
    return steps(spark, sf_dir).withColumn("key", F.element_at(F.array(*map(F.lit, _KEYS)), (F.col("seq") % len(_KEYS) + 1).cast("int")))


_STEPS = "SELECT CAST(user_id AS BIGINT) AS run, CAST(event_id AS BIGINT) AS seq, event_type AS key, CAST(value AS DOUBLE) AS seconds, event_id % 11 = 0 AS failed, event_id % 3 = 0 AS model_cache_hit FROM events"
_KEYED = f"SELECT run, ['{"', '".join(_KEYS)}'][CAST(seq % {len(_KEYS)} AS INTEGER) + 1] AS key, seconds FROM ({_STEPS})"
_ROLLUP = f"SELECT run, key, CASE WHEN key = 'startup_seconds' THEN max(seconds) ELSE sum(seconds) END AS seconds FROM ({_KEYED}) GROUP BY run, key"
_REUSE = f"SELECT run, seq, key, reused_from, reused_from IS NOT NULL AS result_cache_hit, CASE WHEN reused_from IS NULL THEN seconds ELSE 0 END AS runtime_seconds, model_cache_hit FROM (SELECT *, min(CASE WHEN NOT failed THEN seq END) OVER (PARTITION BY run, key ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reused_from FROM ({_STEPS}))"


@query(sql(_ROLLUP, "seconds", base=""))
def timing_rollup(spark, sf_dir):
    return runs.timing_rollup(keyed_steps(spark, sf_dir))


@query(sql(f"SELECT run, sum(CASE WHEN key <> 'detail_seconds' THEN seconds ELSE 0 END) AS total_seconds FROM ({_ROLLUP}) GROUP BY run", "total_seconds", base=""))
def timing_total(spark, sf_dir):
    return runs.timing_total(runs.timing_rollup(keyed_steps(spark, sf_dir)))


@query(sql(f"SELECT run, seq, key, reused_from, result_cache_hit, runtime_seconds FROM ({_REUSE})", "runtime_seconds", base=""))
def result_reuse(spark, sf_dir):
    return runs.result_reuse(steps(spark, sf_dir)).select("run", "seq", "key", "reused_from", "result_cache_hit", "runtime_seconds")


_LEVELS = "CASE event_id % 4 WHEN 0 THEN 0.5::DOUBLE WHEN 1 THEN 'nan'::DOUBLE WHEN 2 THEN 'inf'::DOUBLE END"


@query(f"SELECT CAST(user_id AS BIGINT) AS run, CAST(event_id AS BIGINT) AS seq, min(CASE WHEN event_id % 11 <> 0 THEN CAST(event_id AS BIGINT) END) OVER (PARTITION BY user_id, event_id % 2, event_type, {_LEVELS}, event_id % 3 ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reused_from FROM events")
def reuse_by_settings(spark, sf_dir):
    """A step's key is its model, its settings and its image's scales, whatever their order and spelling; within a timepoint."""
    k = F.col("event_id")
    e = table(spark, sf_dir, "events").withColumns({"level": F.when(k % 4 == 0, 0.5).when(k % 4 == 1, float("nan")).when(k % 4 == 2, float("inf")), "step": (k % 3 + 1).cast("double")})
    scales = F.when(k % 6 < 3, F.create_map(F.lit("y"), "step", F.lit("x"), F.lit(0.5))).otherwise(F.create_map(F.lit("x"), F.lit(0.5), F.lit("y"), "step"))
    key = S.cache_key({"model": "event_type", "level": S.canonical_number("level"), "scales": S.canonical_map(scales)})
    records = e.select(F.col("user_id").cast("long").alias("run"), (k % 2).cast("int").alias("timepoint"), k.cast("long").alias("seq"), key.alias("key"), F.col("value").cast("double").alias("seconds"), (k % 11 == 0).alias("failed"))
    return runs.result_reuse(records).select("run", "seq", "reused_from")


@query(sql(f"SELECT run, count(*) FILTER (result_cache_hit) AS result_hits, count(*) FILTER (NOT result_cache_hit AND model_cache_hit) AS model_hits, count(*) FILTER (NOT result_cache_hit AND NOT model_cache_hit) AS model_misses, sum(runtime_seconds) AS runtime_seconds FROM ({_REUSE}) GROUP BY run", "runtime_seconds", base=""))
def cache_rollup(spark, sf_dir):
    return runs.cache_rollup(runs.result_reuse(steps(spark, sf_dir)))


@query(
    """WITH m AS (SELECT conv_id AS log, turn AS line, text, contains(text, 'qu') AS opens, contains(text, 'x') AS shuts, contains(text, 'z') AS drops FROM conversations),
    s AS (SELECT *, coalesce(last_value(CASE WHEN opens THEN true WHEN shuts OR drops THEN false END IGNORE NULLS) OVER (PARTITION BY log ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS inside FROM m),
    r AS (SELECT *, CASE WHEN opens THEN 'open' WHEN inside AND drops THEN 'drop' WHEN inside AND shuts THEN 'shut' WHEN inside THEN 'tail' ELSE 'plain' END AS role, trim(regexp_replace(text, '^\\s*\\*\\s?', '')) AS payload FROM s)
    SELECT log, line, CASE WHEN role = 'tail' THEN chr(9) || '* ' || payload ELSE text END AS text FROM (SELECT *, row_number() OVER (PARTITION BY log, role, payload ORDER BY line) AS k FROM r) WHERE role IN ('plain', 'shut') OR (role = 'tail' AND payload <> '' AND k = 1)"""
)
def log_compaction(spark, sf_dir):
    lines = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("log"), F.col("turn").alias("line"), "text")
    return runs.compact_log(lines, "qu", ["x"], "z")


# Scalars over columns of the tables --------------------------------------------------------------------------------------


@query("SELECT p_partkey, CASE WHEN contains(n, 'cytoplasm') THEN 'cytoplasm' WHEN contains(n, 'nuclei') THEN 'nuclei' WHEN contains(n, 'cells') THEN 'cells' WHEN contains(n, 'spots') THEN 'spots' WHEN contains(n, 'foci') THEN 'foci' WHEN contains(n, 'bacteria') THEN 'bacteria' ELSE coalesce(nullif(split_part(regexp_replace(n, '^labels_', ''), '_channel_', 1), ''), 'objects') END AS object_type FROM (SELECT p_partkey, lower(CASE p_partkey % 5 WHEN 0 THEN 'labels_Cells_' || p_partkey WHEN 1 THEN 'labels_spots_channel_1' WHEN 2 THEN 'nuclei of cells' WHEN 3 THEN 'labels_' ELSE 'labels_' || p_name || '_channel_2' END) AS n FROM part)")
def object_types(spark, sf_dir):
    k = F.col("p_partkey")
    name = F.when(k % 5 == 0, F.concat(F.lit("labels_Cells_"), k.cast("string"))).when(k % 5 == 1, "labels_spots_channel_1").when(k % 5 == 2, "nuclei of cells").when(k % 5 == 3, "labels_").otherwise(F.concat(F.lit("labels_"), "p_name", F.lit("_channel_2")))
    return table(spark, sf_dir, "part").select("p_partkey", S.object_type(name).alias("object_type"))


@query("SELECT p_partkey, coalesce(nullif(trim(regexp_replace(p_name, '[^a-zA-Z0-9_.-]+', '_', 'g'), '_.-'), ''), 'labels_' || p_partkey) AS group_name FROM part")
def group_names(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", S.safe_name("p_name", "p_partkey").alias("group_name"))


@query("SELECT p_partkey, CASE WHEN contains(n, 'nucle') THEN '0000FF' WHEN contains(n, 'cell') THEN '00FF00' WHEN contains(n, 'spot') THEN ['FFFF00', '00FFFF', 'FF8000', 'FF0000'][CAST(p_partkey % 4 AS INTEGER) + 1] ELSE ['00FF00', '0000FF', 'FF00FF', 'FFFF00', '00FFFF', 'FF8000', 'FF0000'][CAST(p_partkey % 7 AS INTEGER) + 1] END AS color FROM (SELECT p_partkey, ['nuclei', 'cells', 'spots', 'other'][CAST(p_partkey % 3 + p_partkey % 2 AS INTEGER) + 1] AS n FROM part)")
def label_colors(spark, sf_dir):
    k = F.col("p_partkey")
    name = F.element_at(F.array(*map(F.lit, ("nuclei", "cells", "spots", "other"))), (k % 3 + k % 2 + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", S.label_color(name, k).alias("color"))


@query("SELECT p_partkey, CASE WHEN c >= 2147483648 THEN c - 4294967296 ELSE c END AS signed_color FROM (SELECT p_partkey, CAST(p_partkey * 7919 % 16777216 AS BIGINT) * 256 + 255 AS c FROM part)")
def signed_colors(spark, sf_dir):
    color = F.lpad(F.hex((F.col("p_partkey") * 7919 % 16777216).cast("long")), 6, "0")
    return table(spark, sf_dir, "part").select("p_partkey", S.signed_color(color).alias("signed_color"))


@query(
    f"""SELECT p_partkey, '<?xml version="1.0" encoding="UTF-8"?>' || chr(10) || '<OME xmlns="{S.XML_SPACE}"><Image ID="Image:0" Name="' || replace(replace(p_name || ' & <' || p_brand || '>', '&', '&amp;'), '<', '&lt;').replace('>', '&gt;') || '"><Pixels ID="Pixels:0" DimensionOrder="XYZCT" Type="' || ['uint8', 'float', 'int32'][p_partkey % 3 + 1]
    || '" SizeX="' || p_size || '" SizeY="' || (p_size + 1) || '" SizeZ="1" SizeC="' || (p_partkey % 3 + 1) || '" SizeT="2" PhysicalSizeX="0.25" PhysicalSizeY="0.5" PhysicalSizeZ="' || CASE WHEN p_partkey % 2 = 0 THEN '1.5' ELSE '1.0' END || '">'
    || array_to_string(list_transform(range(p_partkey % 3 + 1), lambda i: '<Channel ID="Channel:0:' || i || '" Name="c' || i || '" Color="' || [16711935, -65281, -16711681, 65535][i + 1] || '" SamplesPerPixel="1"/>'), '') || '</Pixels></Image></OME>' AS document FROM part"""
)
def image_documents(spark, sf_dir):
    k = F.col("p_partkey")
    kind = F.element_at(F.array(*map(F.lit, ("uint8", "float32", "int32"))), (k % 3 + 1).cast("int"))
    channels = F.transform(F.sequence(F.lit(0).cast("long"), k % 3), lambda i: F.struct(F.concat(F.lit("c"), i.cast("string")).alias("label"), F.element_at(F.array(*map(F.lit, ("00FF00", "FFFF00", "FF00FF", "0000FF"))), (i + 1).cast("int")).alias("color")))
    size = {"t": F.lit(2), "c": k % 3 + 1, "z": F.lit(1), "y": F.col("p_size") + 1, "x": F.col("p_size")}
    name = F.concat("p_name", F.lit(" & <"), "p_brand", F.lit(">"))
    scales = {"z": F.when(k % 2 == 0, 1.5), "y": F.lit(0.5), "x": F.lit(0.25)}
    return table(spark, sf_dir, "part").select("p_partkey", S.image_document(name, kind, size, scales, channels).alias("document"))


@query(sql("SELECT p_partkey, CASE WHEN d < 0 THEN NULL WHEN d = 0 THEN (CASE WHEN p_partkey % 2 = 0 THEN 12.0::DOUBLE ELSE 25.0::DOUBLE END) / 0.5::DOUBLE ELSE d / 0.5::DOUBLE END AS diameter_px, greatest(1, CAST(round_even(abs(d) / 0.5::DOUBLE, 0) AS INTEGER)) AS distance_px FROM (SELECT p_partkey, CAST(p_size % 7 - 1 AS DOUBLE) * 0.25::DOUBLE AS d FROM part)", "diameter_px", base=""))
def pixel_sizes(spark, sf_dir):
    d = (F.col("p_size") % 7 - 1).cast("double") * 0.25
    return table(spark, sf_dir, "part").select("p_partkey", S.diameter_px(d, F.lit(0.5), F.col("p_partkey") % 2 == 0).alias("diameter_px"), S.distance_px(F.abs(d), F.lit(0.5)).alias("distance_px"))


@query("SELECT doc_id, list_transform(list_filter(list_transform(regexp_split_to_array(t, '[,;]'), lambda x: trim(x)), lambda x: x <> ''), lambda x: x) AS names, lower(lang) IN ('1', 'true', 'yes', 'on') AS flag FROM (SELECT doc_id, lang, lang || ' ,' || source || ';; ' || doc_id AS t FROM documents)")
def parsed_settings(spark, sf_dir):
    text = F.concat("lang", F.lit(" ,"), "source", F.lit(";; "), F.col("doc_id").cast("string"))
    return table(spark, sf_dir, "documents").select("doc_id", S.name_list(text).alias("names"), S.truth("lang").alias("flag"))


@query("SELECT doc_id, replace(regexp_replace(regexp_replace(text, '(?i)(OMERO_(?:ROOT_)?PASSWORD=)a1\\b', '\\1<redacted>', 'g'), '(?i)(\\s-w\\s+)a1\\b', '\\1<redacted>', 'g'), 'password=', '<redacted>') AS text FROM documents")
def redacted_texts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", S.redacted("text", ["a1", "password="]).alias("text"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN '/labels/g' || p_size ELSE (CASE WHEN p_partkey % 3 = 0 THEN '/' ELSE 'A/1/0' END) || ':channel:' || p_size END AS path, p_name || '_multistep_measurements.' || (CASE WHEN p_partkey % 2 = 0 THEN 'duckdb' ELSE 'sqlite' END) AS database, CASE WHEN p_size % 4 > 1 THEN p_size % 4 ELSE p_size % 3 END AS channel FROM part")
def output_paths(spark, sf_dir):
    k, n = F.col("p_partkey"), F.col("p_size")
    path = S.label_path(k % 2 == 0, F.lit("/"), F.concat(F.lit("g"), n.cast("string")), F.when(k % 3 == 0, "").otherwise("A/1/0"), n)
    return table(spark, sf_dir, "part").select("p_partkey", path.alias("path"), S.database_name("p_name", F.when(k % 2 == 0, "duckdb").otherwise("sqlite")).alias("database"), S.expansion_channel(n % 3, n % 4).alias("channel"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'nan' WHEN 1 THEN 'inf' WHEN 2 THEN '-inf' ELSE '0.5' END AS number FROM part")
def cache_key_numbers(spark, sf_dir):
    k = F.col("p_partkey") % 4
    value = F.when(k == 0, float("nan")).when(k == 1, float("inf")).when(k == 2, float("-inf")).otherwise(0.5)
    return table(spark, sf_dir, "part").select("p_partkey", S.canonical_number(value).alias("number"))


@query("SELECT n_name AS plate_row, CAST(s_suppkey AS BIGINT) AS field, s_suppkey % 5 <> 0 AS written FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 5 = 0")
def missing_fields(spark, sf_dir):
    from ..streaming.plate import missing

    expected = table(spark, sf_dir, "supplier").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("plate_row"), F.col("s_suppkey").cast("long").alias("field"))
    return missing(expected, expected.filter("field % 5 <> 0"), ["plate_row", "field"]).withColumn("written", F.lit(False))


@query("SELECT CAST(l_suppkey AS BIGINT) AS plate, count(DISTINCT l_linenumber) AS fields, count(*) - count(DISTINCT l_linenumber) AS refused, count(DISTINCT l_linenumber) >= 7 AS complete FROM lineitem GROUP BY 1")
def plate_progress(spark, sf_dir):
    """Lines as a stream of files: a supplier is a plate, a line's number a field of its seven."""
    from ..streaming.plate import followed

    schema = table(spark, sf_dir, "lineitem").schema
    base = folder(spark)
    source = Files(spark, sf_dir)
    whole = source.fs.getFileStatus(source.at("lineitem.parquet")).isDirectory()
    # a stream is of a folder's files
    stream = spark.readStream.schema(schema)
    lines = stream.parquet(f"{sf_dir}/lineitem.parquet") if whole else stream.option("pathGlobFilter", "lineitem.parquet").parquet(sf_dir)
    arrivals = lines.select(F.col("l_suppkey").cast("long").alias("plate"), F.col("l_linenumber").cast("long").alias("field"), F.lit(7).cast("long").alias("expected"), F.to_timestamp(F.lit("2024-01-01")).alias("at"))
    told = followed(arrivals, f"{base}/progress", f"{base}/checkpoint")
    return told.groupBy("plate").agg(F.sum("fields").alias("fields"), F.sum("refused").alias("refused"), F.max(F.expr("event = 'complete'")).alias("complete"))


# Spots, models, stores ---------------------------------------------------------------------------------------------------


def bright(spark, sf_dir) -> DataFrame:
    return raster.signal(spark, sf_dir).filter("v >= 30").select("image_id", "y", "x")


@query(
    """WITH RECURSIVE sig AS (SELECT CAST(l_suppkey AS BIGINT) AS image_id, CAST(l_orderkey % 32 AS BIGINT) AS y, CAST(l_partkey % 32 AS BIGINT) AS x FROM lineitem GROUP BY 1, 2, 3 HAVING sum(l_quantity) >= 30),
    reach AS (SELECT image_id, y, x, y * 32 + x + 1 AS label FROM sig UNION SELECT s.image_id, s.y, s.x, r.label FROM reach r JOIN sig s ON s.image_id = r.image_id AND abs(s.y - r.y) <= 1 AND abs(s.x - r.x) <= 1)
    SELECT image_id, y, x, min(label) AS label FROM reach GROUP BY 1, 2, 3"""
)
def connected_components(spark, sf_dir):
    # in tiles of half a side, so that components go over their edges
    return spots.components(bright(spark, sf_dir), SIDE, SIDE, tile=16)


REFINED = BASE.replace("WITH img", "WITH RECURSIVE img").rstrip() + """,
smooth AS (SELECT p.image_id, p.y, p.x, sum(w * q.value) / 16 AS v FROM pixels p, (VALUES (-1, -1, 1), (-1, 0, 2), (-1, 1, 1), (0, -1, 2), (0, 0, 4), (0, 1, 2), (1, -1, 1), (1, 0, 2), (1, 1, 1)) m(dy, dx, w)
    JOIN pixels q ON q.image_id = p.image_id AND q.channel_index = 1 AND q.y = least(greatest(p.y + dy, 0), 31) AND q.x = least(greatest(p.x + dx, 0), 31) WHERE p.channel_index = 1 GROUP BY 1, 2, 3),
patch AS (SELECT s.image_id, s.y * 32 + s.x AS point, s.y AS sy, s.x AS sx, p.y, p.x, p.v, power((p.y - s.y) / 2, 2) + power((p.x - s.x) / 4, 2) AS d FROM sig s JOIN smooth p ON p.image_id = s.image_id AND abs(p.y - s.y) <= 3 AND abs(p.x - s.x) <= 6 WHERE s.v >= 100),
ground AS (SELECT image_id, point, coalesce(median(v) FILTER (d BETWEEN 1 AND 2.25), median(v) FILTER (d > 1), median(v)) AS g, CASE WHEN count(*) FILTER (d BETWEEN 1 AND 2.25) > 0 THEN 1 WHEN count(*) FILTER (d > 1) > 0 THEN 2 ELSE 3 END AS ring FROM patch GROUP BY 1, 2),
level AS (SELECT image_id, point, any_value(g) AS g, 1.4826::DOUBLE * median(abs(v - g)) FILTER (CASE ring WHEN 1 THEN d BETWEEN 1 AND 2.25 WHEN 2 THEN d > 1 ELSE true END) AS noise, greatest(0, max(v - g) FILTER (abs(y - sy) <= 1 AND abs(x - sx) <= 1)) AS contrast FROM patch JOIN ground USING (image_id, point) GROUP BY 1, 2),
bright AS (SELECT p.* FROM patch p JOIN level l USING (image_id, point) WHERE d <= 1 AND v >= g + greatest(3 * noise, 0.3::DOUBLE * contrast)),
flood AS (SELECT image_id, point, y, x FROM bright WHERE y = sy AND x = sx UNION SELECT b.image_id, b.point, b.y, b.x FROM flood f JOIN bright b ON b.image_id = f.image_id AND b.point = f.point AND abs(b.y - f.y) <= 1 AND abs(b.x - f.x) <= 1),
grown AS (SELECT image_id, point, list(y * 32 + x) AS mask FROM flood GROUP BY 1, 2),
turns AS (SELECT image_id, point, coalesce(mask, [point]) AS mask, row_number() OVER (PARTITION BY image_id ORDER BY contrast / greatest(noise, 1e-6) DESC, point) AS k FROM level LEFT JOIN grown USING (image_id, point)),
walk AS (SELECT DISTINCT image_id, CAST(0 AS BIGINT) AS k, CAST(0 AS BIGINT) AS label, CAST([] AS BIGINT[]) AS taken, CAST([] AS BIGINT[]) AS got FROM turns
    UNION ALL SELECT image_id, k, label + CASE WHEN len(free) > 0 THEN 1 ELSE 0 END, list_concat(taken, free), free FROM (SELECT w.image_id, t.k, label, taken, CASE WHEN list_contains(taken, point) THEN CAST([] AS BIGINT[]) ELSE list_filter(mask, lambda p: NOT list_contains(taken, p)) END AS free FROM walk w JOIN turns t ON t.image_id = w.image_id AND t.k = w.k + 1))
"""


@query(sql("SELECT image_id, 0 AS t, CAST(0 AS BIGINT) AS z, place // 32 AS y, place % 32 AS x, label FROM (SELECT image_id, label, unnest(got) AS place FROM walk)", base=REFINED))
def spot_refinement(spark, sf_dir):
    points = raster.signal(spark, sf_dir).filter(F.col("v") >= raster.SPOT_LEVEL).select("image_id", (F.col("y") * SIDE + F.col("x")).alias("point"), F.col("y").cast("double").alias("py"), F.col("x").cast("double").alias("px"))
    return spots.refined(channel_one(spark, sf_dir), points, 0.5, 0.25, SIDE, SIDE, finite=True)


def _sql_models() -> str:
    rows = [f"('{f}:{n}', {list(t)!r}, {least})" for f, names, t, _, least in models.MODELS for n in names]
    return f"(VALUES {', '.join(rows)}) m(model_id, targets, min_channels)"


@query(f"SELECT CAST(s_suppkey AS BIGINT) AS image_id, model_id FROM supplier, {_sql_models()} WHERE list_contains(targets, 'nuclei') AND min_channels <= 1 + s_suppkey % 3")
def eligible_models(spark, sf_dir):
    counts = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("long").alias("image_id"), (1 + F.col("s_suppkey") % 3).alias("channels"))
    fit = F.broadcast(models.eligible(models.models(spark), "nuclei", 3))
    return counts.join(fit, F.col("min_channels") <= F.col("channels")).select("image_id", "model_id")


@query(f"SELECT n_name || '|ch' || (n_nationkey % 3 + 1) || '|' || model_id AS key, n_name AS step, target, CAST(n_nationkey % 3 + 1 AS BIGINT) AS channel, model_id FROM (SELECT *, CASE n_nationkey % 3 WHEN 0 THEN 'cells' WHEN 1 THEN 'foci' ELSE 'spots' END AS target FROM nation), {_sql_models()} WHERE list_contains(targets, target)")
def benchmark_cases(spark, sf_dir):
    k = F.col("n_nationkey") % 3
    steps = table(spark, sf_dir, "nation").select(F.col("n_name").alias("step"), F.when(k == 0, "cells").when(k == 1, "foci").otherwise("spots").alias("target"), (k + 1).cast("long").alias("channel"))
    return models.cases(steps, models.models(spark))


@query("SELECT n_name AS name FROM nation ORDER BY lower(n_name), n_name LIMIT 1")
def first_store(spark, sf_dir):
    from ..sources.zarr import first_store

    return first_store(table(spark, sf_dir, "nation").select(F.col("n_name").alias("name")))


_MANIFEST = {"manifest_version": "p_size", "docker_image_id": "p_brand", "descriptor_sha256": "p_type", "git_commit": "nullif(p_size % 3, 0)", "image_tag": "substr(p_name, 1, 2)"}


@query("WITH m AS (SELECT p_partkey, p_brand AS brand, p_size AS size, " + ", ".join(f"CAST({v} AS VARCHAR) AS {k}" for k, v in _MANIFEST.items()) + " FROM part) SELECT a.p_partkey, b.p_partkey AS other, b.p_partkey % 5 <> 0 AND " + " AND ".join(f"a.{k} IS NOT DISTINCT FROM b.{k}" for k in _MANIFEST) + " AS same FROM m a JOIN m b ON b.brand = a.brand AND b.size = a.size")
def manifest_equality(spark, sf_dir):
    """Manifests of parts of one brand and size, on all five keys; every fifth has no remote one."""
    manifest = F.struct(*(F.expr(v).cast("string").alias(k) for k, v in _MANIFEST.items()))
    m = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", manifest.alias("current"))
    remote = m.select(F.col("p_partkey").alias("other"), "p_brand", "p_size", F.when(F.col("p_partkey") % 5 != 0, F.col("current")).alias("remote"))
    return m.join(remote, ["p_brand", "p_size"]).select("p_partkey", "other", S.same_manifest("current", "remote").alias("same"))


@query("SELECT s_nationkey AS bundle, 'sha256:' || sha256(string_agg(s_name || chr(0) || s_suppkey, '' ORDER BY s_name)) AS source_id FROM supplier GROUP BY 1")
def source_fingerprints(spark, sf_dir):
    files = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("bundle"), F.col("s_name").alias("path"), F.encode(F.col("s_suppkey").cast("string"), "utf-8").alias("content"))
    return S.fingerprint(files)


# Workflow ----------------------------------------------------------------------------------------------------------------


@query(
    sql(
        """SELECT image_id, slab, set_index, label + coalesce(before, 0) AS label, voxels FROM parts JOIN
        (SELECT image_id, slab, CAST(sum(top) OVER (PARTITION BY image_id ORDER BY slab ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT) AS before FROM (SELECT image_id, slab, max(label) AS top FROM parts GROUP BY 1, 2)) USING (image_id, slab)""",
        base=MATCH.rstrip()
        + """,
parts AS (SELECT image_id, 0 AS slab, set_index, new_id AS label, count(*) AS voxels FROM (SELECT image_id, 1 AS set_index, new_id, y, x FROM nc UNION ALL SELECT image_id, 2, new_id, y, x FROM nn
    UNION ALL SELECT image_id, 3, new_id, y, x FROM nc WHERE NOT EXISTS (SELECT 1 FROM nn WHERE nn.image_id = nc.image_id AND nn.y = nc.y AND nn.x = nc.x)) GROUP BY 1, 3, 4
    UNION ALL SELECT image_id, 1, 4, label, count(*) FROM labels WHERE set_index = 4 GROUP BY 1, 4)
""",
    )
)
def multistep_workflow(spark, sf_dir):
    from .workflow import multistep

    labels = raster.labels(spark, sf_dir)
    out = multistep(postprocess.of_set(labels, 1), postprocess.of_set(labels, 2), [postprocess.of_set(labels, 4)], SIDE, SIDE, remove_border=False)
    return out.groupBy("image_id", "slab", "set_index", "label").agg(F.count("*").alias("voxels"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'spots' WHEN 1 THEN 'foci' WHEN 2 THEN 'bacteria' ELSE 'spots' END AS label, CASE p_partkey % 4 WHEN 2 THEN 'cells' WHEN 1 THEN 'foci' ELSE 'spots' END AS target FROM part")
def foci_dispatch(spark, sf_dir):
    from .workflow import foci_kind

    k = F.col("p_partkey") % 4
    model = F.element_at(F.array(*map(F.lit, ("spotiflow:general", "stardist:SD_Foci_Finn", "cellpose3:bact_phase_cp3", "spotiflow:hybiss"))), (k + 1).cast("int"))
    kind = foci_kind(model)
    return table(spark, sf_dir, "part").select("p_partkey", kind["label"].alias("label"), kind["target"].alias("target"))


_SURFACE = ", ".join(f"({k}, {a!r}::DOUBLE)" for k, a in enumerate(geometry.surface_table((1.5, 0.5, 0.25))))
SURFACES = VOLUMES + f""",
states AS (SELECT image_id, label, z + dz AS z, y + dy AS y, x + dx AS x, sum(w) AS state FROM vox, (VALUES {', '.join(f'({-(k >> 2 & 1)}, {-(k >> 1 & 1)}, {-(k & 1)}, {1 << k})' for k in range(8))}) m(dz, dy, dx, w) GROUP BY ALL)"""


@query(sql(f"SELECT image_id, 0 AS t, 1 AS set_index, label, CASE WHEN sz IS NOT NULL THEN sum(a) END AS surface_area_um2, sum(bit_count(CAST(state AS INTEGER))) / 8 * sz * sy * sx AS volume_um3 FROM states JOIN (VALUES {_SURFACE}) v(state, a) USING (state) JOIN img USING (image_id) GROUP BY image_id, label, sz, sy, sx", "surface_area_um2", "volume_um3", base=with_more(SURFACES)))
def surface_areas(spark, sf_dir):
    images = raster.images(spark, sf_dir)
    scales = images.select("image_id", *(F.col(f"scale_{c}").alias(f"s{c}") for c in "zyx"))
    return geometry.surfaces(raster.volumes(spark, sf_dir), scales)


@query(sql("SELECT image_id, z, label + coalesce(before, 0) AS label, n AS voxels FROM (SELECT image_id, z, label, count(*) AS n FROM vox GROUP BY 1, 2, 3) JOIN (SELECT image_id, z, CAST(sum(top) OVER (PARTITION BY image_id ORDER BY z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT) AS before FROM (SELECT image_id, z, max(label) AS top FROM vox GROUP BY 1, 2)) USING (image_id, z)", base=with_more(VOLUMES)))
def plane_ids(spark, sf_dir):
    out = postprocess.offset_ids(raster.volumes(spark, sf_dir), ["image_id"], ["z"])
    return out.groupBy("image_id", "z", "label").agg(F.count("*").alias("voxels"))


@query(sql("SELECT image_id, label, count(*) AS voxel_count, 3 AS spatial_dimensions, CAST(NULL AS DOUBLE) AS area_px2, CAST(count(*) AS DOUBLE) AS volume_voxels, avg(z) AS centroid_z_px, min(z) AS bbox_min_z_px, max(z) + 1 AS bbox_max_z_px FROM vox GROUP BY 1, 2", "centroid_z_px", base=with_more(VOLUMES)))
def volume_objects(spark, sf_dir):
    out = regions.objects(raster.volumes(spark, sf_dir), raster.images(spark, sf_dir))
    return out.select("image_id", "label", "voxel_count", "spatial_dimensions", "area_px2", "volume_voxels", "centroid_z_px", "bbox_min_z_px", "bbox_max_z_px")


@query("SELECT p_partkey, greatest(1, CAST(round_even(p_size * least(1.0::DOUBLE, (p_partkey % 5 + 1) * 0.125::DOUBLE / 0.5::DOUBLE), 0) AS INTEGER)) AS size FROM part")
def rescaled_sizes(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", S.rescaled_size("p_size", (F.col("p_partkey") % 5 + 1) * 0.125).alias("size"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 > 0 AND p_partkey % 3 <> p_partkey % 2 + 1 THEN [p_partkey % 2, p_partkey % 3 - 1] ELSE [p_partkey % 2] END AS channels FROM part")
def channel_selection(spark, sf_dir):
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select("p_partkey", S.selected_channels(k % 2 + 1, k % 3, F.lit(3)).alias("channels"))
