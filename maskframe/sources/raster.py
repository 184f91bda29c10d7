"""A deterministic raster from the star-schema tables: a carrier on which the operators run at any scale.

Every supplier is an image of SIDE by SIDE pixels on a plate whose rows are regions and columns nations. All arithmetic
is on integers. Labels are sparse: a row for each voxel of an object, none for background. Tables are dealt by image, so what groups or
meets by image, or by more than that, needs no further shuffle, and a task holds so many images however many there are.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SIDE = 32
#: Images whose pixels one task makes and holds.
IMAGES_AT_ONCE = 128
#: Label sets by index.
SETS = {1: "labels_cells", 2: "labels_nuclei", 3: "labels_cytoplasm", 4: "labels_spots_channel_1"}
CHANNELS = {1: "Signal", 2: "Reference"}
SPOT_LEVEL = 100
#: What identifies an object.
OBJECT = ["image_id", "t", "set_index", "label"]
VOXEL = ["image_id", "t", "z", "y", "x"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(rows: DataFrame, sf_dir: str) -> DataFrame:
    """The rows in partitions by image_id, IMAGES_AT_ONCE images each. Their number follows from the images', not from the file that names
    them, which one task reads, nor from the session's number of shuffle partitions. The session is told that tables may meet by a part
    of the columns that they are joined on."""
    spark = rows.sparkSession
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return rows.repartition(max(1, math.ceil(table(spark, sf_dir, "supplier").count() / IMAGES_AT_ONCE)), "image_id")


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """image_id, plate position and scales; every seventh image has no calibration, every fifth none of z."""
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    scale = lambda v: F.when(F.col("s_suppkey") % 7 != 0, F.lit(v))
    joined = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey).join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
    rows = joined.select(F.col("s_suppkey").cast("long").alias("image_id"), F.col("r_name").alias("plate_row"), F.col("n_name").alias("plate_column"), F.col("s_suppkey").cast("string").alias("field_index"), F.when(F.col("s_suppkey") % 5 != 0, scale(1.5)).alias("scale_z"), scale(0.5).alias("scale_y"), scale(0.25).alias("scale_x"))
    return dealt(rows, sf_dir)


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pixel position of every image, made by a generator, not by a join."""
    ids = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("long").alias("image_id"))
    side = F.sequence(F.lit(0).cast("long"), F.lit(SIDE - 1).cast("long"))
    return dealt(ids, sf_dir).withColumn("y", F.explode(side)).withColumn("x", F.explode(side))


def signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel 1 where it isn't 0: quantities summed at a position that the keys give."""
    at = lambda c: (F.col(c) % SIDE).cast("long")
    items = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("long").alias("image_id"), at("l_orderkey").alias("y"), at("l_partkey").alias("x"), "l_quantity")
    return dealt(items, sf_dir).groupBy("image_id", "y", "x").agg(F.sum("l_quantity").cast("long").alias("v"))


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """image_id, t, channel_index, z, y, x, value."""
    both = grid(spark, sf_dir).join(signal(spark, sf_dir).hint("merge"), ["image_id", "y", "x"], "left")
    values = F.explode(F.array(F.struct(F.lit(1).alias("channel_index"), F.coalesce("v", F.lit(0)).cast("double").alias("value")), F.struct(F.lit(2).alias("channel_index"), (F.col("y") * SIDE + F.col("x")).cast("double").alias("value"))))
    return both.select("image_id", "y", "x", values.alias("c")).select("image_id", F.lit(0).alias("t"), "c.channel_index", F.lit(0).cast("long").alias("z"), "y", "x", "c.value")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """image_id, t, set_index, label, z, y, x of cells, nuclei and cytoplasm (from the grid) and spots (from the signal)."""
    y, x, i = F.col("y"), F.col("x"), F.col("image_id")
    block = lambda v: F.floor(v / 8)
    cell = F.when((y % 8).between(1, 6) & (x % 8).between(1, 5 + i % 2), block(y) * 4 + block(x) + 1)
    ny, nx = y + i % 3, x + i % 5
    nucleus = F.when((ny % 8).between(3, 5) & (nx % 8).between(2, 4), block(ny) * 5 + block(nx) + 1)
    sets = F.array(*(F.struct(F.lit(k).alias("set_index"), v.cast("long").alias("label")) for k, v in ((1, cell), (2, nucleus), (3, F.when(nucleus.isNull(), cell)))))
    masks = grid(spark, sf_dir).select("image_id", "y", "x", F.explode(sets).alias("s")).select("image_id", F.col("s.set_index"), F.col("s.label"), "y", "x").filter("label is not null")
    spots = signal(spark, sf_dir).filter(F.col("v") >= SPOT_LEVEL).select("image_id", F.lit(4).alias("set_index"), (y * SIDE + x + 1).alias("label"), "y", "x")
    return masks.unionByName(spots).select("image_id", F.lit(0).alias("t"), "set_index", "label", F.lit(0).cast("long").alias("z"), "y", "x")


def volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects over three planes, with a hollow middle, as labels."""
    planes = grid(spark, sf_dir).withColumn("z", F.explode(F.array(*(F.lit(k).cast("long") for k in range(3)))))
    y, x, z = F.col("y") % 16, F.col("x") % 16, F.col("z")
    solid = y.between(1, 10 + F.col("image_id") % 3) & x.between(2, 9) & ~((z == 1) & y.between(4, 6) & x.between(4, 6))
    return planes.filter(solid).select("image_id", F.lit(0).alias("t"), F.lit(1).alias("set_index"), (F.floor(F.col("y") / 16) * 2 + F.floor(F.col("x") / 16) + 1).cast("long").alias("label"), "z", "y", "x")


def volume_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three label sets in space: the volumes, blocks that cut into them from the second plane on, and flat ones in the middle."""
    y, x, z = F.col("y"), F.col("x"), F.col("z")
    planes = grid(spark, sf_dir).withColumn("z", F.explode(F.array(*(F.lit(k).cast("long") for k in range(3)))))
    number = (F.floor(y / 16) * 2 + F.floor(x / 16) + 1).cast("long")
    blocks = planes.filter((y % 16).between(5, 12) & (x % 16).between(6, 13 + F.col("image_id") % 2) & (z >= 1)).select("image_id", F.lit(0).alias("t"), F.lit(2).alias("set_index"), (number + 10).alias("label"), "z", "y", "x")
    plates = planes.filter((y % 8).between(2, 5) & (x % 8).between(1, 6) & (z == 1)).select("image_id", F.lit(0).alias("t"), F.lit(3).alias("set_index"), (F.floor(y / 8) * 4 + F.floor(x / 8) + 1).cast("long").alias("label"), "z", "y", "x")
    return volumes(spark, sf_dir).unionByName(blocks).unionByName(plates)
