"""Intensity statistics of objects by channel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.raster import OBJECT, VOXEL


def intensities(labels: DataFrame, pixels: DataFrame) -> DataFrame:
    """Population variance, exact interpolated percentiles and the median absolute deviation of each object and channel.

    Labels and pixels meet by position once and combine to counts by value, so a task holds an object's distinct values, not
    its voxels; the deviations come from the same values, which stay where they are."""
    keys = [*OBJECT, "channel_index"]
    counts = labels.join(pixels.hint("merge"), VOXEL).groupBy(*keys, "value").agg(F.count("*").alias("k"))
    names = ["intensity_p10", "intensity_p25", "intensity_median", "intensity_p75", "intensity_p90"]
    once = counts.groupBy(*keys).agg(
        F.sum("k").alias("sample_count"),
        F.sum(F.col("value") * F.col("k")).alias("intensity_sum"),
        F.min("value").alias("intensity_min"),
        F.max("value").alias("intensity_max"),
        F.percentile("value", F.array(*map(F.lit, (0.1, 0.25, 0.5, 0.75, 0.9))), F.col("k")).alias("p"),
        F.collect_list(F.struct("value", "k")).alias("values"),
    )
    once = once.withColumns({"intensity_mean": F.col("intensity_sum") / F.col("sample_count"), **{n: F.col("p")[i] for i, n in enumerate(names)}}).drop("p")
    kept = [c for c in once.columns if c not in (*keys, "values")]
    # the rows are by key already, so this second sum needs no shuffle
    away = once.select(*keys, *kept, F.explode("values").alias("v")).groupBy(*keys).agg(
        *(F.first(c).alias(c) for c in kept),
        F.sum(F.col("v.k") * F.pow(F.col("v.value") - F.col("intensity_mean"), 2)).alias("squares"),
        F.percentile(F.abs(F.col("v.value") - F.col("intensity_median")), F.lit(0.5), F.col("v.k")).alias("intensity_mad"),
    )
    out = away.withColumn("intensity_variance", F.col("squares") / F.col("sample_count"))
    out = out.withColumn("intensity_stddev", F.sqrt("intensity_variance"))
    return out.select(*keys, "sample_count", "intensity_sum", "intensity_mean", "intensity_variance", "intensity_stddev", "intensity_min", "intensity_max", "intensity_median", "intensity_mad", "intensity_p10", "intensity_p25", "intensity_p75", "intensity_p90", (F.col("intensity_stddev") / F.nullif("intensity_mean", F.lit(0.0))).alias("coefficient_of_variation"))
