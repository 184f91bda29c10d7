"""The models that a segmentation step may name, and the protocol of a segmenter that runs one."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import tiles

# Fixed values: (family, checkpoints, targets, dimensions, least channels).
MODELS = [
    ("cellpose3", ("cyto3", "cyto2_cp3", "tissuenet_cp3", "livecell_cp3", "yeast_PhC_cp3", "yeast_BF_cp3", "bact_phase_cp3", "bact_fluor_cp3", "deepbacs_cp3", "cyto2", "cyto", "CPx", "transformer_cp3", "neurips_cellpose_default", "neurips_cellpose_transformer", "neurips_grayscale_cyto2", "CP", "TN1", "TN2", "TN3", "LC1", "LC2", "LC3", "LC4"), ("cells",), "3d", 1),
    ("cellpose3", ("nuclei",), ("nuclei",), "3d", 1),
    ("cellpose-sam", ("cpsam_v2", "cpsam"), ("nuclei", "cells"), "3d", 1),
    ("stardist", ("SD_Nuclei_Versatile",), ("nuclei",), "2d", 1),
    ("stardist", ("SD_Foci_Aggregates", "SD_Foci_Finn"), ("foci",), "2d", 1),
    ("instanseg", ("brightfield_nuclei",), ("nuclei",), "2d", 3),
    ("instanseg", ("fluorescence_nuclei_and_cells",), ("nuclei", "cells"), "2d", 1),
    ("instanseg", ("single_channel_nuclei",), ("nuclei",), "2d", 1),
    ("spotiflow", ("general", "hybiss", "synth_complex", "fluo_live"), ("spots",), "2d", 1),
    ("spotiflow", ("synth_3d", "smfish_3d"), ("spots",), "3d", 1),
]


def models(spark: SparkSession) -> DataFrame:
    rows = [(f"{family}:{name}", family, name, list(targets), dims, least) for family, names, targets, dims, least in MODELS for name in names]
    return spark.createDataFrame(rows, "model_id string, family string, checkpoint string, targets array<string>, dimensions string, min_channels int")


def eligible(models: DataFrame, target: str, channels: int) -> DataFrame:
    return models.filter(F.array_contains("targets", target) & (F.col("min_channels") <= channels))


def cases(steps: DataFrame, models: DataFrame) -> DataFrame:
    """A benchmark case for each step (step, target, channel) and model that fits its target; the key names both."""
    fit = F.broadcast(models)  # a table of fixed size
    joined = steps.join(fit, F.array_contains(fit["targets"], steps["target"]))
    return joined.select(F.concat_ws("|", "step", F.concat(F.lit("ch"), F.col("channel").cast("string")), "model_id").alias("key"), "step", "target", "channel", "model_id")


class Segmenter(Protocol):
    """What a model backend offers: labels of one plane, or of one volume if the model sees these at once."""

    def __call__(self, values: np.ndarray) -> np.ndarray: ...


def device(asked: str, has_cuda: bool) -> str:
    """The device that a step runs on; asking for one that isn't there, or isn't known, is an error."""
    if asked not in ("auto", "cpu", "cuda"):
        raise ValueError(f"unknown device {asked!r}")
    if asked == "cuda" and not has_cuda:
        raise ValueError("CUDA was asked for and isn't there")
    return "cuda" if asked == "cuda" or (asked == "auto" and has_cuda) else "cpu"


_LOADED: dict[tuple, Segmenter] = {}


def loaded(key: tuple, make: Callable[[], Segmenter]) -> Segmenter:
    """A worker's segmenter for a model and device: loaded at its first use, kept from plane to plane and from task to task. Only
    the latest is kept, as one may take more than a GB."""
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = make()
    return _LOADED[key]


PLANE = ["image_id", "t", "z"]
# The side of a tile and its halo, and the pixel size that the model of nuclei wants.
TILE, HALO, MODEL_UM = 1024, 64, 0.5


def in_planes(pixels: DataFrame, height: int, width: int) -> DataFrame:
    """Blocks of one channel's pixels; those without a timepoint or a plane are of the first."""
    rows = pixels.withColumns({c: F.lit(0).cast(k) for c, k in (("t", "int"), ("z", "long")) if c not in pixels.columns})
    return tiles.to_blocks(rows.select(*PLANE, "y", "x", "value"), height, width)


def label_rows(blocks: DataFrame) -> DataFrame:
    """What isn't background of label blocks."""
    return tiles.to_pixels(blocks, "label", "long", sparse=True)


def labeller(model: str, make: Callable[[], Segmenter], on: str) -> Callable[[np.ndarray, dict], np.ndarray]:
    def work(values: np.ndarray, row: dict | None = None) -> np.ndarray:
        labels = np.asarray(loaded((model, on), make)(values))
        if labels.shape != values.shape:
            raise ValueError(f"{model} gave labels of shape {labels.shape} for values of {values.shape}")
        return labels.astype("<i8")

    return work


def segmented_planes(blocks: DataFrame, model: str, make: Callable[[], Segmenter], on: str = "cpu") -> DataFrame:
    """Labels (plane's key, y, x, label) of planes of blocks, plane by plane; make() is called once for each worker."""
    whole = tiles.retiled(blocks, None).drop(*tiles.CORE)
    return label_rows(tiles.mapped(whole, labeller(model, make, on)))


def segmented_tiles(blocks: DataFrame, model: str, make: Callable[[], Segmenter], tile: int = TILE, halo: int = HALO, on: str = "cpu") -> DataFrame:
    """As segmented_planes(), but each tile by itself with a halo of pixels around it: a label counts where it lies in the tile's
    core, and ids run over the tiles in reading order."""
    from ..operators.postprocess import offset_ids

    cores = tiles.on_tiles(blocks, tile, halo, labeller(model, make, on))
    placed = cores.withColumns({"tile_y": F.floor(F.col("y") / tile), "tile_x": F.floor(F.col("x") / tile)})
    return offset_ids(label_rows(placed), tiles.plane_key(blocks), ["tile_y", "tile_x"]).drop("tile_y", "tile_x")


def detected_polygons(blocks: DataFrame, model: str, make: Callable[[], Segmenter], tile: int = TILE, halo: int = HALO, on: str = "cpu") -> DataFrame:
    """The polygons (plane's key, point, py, px, prob, dist) that a segmenter finds tile by tile: those with their centre in a tile's
    core, numbered over a plane's tiles in reading order. A segmenter that can't give polygons is an error."""
    from ..operators.polygons import in_cores

    keys = tiles.plane_key(blocks)
    more = {"tile_y": "long", "tile_x": "long", "k": "long", "py": "double", "px": "double", "prob": "double", "dist": "array<double>"}

    def find(row):
        segmenter = loaded((model, on), make)
        if not hasattr(segmenter, "polygons"):
            raise RuntimeError(f"{model} gives no polygons; without smooth_stardist_labels labels are restored by the nearest pixel")
        for k, (y, x, prob, dist) in enumerate(segmenter.polygons(tiles.values_of(row))):
            yield {n: row[n] for n in keys} | {"tile_y": row["core_y"] // tile, "tile_x": row["core_x"] // tile, "k": k, "py": float(y) + row["y"], "px": float(x) + row["x"], "prob": float(prob), "dist": [float(d) for d in dist]}

    found = in_cores(tiles.each(tiles.retiled(blocks, tile, halo), find, tiles.declared(blocks, keys, more)), tile)
    order = Window.partitionBy(*keys).orderBy("tile_y", "tile_x", "k")
    return found.select(*keys, F.row_number().over(order).cast("long").alias("point"), "py", "px", "prob", "dist")


def segmented_scaled(blocks: DataFrame, model: str, make: Callable[[], Segmenter], height: int, width: int, scale_y: float | None, scale_x: float | None, target_um: float = MODEL_UM, on: str = "cpu", smooth: bool = False) -> DataFrame:
    """As segmented_tiles(), but at the model's own pixel size, never finer than the image's: planes are brought to it with
    antialiasing, and labels back to the image's size by the nearest, or with `smooth` drawn there anew from the model's polygons. An
    image without scales of y and x is an error."""
    from ..operators.polygons import polygons_to_labels
    from ..operators.stencil import resized_nearest, resized_planes

    if not (scale_y and scale_x):
        raise ValueError(f"{model} needs the image's scales of y and x")
    sizes = [max(1, int(np.rint(n * min(1.0, s / target_um)))) for n, s in ((height, scale_y), (width, scale_x))]
    if sizes == [height, width]:
        return segmented_tiles(blocks, model, make, on=on)
    small = resized_planes(blocks, *sizes)
    if smooth:
        return polygons_to_labels(detected_polygons(small, model, make, on=on), height, width, height / sizes[0], width / sizes[1])
    return resized_nearest(segmented_tiles(small, model, make, on=on), *sizes, height, width)


def segmented_volumes(blocks: DataFrame, model: str, make: Callable[[], Segmenter], on: str = "cpu") -> DataFrame:
    """As segmented_planes(), but the model sees all planes of an image's timepoint at once, as an array of z, y and x."""
    keys = tiles.plane_key(blocks)
    of = [k for k in keys if k != "z"]
    planes = tiles.retiled(blocks, None).groupBy(*of, "size_y", "size_x", "dtype").agg(F.array_sort(F.collect_list(F.struct("z", "data"))).alias("planes"))
    work = labeller(model, make, on)

    def label(row):
        sides = (row["size_y"], row["size_x"])
        volume = work(np.stack([np.frombuffer(p["data"], row["dtype"]).reshape(sides) for p in row["planes"]]))
        for p, plane in zip(row["planes"], volume, strict=True):
            yield {k: row[k] for k in of} | {"z": p["z"], "y": 0, "x": 0, "height": sides[0], "width": sides[1], "size_y": sides[0], "size_x": sides[1], "dtype": "<i8", "data": plane.tobytes()}

    return label_rows(tiles.each(planes, label, tiles.declared(blocks, keys, tiles.OWN)))


def segmented(pixels: DataFrame, model: str, make: Callable[[], Segmenter], height: int, width: int, on: str = "cpu") -> DataFrame:
    """segmented_planes() of pixel rows."""
    return segmented_planes(in_planes(pixels, height, width), model, make, on)


def segmented_in_tiles(pixels: DataFrame, model: str, make: Callable[[], Segmenter], height: int, width: int, tile: int = TILE, halo: int = HALO, on: str = "cpu") -> DataFrame:
    return segmented_tiles(in_planes(pixels, height, width), model, make, tile, halo, on)


def segmented_at_scale(pixels: DataFrame, model: str, make: Callable[[], Segmenter], height: int, width: int, scale_y: float, scale_x: float, target_um: float = MODEL_UM, on: str = "cpu") -> DataFrame:
    return segmented_scaled(in_planes(pixels, height, width), model, make, height, width, scale_y, scale_x, target_um, on)
