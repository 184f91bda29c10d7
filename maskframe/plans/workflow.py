"""The steps of a run put together over label tables, and exports of its measurements."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import models
from ..operators import postprocess, spots, tiles
from ..sources import chunks, zarr
from ..sources.raster import VOXEL
from ..sources.workspace import written
from . import measurements
from .settings import DIMENSIONS, SKIP, Settings
from .snapshots import Snapshots


def foci_kind(model: Column) -> Column:
    """(target, label) of a foci model; any other model is an error."""
    kind = lambda target, label: F.struct(F.lit(target).alias("target"), F.lit(label).alias("label"))
    known = F.when(model.startswith("spotiflow:"), kind("spots", "spots")).when(model.contains("SD_Foci"), kind("foci", "foci")).when(model.startswith("cellpose3:") & model.contains("bact"), kind("cells", "bacteria"))
    return known.otherwise(F.raise_error(F.concat(F.lit("not a foci model: "), model)).cast("struct<target:string,label:string>"))


def multistep(cells: DataFrame | None, nuclei: DataFrame | None, foci: list[DataFrame], height: int, width: int, remove_border: bool = True, seeds: DataFrame | None = None) -> DataFrame:
    """Labels (image_id, t, z, y, x, set_index, slab, label) of all steps, with ids unique over an image's timepoints and steps.

    Cells and nuclei (or, for want of them, the seeds that cells grew from) are matched and share ids; cells alone lose those
    at the border, nuclei alone don't. Foci of slot k follow as set 3 + k. Compartments are one slab, each slot another."""
    partners = nuclei if nuclei is not None else seeds
    edge = lambda df: postprocess.without_border(df.withColumn("set_index", F.lit(1)), height, width).drop("set_index") if remove_border else df
    parts: list[DataFrame] = []
    if cells is not None and partners is not None:
        both = edge(cells).withColumn("set_index", F.lit(1)).unionByName(partners.withColumn("set_index", F.lit(2)))
        parts.append(postprocess.matched_labels(both).withColumn("slab", F.lit(0)))
    elif cells is not None:
        parts.append(edge(cells).withColumns({"set_index": F.lit(1), "slab": F.lit(0)}))
    elif nuclei is not None:
        parts.append(nuclei.withColumns({"set_index": F.lit(2), "slab": F.lit(0)}))
    parts += [f.withColumns({"set_index": F.lit(4 + k), "slab": F.lit(1 + k)}) for k, f in enumerate(foci)]
    if not parts:
        raise ValueError("no step made labels")
    whole = parts[0].select(*VOXEL, "set_index", "slab", "label")
    for p in parts[1:]:
        whole = whole.unionByName(p.select(*VOXEL, "set_index", "slab", "label"))
    return postprocess.offset_ids(whole, ["image_id"], ["t", "slab"])


#: A model's name -> what makes its segmenter in a worker.
Backends = Callable[[str], Callable[[], models.Segmenter]]


def segmentation(settings: Settings, of: Callable[[int], DataFrame], about: dict, backends: Backends) -> tuple[DataFrame, dict[int, str], list[int]]:
    """The labels that the settings' steps make of images, the names of their sets, and the sets that hold places only. of(channel)
    has a channel's blocks (image_id, t, z, ...); all images have the sides and scales that `about` says.

    Cells are segmented or grown from seeds; nuclei and up to four kinds of foci follow; spots are refined if the settings ask for it;
    then all are matched and numbered. A model of volumes sees whole ones unless the settings keep it to planes; others go plane by
    plane, star-convex ones tile by tile, and the one of nuclei of any microscope at its own pixel size."""
    settings.check(about["size"]["c"])
    height, width, deep = about["size"]["y"], about["size"]["x"], about["size"]["z"] > 1 and settings.dimension_mode != "2d"
    scale_y, scale_x = (about["scales"].get(a) for a in "yx")
    on = models.device(settings.device, has_cuda=False)

    def run(model: str, channel: int) -> DataFrame:
        """What a model finds, written: several steps read it, and it is to run once."""
        return written(found_by(model, channel))

    def found_by(model: str, channel: int) -> DataFrame:
        if deep and DIMENSIONS[model] == "3d":
            return models.segmented_volumes(of(channel), model, backends(model), on)
        if model == "stardist:SD_Nuclei_Versatile":
            found = models.segmented_scaled(of(channel), model, backends(model), height, width, scale_y, scale_x, on=on, smooth=settings.smooth_stardist_labels)
        elif model.startswith("stardist:"):
            found = models.segmented_tiles(of(channel), model, backends(model), on=on)
        else:
            found = models.segmented_planes(of(channel), model, backends(model), on)
        # a label is one plane's: ids run over the planes
        return postprocess.offset_ids(found, ["image_id", "t"], ["z"]) if about["size"]["z"] > 1 else found

    cells = nuclei = seeds = None
    if settings.seed_model:
        seeds = run(settings.seed_model, settings.seed_channel)
        cells = postprocess.expanded(seeds, settings.cell_expansion_distance, scale_y, scale_x, height, width)
    elif settings.cell_model != SKIP:
        cells = run(settings.cell_model, settings.cell_channel)
    if settings.nucleus_model != SKIP:
        nuclei = run(settings.nucleus_model, settings.nucleus_channel)
    foci, names, places = [], {1: "labels_cells", 2: "labels_nuclei", 3: "labels_cytoplasm"}, []
    for k, (_, model, channel) in enumerate(settings.foci):
        kind = next(label for start, label in (("spotiflow:", "spots"), ("stardist:SD_Foci", "foci"), ("cellpose3:", "bacteria")) if model.startswith(start))
        found = run(model, channel)
        if kind == "spots" and settings.spotiflow_local_refinement:
            if not (scale_y and scale_x):
                raise ValueError("refinement needs the image's scales of y and x")
            points = found.select("image_id", "t", "z", F.col("label").alias("point"), F.col("y").cast("double").alias("py"), F.col("x").cast("double").alias("px"))
            seen = tiles.to_pixels(of(channel)).select("image_id", "t", "z", "y", "x", "value")
            found = spots.masks(spots.outcomes(seen, points, scale_y, scale_x, height, width, native_3d=deep and DIMENSIONS[model] == "3d"))
        elif kind == "spots":
            places.append(4 + k)
        foci.append(found)
        names[4 + k] = f"labels_{kind}_channel_{channel}"
    labels = multistep(cells, nuclei, foci, height, width, settings.remove_border_cells, seeds)
    return labels.drop("slab"), names, places


#: What images must share to be segmented together.
FORM = [*(f"size_{a}" for a in zarr.AXES), *(f"scale_{a}" for a in zarr.AXES), "dtype"]


def listed_images(spark, store: str, work: str) -> DataFrame:
    """The images of a store with their ids (from 1, in order of their paths), places on the plate, forms and channels; written, as
    ids come from ranges of paths that are ordered each by itself."""
    places = zarr.fields(spark, store)
    if not zarr.is_plate(spark, store):
        places = places.withColumns({"plate_row": F.lit(None).cast("string"), "plate_column": F.lit(None).cast("string"), "field": F.lit("0")})
    ranged = places.repartitionByRange("image_path").withColumn("part", F.spark_partition_id().cast("long"))
    ranged.write.mode("overwrite").parquet(f"{work}/places")
    numbered = measurements.numbered(spark.read.parquet(f"{work}/places"), ["part"], ["image_path"], "image_id")
    images = numbered.join(chunks.forms(spark, store, places), "image_path").select("image_id", "image_path", F.col("image_path").alias("resource_path"), "plate_row", "plate_column", F.col("field").alias("field_index"), *FORM, "channels")
    images.write.mode("overwrite").parquet(f"{work}/images")
    return spark.read.parquet(f"{work}/images")


def run(spark, store: str, out: str, settings: Settings, backends: Backends, tables: str | None = None) -> None:
    """A store from pixels to labels and tables: every image, or every field of a plate, is segmented by the settings; the labels are
    written to `out` (a plate as a plate; an image in the native layout; with the setting for it as channels behind the image's own)
    and measured into the folder `tables`. Images may differ in sides and scales: those of one form go together. Labels are
    written once, beside the output, so that writing and measuring read the same."""
    plate, work = zarr.is_plate(spark, store), f"{out.rstrip('/')}.labels"
    files = zarr.Files(spark, work)
    try:
        images = listed_images(spark, store, work)
        ids = images.select("image_id", "image_path")
        blocks = chunks.read_blocks(spark, store)
        forms = images.select(*FORM).distinct().collect()
        made, names, points = None, {}, []
        for form in forms:
            same = F.lit(True)
            for c in FORM:
                same = same & F.col(c).eqNullSafe(F.lit(form[c]))
            some = images.filter(same).select("image_id", "image_path")
            only = {} if len(forms) == 1 else {"images": [r.image_path for r in some.select("image_path").toLocalIterator()]}

            def of(channel, some=some, only=only):
                own = chunks.read_blocks(spark, store, c=[channel - 1], **only).drop("c")
                return own.join(some, "image_path").drop("image_path").withColumn("t", F.col("t").cast("int"))

            about = {"size": {a: form[f"size_{a}"] for a in zarr.AXES}, "scales": {a: form[f"scale_{a}"] for a in zarr.AXES if form[f"scale_{a}"] is not None}}
            part, names, points = segmentation(settings, of, about, backends)
            made = part if made is None else made.unionByName(part)
        made.write.mode("overwrite").parquet(f"{work}/labels")
        labels = spark.read.parquet(f"{work}/labels")
        if settings.write_ome_zarr_labels:
            shown = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))[F.col("set_index")]
            named = labels.join(ids, "image_id").select("image_path", shown.alias("name"), F.col("t").cast("long").alias("t"), "z", "y", "x", "label")
            present = [names[r.set_index] for r in labels.select("set_index").distinct().orderBy("set_index").collect()]
            if plate:
                zarr.write_plate(named, ids.select("image_path"), store, out, images, [names[k] for k in sorted(names)] if settings.include_original_channels else present, original=tiles.to_pixels(blocks) if settings.include_original_channels else None)
            elif settings.include_original_channels:
                pixels, about = zarr.read_image(spark, store)
                rows = labels.withColumn("c", F.array_position(F.array(*map(F.lit, sorted(names))), F.col("set_index")) - 1)
                sets = [(names[k], None) for k in sorted(names)]
                zarr.write_image(rows.select("t", "c", "z", "y", "x", F.col("label").alias("value")), out, about["size"] | {"c": len(sets)}, sets, about["scales"], original=(pixels, about))
            else:
                zarr.write_native(named.drop("image_path"), out, store, present)
        if tables:
            known = tiles.to_pixels(blocks).join(ids, "image_path").select("image_id", F.col("t").cast("int").alias("t"), (F.col("c") + 1).cast("int").alias("channel_index"), "z", "y", "x", "value")
            measurements.published(spark, Snapshots(spark, tables), images, labels, known, names, points, channels={}, size={}, store=store, dtype="", settings=settings.values())
    finally:
        files.fs.delete(files.at(""), True)


def case_status(cases: DataFrame, results: DataFrame) -> DataFrame:
    """Each case with what became of it: skipped without a result, failed with an error, else success."""
    status = F.when(F.col("done").isNull(), "skipped").when(F.col("error").isNotNull(), "failed").otherwise("success")
    return cases.join(results.withColumn("done", F.lit(True)), "key", "left").withColumn("status", status).drop("done")


def export_database(tables: dict[str, DataFrame], path: str, rows: int = 10_000) -> None:
    """The tables as one DuckDB or SQLite file, by its ending, for use elsewhere: written beside its place in one transaction,
    `rows` rows at a time, and put there when whole. A file is one machine's; at scale read the Parquet tables."""
    ending = Path(path).suffix
    if ending not in (".duckdb", ".sqlite"):
        raise ValueError(f"unknown database format: {ending}")
    partial = Path(f"{path}.partial")
    partial.unlink(missing_ok=True)
    if ending == ".duckdb":
        import duckdb

        base = duckdb.connect(str(partial))
    else:
        import sqlite3

        base = sqlite3.connect(partial, isolation_level=None)
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}
    try:
        base.execute("BEGIN")
        for name, df in tables.items():
            base.execute(f"CREATE TABLE {name} ({', '.join(f'{c} {kinds.get(k, "TEXT")}' for c, k in df.dtypes)})")
            block = []
            for r in df.toLocalIterator():
                block.append(tuple(r))
                if len(block) == rows:
                    base.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(df.columns))})", block)
                    block = []
            if block:
                base.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(df.columns))})", block)
        base.execute("COMMIT")
        base.close()
    except BaseException:
        base.close()
        partial.unlink(missing_ok=True)
        raise
    partial.replace(path)
