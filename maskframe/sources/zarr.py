"""Image stores of Zarr version 2 with NGFF metadata: discovery, plates, scans chunk by chunk, and image and label sinks.

Metadata documents are rows of JSON, parsed with a schema; chunks are read by Spark's binaryFile source, so any store that Spark
reads will do, a chunk is a task's unit, and no array stands in one place. A chunk's name is the last part, or parts, of its path,
whatever the folders above are called.
"""

from __future__ import annotations

import json
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import tiles
from .chunks import read_blocks, registered
from .codecs import decoder

AXES = "tczyx"
#: What is read of an attributes document.
ATTRIBUTES = "plate struct<wells:array<struct<path:string>>>, well struct<images:array<struct<path:string>>>, multiscales array<struct<version:string>>"
# The side of a chunk, the least side that has a next level, and the most levels.
CHUNK, LEAST_SIDE, MOST_LEVELS = 512, 512, 5


class Files:
    """Small reads and writes through Hadoop's file systems."""

    def __init__(self, spark: SparkSession, base: str):
        jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
        self.path, self.io, self.base = jvm.org.apache.hadoop.fs.Path, jvm.org.apache.commons.io.IOUtils, base.rstrip("/")
        self.fs = self.path(self.base).getFileSystem(conf)

    def at(self, name: str):
        return self.path(f"{self.base}/{name}" if name else self.base)

    def text(self, name: str) -> str | None:
        """A file's text; None if there is no such file."""
        where = self.at(name)
        if not self.fs.exists(where):
            return None
        stream = self.fs.open(where)
        try:
            return bytes(self.io.toByteArray(stream)).decode(errors="replace")
        finally:
            stream.close()

    def attributes(self, name: str, file: str = ".zattrs") -> dict | None:
        """A JSON file's object; None if there is none or it can't be parsed."""
        try:
            return json.loads(self.text(f"{name}/{file}" if name else file) or "null")
        except ValueError:
            return None

    def children(self, name: str = "") -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.at(name)))

    def write(self, name: str, data: bytes) -> None:
        stream = self.fs.create(self.at(name), True)
        stream.write(bytearray(data))
        stream.close()

    def write_json(self, name: str, document: dict) -> None:
        self.write(name, json.dumps(document).encode())


# Discovery ---------------------------------------------------------------------------------------------------------------


def documents(spark: SparkSession, base: str, folders: list[str]) -> DataFrame:
    """(name, a): the attributes of those folders under base that have a document of them; null where it isn't JSON. Spark's file
    sources pass over names with a leading dot, so the driver reads these small files."""
    files = Files(spark, base)
    rows = [(f, text) for f in folders if (text := files.text(f"{f}/.zattrs" if f else ".zattrs")) is not None]
    return spark.createDataFrame(rows, "name string, value string").select("name", F.from_json("value", ATTRIBUTES).alias("a"))


IS_STORE = "a.plate is not null or size(a.multiscales) > 0"


def discover(spark: SparkSession, folder: str) -> list[str]:
    """The folder if it is a store, else its stores in order of name. A store is named *.zarr and has a plate or multiscales."""
    base = folder.rstrip("/")
    named = lambda n: n.lower().endswith(".zarr")
    if named(base) and not documents(spark, base, [""]).filter(IS_STORE).isEmpty():
        return [base]
    below = [n for n in Files(spark, base).children() if named(n)]
    return [f"{base}/{r.name}" for r in documents(spark, base, below).filter(IS_STORE).orderBy("name").collect()]


def is_plate(spark: SparkSession, store: str) -> bool:
    return not documents(spark, store.rstrip("/"), [""]).filter("a.plate is not null").isEmpty()


def first_store(names: DataFrame) -> DataFrame:
    """The first by name without regard to case."""
    return names.orderBy(F.lower("name"), "name").limit(1)


def fields(spark: SparkSession, store: str) -> DataFrame:
    """(store, image_path, plate_row, plate_column, field): one row without a plate, else a row for each field of each well.
    Wells without a path are left out; a plate without fields is an error."""
    base = store.rstrip("/")
    schema = "store string, image_path string, plate_row string, plate_column string, field string"
    if not is_plate(spark, base):
        return spark.createDataFrame([(base, "", None, None, None)], schema)
    path = F.btrim(F.col("w.path"), F.lit("/"))
    wells = [r.well for r in documents(spark, base, [""]).select(F.explode("a.plate.wells").alias("w")).select(path.alias("well")).filter("well <> ''").distinct().orderBy("well").collect()]
    images = documents(spark, base, wells).select(F.col("name").alias("well"), F.explode("a.well.images").alias("w"))
    row, column = F.split("well", "/", 2)[0], F.coalesce(F.get(F.split("well", "/", 2), F.lit(1)), F.lit(""))
    found = images.select(F.lit(base).alias("store"), F.concat_ws("/", "well", path).alias("image_path"), row.alias("plate_row"), column.alias("plate_column"), path.alias("field"))
    if found.isEmpty():
        raise ValueError(f"plate without fields: {store}")
    return found


# Reading -----------------------------------------------------------------------------------------------------------------

#: Axes that an array of so many dimensions has if its metadata names none.
USUAL = {2: "yx", 3: "zyx", 4: "czyx", 5: "tczyx"}


def axis_names(multiscale: dict, ndim: int) -> list[str]:
    """The named axes; the usual ones of so many dimensions if none are named, or another number of them."""
    given = [(a["name"] if isinstance(a, dict) and "name" in a else str(a)).lower() for a in multiscale.get("axes") or ()]
    if len(given) != ndim:
        if ndim not in USUAL:
            raise ValueError(f"no axes for {ndim} dimensions")
        given = [*USUAL[ndim]]
    if any(a not in AXES for a in given) or len({*given}) < ndim:
        raise ValueError(f"axes must be different ones of {', '.join(AXES)}: {given}")
    return given


def axis_scales(multiscale: dict, axes: list[str]) -> dict[str, float]:
    """By axis, from the finest level's scale; none if there is no scale, or one of another length."""
    steps = multiscale["datasets"][0].get("coordinateTransformations") or []
    scale = [s["scale"] for s in steps if s.get("type") == "scale"][:1]
    return {a: float(v) for a, v in zip(axes, scale[0], strict=True)} if scale and len(scale[0]) == len(axes) else {}


def channel_names(attributes: dict, count: int) -> list[tuple[str, str | None]]:
    """(name, colour) of each channel; one without a name is called by its number."""
    known = dict(enumerate((attributes.get("omero") or {}).get("channels") or []))
    return [(str(known.get(i, {}).get("label") or f"Channel {i + 1}"), known.get(i, {}).get("color")) for i in range(count)]


class Array:
    """What the finest level of an image says of itself, and its chunks' decoding."""

    def __init__(self, files: Files, image_path: str):
        attributes = files.attributes(image_path) or {}
        if not attributes.get("multiscales"):
            raise ValueError(f"no multiscales metadata at {files.base}/{image_path}")
        multiscale = attributes["multiscales"][0]
        self.level = multiscale["datasets"][0]["path"]
        array = files.attributes("/".join(p for p in (image_path, self.level) if p), ".zarray")
        if array is None or array.get("filters"):
            raise ValueError(f"not a plain array: {files.base}/{image_path}/{self.level}")
        self.shape, self.chunks, self.dtype = array["shape"], array["chunks"], np.dtype(array["dtype"])
        self.order, self.compressor, self.mark = array.get("order", "C"), array.get("compressor"), array.get("dimension_separator", ".")
        self.fill = array.get("fill_value") or 0
        self.axes = axis_names(multiscale, len(self.shape))
        self.grid = [math.ceil(n / c) for n, c in zip(self.shape, self.chunks, strict=True)]
        size = dict.fromkeys(AXES, 1) | dict(zip(self.axes, self.shape, strict=True))
        self.about = {"size": size, "axes": self.axes, "scales": axis_scales(multiscale, self.axes), "dtype": self.dtype.newbyteorder("=").name, "channels": channel_names(attributes, size["c"])}
        decoder(self.compressor)

    def block(self, index: list[int], content: bytes | None) -> np.ndarray:
        """A chunk's values, by its numbers along the array's axes, without what lies outside the array; the fill value if it is missing."""
        low = [i * c for i, c in zip(index, self.chunks, strict=True)]
        block = np.full(self.chunks, np.array(self.fill, float).astype(self.dtype), self.dtype) if content is None else np.frombuffer(decoder(self.compressor)(content), self.dtype).reshape(self.chunks, order=self.order)
        return block[tuple(slice(0, n - a) for n, a in zip(self.shape, low, strict=True))]

    def wanted(self, images: DataFrame) -> DataFrame:
        """The images' rows (image_path), each once for every chunk that its array may have, by name."""
        number = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(math.prod(self.grid) - 1).cast("long")))
        places = [(F.floor(F.col("id") / math.prod(self.grid[i + 1 :])) % n).cast("long") for i, n in enumerate(self.grid)]
        return images.select("image_path", number.alias("id")).select("image_path", F.concat_ws("/", *places).alias("name"), F.lit(True).alias("wanted"))

    def stored(self, spark: SparkSession, where: str) -> DataFrame:
        """(folder, name, content) of the files under a path or pattern that leads to arrays: the folder of the chunk's image, by
        its last three parts, and the chunk's name."""
        parts, own = F.split("path", "/"), len(self.shape) if self.mark == "/" else 1
        name = F.array_join(F.slice(parts, F.size(parts) - own + 1, own), "/") if self.mark == "/" else F.replace(F.element_at(parts, -1), F.lit(self.mark), F.lit("/"))
        above = own + len(self.level.split("/"))
        folder = F.array_join(F.slice(parts, F.greatest(F.lit(1), F.size(parts) - above - 2), 3), "/")
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(where)
        return files.filter(~F.element_at(F.split("path", "/"), -1).startswith(".")).select(folder.alias("folder"), name.alias("name"), "content")

    def pixels(self, chunks: DataFrame) -> DataFrame:
        """(image_path, t, c, z, y, x, value) of chunks (image_path, name, wanted, content); one that isn't wanted is an error."""
        array, shape, size, axes = self, self.shape, self.chunks, self.axes

        def work(batches):
            for b in batches:
                for image, name, wanted, content in zip(b["image_path"], b["name"], b["wanted"], b["content"], strict=True):
                    if wanted is not True:
                        raise ValueError(f"chunk {name} of {image} isn't one of the array")
                    index = [*map(int, name.split("/"))]
                    low, block = [i * c for i, c in zip(index, size, strict=True)], array.block(index, content)
                    if block.dtype.kind in "iu" and block.size and max(abs(int(block.max())), abs(int(block.min()))) > 1 << 53:
                        raise OverflowError(f"a value of chunk {name} of {image} isn't exact as a double: read the store's blocks")
                    places = np.indices(block.shape).reshape(len(shape), -1) + np.array(low)[:, None]
                    columns = {a: np.zeros(block.size, np.int64) for a in AXES} | dict(zip(axes, places, strict=True))
                    yield pd.DataFrame({"image_path": image} | columns | {"value": block.ravel().astype(float)})

        schema = "image_path string, " + ", ".join(f"{a} long" for a in AXES) + ", value double"
        return chunks.select("image_path", "name", "wanted", "content").mapInPandas(work, schema)


def read_image(spark: SparkSession, store: str, image_path: str = "") -> tuple[DataFrame, dict]:
    """The pixels (t, c, z, y, x, value) of the finest level, and its shape, axes, scales, type and channels.

    A missing chunk holds the fill value; a stored one that isn't the array's is an error. Big-endian values are turned, either
    order of values is read, and absent axes have length 1."""
    files = Files(spark, store)
    array = Array(files, image_path)
    stored = array.stored(spark, "/".join(p for p in (files.base, image_path, array.level) if p))
    wanted = array.wanted(spark.range(1).select(F.lit(image_path).alias("image_path")))
    chunks = wanted.drop("image_path").join(stored, "name", "full").withColumn("image_path", F.lit(image_path))
    return array.pixels(chunks).drop("image_path"), array.about


def read_plate(spark: SparkSession, store: str) -> tuple[DataFrame, dict]:
    """The pixels (image_path, t, c, z, y, x, value) of all fields of a plate in one scan, and what its first field says of shape,
    axes, scales, type and channels; all fields are of one form."""
    files, places = Files(spark, store), fields(spark, store).select("image_path")
    array = Array(files, places.orderBy("image_path").first().image_path)
    stored = array.stored(spark, f"{files.base}/*/*/*/{array.level}").withColumnRenamed("folder", "image_path")
    return array.pixels(array.wanted(places).join(stored, ["image_path", "name"], "full")), array.about


# Writing -----------------------------------------------------------------------------------------------------------------


def level_sizes(height: int, width: int, least: int | None = None, most: int | None = None) -> list[tuple[int, int]]:
    """The sides of a pyramid's levels: each keeps every second row and column of the one before."""
    out, least, most = [(height, width)], least or LEAST_SIDE, most or MOST_LEVELS
    while min(out[-1]) >= least and len(out) < most:
        out.append(tuple((n + 1) // 2 for n in out[-1]))
    return out


def put_blocks(blocks: DataFrame, final: str, chunk: int, part: str = "", expected: int | None = None) -> None:
    """Writes blocks (path, t, c, z and a block's own columns), path being an array's folder, as chunks of the folder beside `final`
    that holds their metadata, and puts that folder, or a part of it, in its place when all are written."""
    writer = registered(blocks.sparkSession) and blocks.write.format("zarr_blocks").mode("append").option("chunk", chunk).option("part", part)
    (writer if expected is None else writer.option("expected", expected)).save(final)


def put_chunks(rows: DataFrame, final: str, chunk: int, dtype: str, part: str = "") -> None:
    """The same for rows (path, t, c, z, y, x, value, size_y, size_x) of images of five axes, with all levels; path is an image's
    folder. A chunk is a group of chunk * chunk values at most; a value that doesn't fit the type is an error."""
    put_blocks(block_levels(tiles.to_blocks(rows, None, None, chunk, dtype=dtype), chunk, aligned=True), final, chunk, part)


def block_levels(blocks: DataFrame, chunk: int, aligned: bool = False) -> DataFrame:
    """Blocks (path, t, c, z, ...) of all levels of their images, cut into chunks; `path` becomes the level's folder. Blocks that are
    chunks already are the first level as they are."""
    keys, least, most = ["path", "t", "c", "z"], LEAST_SIDE, MOST_LEVELS

    def named(row, k):
        return row | {"path": f"{row['path']}/{k}" if row["path"] else str(k)}

    def fewer(row):
        values = tiles.values_of(row)
        for k, (height, width) in enumerate(level_sizes(row["size_y"], row["size_x"], least, most)):
            step = 2**k
            y, x = -(-row["y"] // step), -(-row["x"] // step)
            piece = values[y * step - row["y"] :: step, x * step - row["x"] :: step]
            if piece.size and (k or not aligned):
                yield named(row, k) | {"y": y, "x": x, "height": piece.shape[0], "width": piece.shape[1], "size_y": height, "size_x": width, "data": piece.tobytes()}

    blocks = blocks.select(*keys, *tiles.OWN)
    schema = tiles.declared(blocks, keys, tiles.OWN)
    levels = tiles.retiled(tiles.each(blocks, fewer, schema), chunk).select(*keys, *tiles.OWN)
    return levels.unionByName(tiles.each(blocks, lambda row: iter([named(row, 0)]), schema)) if aligned else levels


def put_metadata(files: Files, group: str, size: dict[str, int], chunk: int, dtype: str, scales: dict[str, float] | None = None, more: dict | None = None) -> None:
    """An image or label group without its chunks: its levels' arrays, and what it says of itself."""
    datasets = []
    for k, (height, width) in enumerate(level_sizes(size["y"], size["x"])):
        shape = [size["t"], size["c"], size["z"], height, width]
        array = {"zarr_format": 2, "shape": shape, "chunks": [1, 1, 1, min(chunk, height), min(chunk, width)], "dtype": dtype, "compressor": {"id": "zlib", "level": 6}, "fill_value": 0, "order": "C", "filters": None}
        files.write_json(f"{group}/{k}/.zarray", array)
        step = [float((scales or {}).get(a, 1.0)) * (2**k if a in "yx" else 1) for a in AXES]
        datasets.append({"path": str(k), "coordinateTransformations": [{"type": "scale", "scale": step}]})
    kinds = {"t": "time", "c": "channel"}
    axes = [{"name": a, "type": kinds.get(a, "space")} | ({"unit": "micrometer"} if a in "zyx" and a in (scales or {}) else {}) for a in AXES]
    files.write_json(f"{group}/.zgroup", {"zarr_format": 2})
    files.write_json(f"{group}/.zattrs", {"multiscales": [{"version": "0.4", "axes": axes, "datasets": datasets}]} | (more or {}))


def with_axes(rows: DataFrame) -> DataFrame:
    return rows.withColumns({a: F.lit(0).cast("long") for a in "tcz" if a not in rows.columns})


def in_folder(rows: DataFrame, folder, size: dict[str, int]) -> DataFrame:
    """The rows with their image's folder (text or column) and sides, where they don't name these."""
    known = rows.withColumns({f"size_{a}": F.lit(size[a]).cast("long") for a in "yx" if f"size_{a}" not in rows.columns})
    return known.select((F.lit(folder) if isinstance(folder, str) else folder).alias("path"), "t", "c", "z", "y", "x", "value", "size_y", "size_x")


def same_sides(first: dict[str, int], second: dict[str, int]) -> None:
    """ValueError if two images that are to stand in one differ in time, depth or sides."""
    if wrong := [a for a in "tzyx" if first[a] != second[a]]:
        raise ValueError(f"images differ in {', '.join(wrong)}: {first} and {second}")


def write_image(rows: DataFrame, store: str, size: dict[str, int], channels: list[tuple[str, str | None]], scales: dict[str, float] | None = None, dtype: str = "<i4", chunk: int = CHUNK, original: tuple[DataFrame, dict] | None = None) -> None:
    """An image store (t, c, z, y, x, value; or blocks) with all its levels and channels (name, colour), put in place when it is whole.

    In the channel layout the rows are labels, a channel for each set; with `original` (what read_image gives) the source's
    channels come first, as whole numbers: halves go to even, and a value that isn't finite or doesn't fit is an error."""
    spark, rows, size = rows.sparkSession, with_axes(rows), dict.fromkeys(AXES, 1) | size
    if original is not None:
        pixels, about = original
        same_sides(about["size"], size)
        count = about["size"]["c"]
        moved = rows.withColumns({"c": F.col("c") + count, "value": F.col("value").cast("double")})
        rows = with_axes(pixels).withColumn("value", S.exact_int("value").cast("double")).unionByName(moved.select(*AXES, "value"))
        size, channels = size | {"c": size["c"] + count}, [*about["channels"], *channels]
    name = store.rstrip("/").rpartition("/")[2]
    files = Files(spark, f"{store.rstrip('/')}.partial")
    files.fs.delete(files.at(""), True)
    try:
        shown = [{"label": n, "active": True} | ({"color": c} if c else {}) for n, c in channels]
        put_metadata(files, "image", size, chunk, dtype, scales, {"omero": {"channels": shown}})
        described = S.image_document(F.lit(name), F.lit(np.dtype(dtype).name), {a: F.lit(n) for a, n in size.items()}, {a: F.lit((scales or {}).get(a)).cast("double") for a in "zyx"}, F.array(*(F.struct(F.lit(n).alias("label"), (F.lit(c) if c else S.label_color(F.lit(n), F.lit(k))).alias("color")) for k, (n, c) in enumerate(channels))).cast("array<struct<label:string,color:string>>"))
        files.write("image/OME/METADATA.ome.xml", spark.range(1).select(described.alias("x")).first().x.encode())
        if "data" in rows.columns:
            put_blocks(block_levels(rows.withColumn("path", F.lit("image")), chunk), store, chunk, "image")
        else:
            put_chunks(in_folder(rows, "image", size), store, chunk, dtype, "image")
    finally:
        files.fs.delete(files.at(""), True)


def write_labels(labels: DataFrame, store: str, name: str, size: dict[str, int], chunk: int = CHUNK, dtype: str = "<i4", scales: dict[str, float] | None = None) -> None:
    """One image's labels ([t,] z, y, x, label) as labels/<name> of a store, with all levels and an entry in the store's index of
    labels, put in place when all chunks are written. The image itself stays as it is."""
    files, partial, size = Files(labels.sparkSession, store), f"labels/{name}.partial", dict.fromkeys(AXES, 1) | size
    files.fs.delete(files.at(partial), True)
    try:
        put_metadata(files, f"{partial}/group", size, chunk, dtype, scales, {"image-label": {"version": "0.4", "source": {"image": "../../"}}})
        put_chunks(in_folder(with_axes(labels.withColumnRenamed("label", "value")), "group", size), f"{files.base}/labels/{name}", chunk, dtype, "group")
    finally:
        files.fs.delete(files.at(partial), True)
    listed = (files.attributes("labels") or {}).get("labels", [])
    files.write_json("labels/.zgroup", {"zarr_format": 2})
    files.write_json("labels/.zattrs", {"labels": [*listed, *([] if name in listed else [name])]})


def write_native(labels: DataFrame, store: str, source: str, names: list[str], image_path: str = "", chunk: int = CHUNK, dtype: str = "<u4") -> None:
    """A store in the native layout: the source's image as it is, in its own type, at the root, and a label group for each name
    with the labels (name, [t,] z, y, x, label) of that name. The image goes from store to store in blocks."""
    spark = labels.sparkSession
    about = Array(Files(spark, source), image_path).about
    write_image(read_blocks(spark, source, images=[image_path]).drop("image_path"), store, about["size"], about["channels"], about["scales"], np.dtype(about["dtype"]).str, chunk)
    for name in names:
        write_labels(labels.filter(F.col("name") == name).drop("name"), store, name, about["size"] | {"c": 1}, chunk, dtype, about["scales"])


def faults(expected: DataFrame, written: DataFrame) -> DataFrame:
    """(image_path, fault) of fields that are missing, unexpected or repeated."""
    told = lambda df, what: df.select("image_path", F.lit(what).alias("fault"))
    twice = written.groupBy("image_path").count().filter("count > 1")
    return told(expected.join(written, "image_path", "left_anti"), "missing").unionByName(told(written.join(expected, "image_path", "left_anti"), "unexpected")).unionByName(told(twice, "repeated"))


def write_plate(labels: DataFrame, written: DataFrame, source: str, out: str, size: dict[str, int] | DataFrame, sets: list[str], chunk: int = CHUNK, dtype: str = "<i4", original: DataFrame | None = None) -> None:
    """All fields of a plate at once: labels (image_path, name, [t,] z, y, x, label) of the sets, for the fields of a source store,
    of one size or each of its own (image_path, size_t, size_z, size_y, size_x). With `original` (the fields' pixels, with image_path) a
    field is an image with the source's channels as whole numbers and one for each set behind these, else a group for each set.

    `written` (image_path) names the fields that were segmented, with labels or without; a missing, unknown or repeated one is
    an error. The plate appears whole or not at all. Acquisitions that the plate doesn't declare are left out."""
    spark = labels.sparkSession
    expected = fields(spark, source).select("image_path")
    if wrong := faults(expected, written).orderBy("fault", "image_path").limit(5).collect():
        raise ValueError(f"the plate isn't whole: {[(r.fault, r.image_path) for r in wrong]}")
    if isinstance(size, dict):
        size = expected.select("image_path", *(F.lit(size.get(a, 1)).cast("long").alias(f"size_{a}") for a in "tzyx"))
    given, files = Files(spark, source), Files(spark, f"{out.rstrip('/')}.partial")
    files.fs.delete(files.at(""), True)
    try:
        plate = {k: v for k, v in given.attributes("").items() if k != "omero"}
        declared = {a.get("id") for a in plate["plate"].get("acquisitions") or () if isinstance(a, dict)} - {None}
        wells: dict[str, list[str]] = {}
        for r in size.orderBy("image_path").toLocalIterator():
            well, _, field = r.image_path.rpartition("/")
            wells.setdefault(well, []).append(field)
            sides = {a: r[f"size_{a}"] for a in "tzyx"}
            if original is not None:
                about = Array(given, r.image_path).about
                shown = [{"label": n, "active": True} | ({"color": c} if c else {}) for n, c in [*about["channels"], *((s, None) for s in sets)]]
                put_metadata(files, r.image_path, sides | {"c": len(shown)}, chunk, dtype, about["scales"], {"omero": {"channels": shown}})
                continue
            for s in sets:
                put_metadata(files, f"{r.image_path}/labels/{s}", sides | {"c": 1}, chunk, dtype, None, {"image-label": {"version": "0.4"}})
            files.write_json(f"{r.image_path}/labels/.zattrs", {"labels": sets})
        for well, names in wells.items():
            taken = {str(i.get("path", "")).strip("/"): i.get("acquisition") for i in given.attributes(well)["well"]["images"]}
            images = [{"path": n, **({"acquisition": taken[n]} if taken[n] in declared else {})} for n in names]
            files.write_json(f"{well}/.zattrs", {"well": {"version": "0.4", "images": images}})
        files.write_json(".zattrs", plate | {"segmentation": {"field_count": sum(map(len, wells.values()))}})
        files.write_json(".zgroup", {"zarr_format": 2})
        sides = size.select("image_path", "size_y", "size_x", *(["size_c"] if original is not None else []))
        rows, folder = labels.withColumnRenamed("label", "value"), F.concat_ws("/", "image_path", F.lit("labels"), "name")
        if original is not None:
            after = F.array_position(F.array(*map(F.lit, sets)), F.col("name")) - 1
            rows, folder = rows.withColumn("c", after), F.col("image_path")
        rows = with_axes(rows).join(sides, "image_path")
        if original is not None:
            both = ["image_path", *AXES, "value", "size_y", "size_x"]
            moved = rows.withColumns({"c": F.col("c") + F.col("size_c"), "value": F.col("value").cast("double")}).select(*both)
            rows = original.withColumn("value", S.exact_int("value").cast("double")).join(sides, "image_path").select(*both).unionByName(moved)
        put_chunks(in_folder(rows, folder, {}), out, chunk, dtype)
    finally:
        files.fs.delete(files.at(""), True)
