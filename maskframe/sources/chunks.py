"""Image stores as a Spark data source of blocks: `spark.read.format("zarr_blocks")` and `df.write.format("zarr_blocks")`.

Reading: a row is a plane's part that one chunk holds (see operators.tiles), of every image of a store or plate, each by its own
metadata. Options t, c, z, y and x (a list of numbers as JSON, or first:stop) and images (a list of paths) say what is wanted: chunks
that hold none of it aren't opened. With the option `pushdown` filters on these columns do the same; then each load is to be
filtered once, as this version of Spark keeps one set of pushed filters for a loaded frame, however often it is used. Partitions are
runs of chunks of about `bytesPerPartition` bytes.

Writing: tasks write chunks beside the final place (`path`.partial, whose metadata stands there already), each under a name of its own
that is then moved to the chunk's, so a copy of a task that runs late changes nothing; their commit messages count what they wrote.
The driver's commit compares that with what is `expected` and puts the whole folder in place at once; abort removes it.
"""

from __future__ import annotations

import json
import math
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual, WriterCommitMessage

from ..operators.tiles import OWN

AXES = "tczyx"
COLUMNS = {"image_path": "string", "t": "long", "c": "long", "z": "long"} | OWN
SCHEMA = ", ".join(f"{n} {k}" for n, k in COLUMNS.items())
BYTES_PER_PARTITION = 32 << 20
CHANNELS = "array<struct<name:string,color:string>>"


def arrow_schema(columns: dict[str, str]) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary(), CHANNELS: pa.list_(pa.struct([("name", pa.string()), ("color", pa.string())]))}
    return pa.schema([(n, kinds[k]) for n, k in columns.items()])


class Store:
    """A folder through pyarrow's file systems, as Python workers see it."""

    def __init__(self, base: str):
        self.base = base.rstrip("/")
        if self.base.startswith("file:"):
            self.base = "/" + self.base.removeprefix("file:").lstrip("/")
        self.fs, self.root = (fs.LocalFileSystem(), self.base) if self.base.startswith("/") else fs.FileSystem.from_uri(self.base)

    def at(self, name: str) -> str:
        return f"{self.root}/{name}" if name else self.root

    def data(self, name: str) -> bytes | None:
        """A file's bytes; None if there is no such file."""
        try:
            with self.fs.open_input_stream(self.at(name), compression=None) as stream:
                return stream.read()
        except FileNotFoundError:
            return None

    def attributes(self, name: str, file: str = ".zattrs") -> dict | None:
        try:
            return json.loads((self.data(f"{name}/{file}" if name else file) or b"null").decode(errors="replace"))
        except ValueError:
            return None

    def exists(self, name: str) -> bool:
        return self.fs.get_file_info(self.at(name)).type != fs.FileType.NotFound

    def delete(self, name: str) -> None:
        if self.exists(name):
            self.fs.delete_dir(self.at(name))

    def put(self, name: str, data: bytes) -> None:
        """Writes a file under a name of its own, then moves it to its place."""
        folder, _, last = name.rpartition("/")
        own = f"{folder}/.{last}-{uuid.uuid4().hex}"
        with self.fs.open_output_stream(self.at(own), compression=None) as out:
            out.write(data)
        self.fs.move(self.at(own), self.at(name))


def image_paths(store: Store) -> list[str]:
    """The images of a store: itself, or the fields of its plate's wells."""
    plate = (store.attributes("") or {}).get("plate")
    if plate is None:
        return [""]
    wells = sorted({str(w["path"]).strip("/") for w in plate.get("wells") or () if isinstance(w, dict) and w.get("path")} - {""})
    found = [f"{w}/{str(i['path']).strip('/')}" for w in wells for i in ((store.attributes(w) or {}).get("well") or {}).get("images") or ()]
    if not found:
        raise ValueError(f"plate without fields: {store.base}")
    return sorted(found)


@dataclass
class Chunks(InputPartition):
    """A run of an image's wanted chunks: of each axis the numbers of the chunks, and where in their product the run begins and ends."""

    image_path: str
    wanted: dict[str, list[int]]
    start: int
    stop: int


def holds(f: Filter, value) -> bool:
    match f:
        case EqualTo() | EqualNullSafe():
            return value == f.value
        case GreaterThan():
            return value > f.value
        case GreaterThanOrEqual():
            return value >= f.value
        case LessThan():
            return value < f.value
        case LessThanOrEqual():
            return value <= f.value
        case In():
            return value in f.value
    return True


def wanted_places(axis: str, option: str) -> list[Filter]:
    if ":" in option:
        ends = [(kind, v) for kind, v in zip((GreaterThanOrEqual, LessThan), option.split(":"), strict=True) if v.strip()]
        return [kind((axis,), int(v)) for kind, v in ends]
    return [In((axis,), tuple(json.loads(option)))]


class BlocksReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.size = options["path"], int(options.get("bytesPerPartition", BYTES_PER_PARTITION))
        self.images = json.loads(options["images"]) if "images" in options else None
        self.filters: dict[str, list[Filter]] = {a: wanted_places(a, options[a]) for a in AXES if a in options}

    def fits(self, name: str, value) -> bool:
        return all(holds(f, value) for f in self.filters.get(name, ()))

    def wanted(self, array) -> dict[str, list[int]]:
        """By axis the chunks that hold a wanted place; blocks have the places at which their chunks begin in y and x."""
        out = {}
        for a in AXES:
            n, step = (array.shape[array.axes.index(a)], array.chunks[array.axes.index(a)]) if a in array.axes else (1, 1)
            places = range(0, n, step) if a in "yx" else range(n)
            out[a] = sorted({v // step for v in places if self.fits(a, v)})
        return out

    def partitions(self):
        from .zarr import Array

        store, out = Store(self.path), []
        for image in image_paths(store) if self.images is None else self.images:
            if self.fits("image_path", image):
                array = Array(store, image)
                wanted = self.wanted(array)
                total, each = math.prod(map(len, wanted.values())), max(1, self.size // (math.prod(array.chunks) * array.dtype.itemsize))
                out += [Chunks(image, wanted, k, min(k + each, total)) for k in range(0, total, each)]
        return out or [Chunks("", {a: [] for a in AXES}, 0, 0)]

    def read(self, partition: Chunks) -> Iterator[pa.RecordBatch]:
        from .zarr import Array

        if partition.start == partition.stop:
            return
        store, schema = Store(self.path), arrow_schema(COLUMNS)
        array = Array(store, partition.image_path)
        folder = "/".join(p for p in (partition.image_path, array.level) if p)
        order = [array.axes.index(a) for a in AXES if a in array.axes]
        for k in range(partition.start, partition.stop):
            place = dict(zip(AXES, np.unravel_index(k, [len(partition.wanted[a]) for a in AXES]), strict=True))
            index = {a: partition.wanted[a][int(place[a])] for a in AXES}
            block = array.block([index[a] for a in array.axes], store.data(f"{folder}/{array.mark.join(str(index[a]) for a in array.axes)}"))
            block = block.transpose(order).reshape([block.shape[array.axes.index(a)] if a in array.axes else 1 for a in AXES])
            low = {a: index[a] * (array.chunks[array.axes.index(a)] if a in array.axes else 1) for a in AXES}
            sides = [array.about["size"][a] for a in "yx"]
            rows = []
            for at in np.ndindex(*block.shape[:3]):
                t, c, z = (low[a] + v for a, v in zip("tcz", at, strict=True))
                if self.fits("t", t) and self.fits("c", c) and self.fits("z", z):
                    plane = np.ascontiguousarray(block[at])
                    plane = plane.astype(plane.dtype.newbyteorder("<"))
                    rows.append((partition.image_path, t, c, z, low["y"], low["x"], *plane.shape, *sides, plane.dtype.str, plane.tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


class PushedReader(BlocksReader):
    """A reader that takes filters."""

    def pushFilters(self, filters):
        for f in filters:
            known = isinstance(f, (EqualTo, EqualNullSafe, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, In, IsNotNull))
            if known and len(f.attribute) == 1 and f.attribute[0] in ("image_path", *AXES) and getattr(f, "value", 0) is not None:
                self.filters.setdefault(f.attribute[0], []).append(f)
            else:
                yield f


@dataclass
class Written(WriterCommitMessage):
    chunks: int


class BlocksWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.chunk = options["path"].rstrip("/"), int(options["chunk"])
        self.expected = int(options["expected"]) if "expected" in options else None
        # what is put in place: a part of what was written, where that holds more
        self.part = options.get("part", "")

    def write(self, iterator) -> Written:
        store, n = Store(f"{self.path}.partial"), 0
        for batch in iterator:
            at = {name: k for k, name in enumerate(batch.schema.names)}
            for i in range(batch.num_rows):
                r = {name: batch.column(k)[i].as_py() for name, k in at.items()}
                want = [min(self.chunk, r[f"size_{a}"] - r[a]) for a in "yx"]
                if r["y"] % self.chunk or r["x"] % self.chunk or [r["height"], r["width"]] != want:
                    raise ValueError(f"a block at {r['y']}, {r['x']} of {r['height']} by {r['width']} is no chunk of {self.chunk}")
                full = [min(self.chunk, r["size_y"]), min(self.chunk, r["size_x"])]
                data = np.frombuffer(r["data"], r["dtype"]).reshape(want)
                if want != full:
                    data = np.pad(data, [(0, f - w) for f, w in zip(full, want, strict=True)])
                store.put(f"{r['path']}/{r['t']}.{r['c']}.{r['z']}.{r['y'] // self.chunk}.{r['x'] // self.chunk}", zlib.compress(data.tobytes()))
                n += 1
        return Written(n)

    def commit(self, messages) -> None:
        parent, _, name = self.path.rpartition("/")
        top, n = Store(parent), sum(m.chunks for m in messages if m)
        if self.expected is not None and n != self.expected:
            raise ValueError(f"{n} chunks of {self.expected} were written")
        partial = f"{name}.partial"
        made, aside = f"{partial}/{self.part}" if self.part else partial, f"{name}.replaced"
        top.delete(aside)
        if top.exists(name):
            top.fs.move(top.at(name), top.at(aside))
        try:
            top.fs.move(top.at(made), top.at(name))
        except OSError:
            if top.exists(aside):
                top.fs.move(top.at(aside), top.at(name))
            raise
        top.delete(aside)
        top.delete(partial)

    def abort(self, messages) -> None:
        parent, _, name = self.path.rpartition("/")
        Store(parent).delete(f"{name}.partial")


class Blocks(DataSource):
    @classmethod
    def name(cls) -> str:
        return "zarr_blocks"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BlocksReader:
        return PushedReader(self.options) if self.options.get("pushdown", "").lower() == "true" else BlocksReader(self.options)

    def writer(self, schema, overwrite: bool) -> BlocksWriter:
        return BlocksWriter(self.options)


def registered(spark: SparkSession) -> SparkSession:
    """Makes the format known, and lets Spark push filters down to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Blocks)
    return spark


def read_blocks(spark: SparkSession, store: str, **options) -> DataFrame:
    """The blocks (image_path, t, c, z, and a block's own columns) of all images of a store or plate, or of what the options ask for."""
    reader = registered(spark).read.format("zarr_blocks")
    for name, value in options.items():
        reader = reader.option(name, value if isinstance(value, str) else json.dumps(value))
    return reader.load(store)


FORMS = {"image_path": "string", "dtype": "string"} | {f"size_{a}": "long" for a in AXES} | {f"scale_{a}": "double" for a in AXES} | {"channels": CHANNELS}


def forms(spark: SparkSession, store: str, images: DataFrame) -> DataFrame:
    """What each image (image_path) says of its type, sides, scales (null where it names none) and channels; tasks read the metadata."""

    def work(batches):
        from .zarr import Array

        folder, schema = Store(store), arrow_schema(FORMS)
        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                about = Array(folder, path).about
                rows.append({"image_path": path, "dtype": about["dtype"]} | {f"size_{a}": about["size"][a] for a in AXES} | {f"scale_{a}": about["scales"].get(a) for a in AXES} | {"channels": [{"name": n, "color": c} for n, c in about["channels"]]})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return images.select("image_path").mapInArrow(work, ", ".join(f"{n} {k}" for n, k in FORMS.items()))
