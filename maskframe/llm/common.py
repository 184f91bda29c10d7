"""What the text operators share: Arrow batches, written tables and byte helpers."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a Python worker holds as objects at once.
BATCH_ROWS = 512
#: Bytes of text (or other values) that a Python worker takes as objects at once, unless a single row holds more.
BATCH_BYTES = 8 << 20

#: Bytes that the JVM and a Python worker pass at once in the queries and the pipeline.
ARROW_BYTES = 4 << 20

_KEPT: dict = {}


def bounded_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches by bytes, as texts may be long and an executor holds several batches. For programs: the
    queries and the pipeline call it; the operators leave the session's settings as they are. A smaller bound stays."""
    size = min(ARROW_BYTES, spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch())
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A query's input."""
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def freed() -> None:
    """Gives back to the system what a worker's earlier tasks used."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def kept(key: tuple, make: Callable):
    """What make() returns, kept in this worker from task to task; only the latest key's is kept, so operators that follow
    each other don't add up their caches."""
    if key not in _KEPT:
        _KEPT.clear()
        gc.collect()
        freed()
        _KEPT[key] = make()
    return _KEPT[key]


def arrow_type(kind: str) -> pa.DataType:
    return {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64())}[kind]


def record_batch(schema: str, columns: list) -> pa.RecordBatch:
    """A batch of the Spark schema 'name kind, ...' from lists or arrays in its order."""
    fields = [x.strip().split(" ") for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, arrow_type(k)) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def slices(batch: pa.RecordBatch, rows: int, size: int = BATCH_BYTES):
    """The batch in pieces of at most `rows` rows, and of at most `size` bytes where a piece has several rows."""
    if batch.nbytes <= size or batch.num_rows < 2:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        return
    each = sum((pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns if pa.types.is_binary(c.type) or pa.types.is_string(c.type) or pa.types.is_large_binary(c.type) or pa.types.is_large_string(c.type)), np.zeros(batch.num_rows, np.int64))
    at, held = 0, 0
    for k, n in enumerate(each.tolist()):
        if k > at and (k - at >= rows or held + n > size):
            yield batch.slice(at, k - at)
            at, held = k, 0
        held += n
    yield batch.slice(at)


def map_batches(df: DataFrame, start: Callable, schema: str, rows: int = BATCH_ROWS) -> DataFrame:
    """start() runs once a task and returns the function from slices of at most `rows` rows to batches of the schema; slices of
    long texts have fewer. How much the JVM sends at once is the session's setting, which stays as it is."""

    def run(batches):
        freed()
        work = start()
        for batch in batches:
            for part in slices(batch, rows):
                yield work(part)

    return df.mapInArrow(run, schema)


def texts_of(column: pa.Array) -> list[bytes]:
    """Each text's UTF-8 bytes; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir; a temporary one in local mode only."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="maskframe-")
        spark.sparkContext.setCheckpointDir(found)
    return found


class Scratch:
    """Tables written to the shared folder: they cut lineage and outlive executors. Those not dropped go when the driver's JVM ends."""

    def __init__(self, spark: SparkSession):
        self.spark, self.base = spark, f"{shared_dir(spark)}/maskframe-{uuid.uuid4().hex}"
        self.paths: dict[int, str] = {}
        path = spark._jvm.org.apache.hadoop.fs.Path(self.base)
        self.fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        self.fs.deleteOnExit(path)

    def save(self, df: DataFrame) -> DataFrame:
        path = f"{self.base}/{len(self.paths)}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            if path := self.paths.pop(id(df), None):
                self.fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(path), True)


def free_name(wanted: str, *taken: list[str]) -> str:
    """`wanted`, with as many underscores in front as it takes to clash with no column of any letter case."""
    names = {n.lower() for names in taken for n in names}
    while wanted.lower() in names:
        wanted = "_" + wanted
    return wanted


def bounded_sample(df: DataFrame, most: int, *keys: str) -> DataFrame:
    """About `most` rows (all, if there are no more), chosen by a hash of the keys, so that the choice doesn't depend on
    partitions. For fitting classifiers only."""
    n = df.count()
    if n <= most:
        return df
    return df.filter(F.pmod(F.xxhash64(*keys, F.lit(17)), F.lit(1 << 30)) < F.lit(int((1 << 30) * most / n)))
