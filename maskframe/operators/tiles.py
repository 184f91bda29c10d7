"""Planes as blocks: a row holds a rectangle of a plane as bytes, so a pixel costs its own size wherever it is moved.

A block names its plane by key columns (any), and has its first place y and x, its height and width, the plane's sides size_y and
size_x, the values' type and the values, row by row. What needs a neighbourhood, or a whole plane, meets by (plane, tile): each block
sends every tile the part of itself that the tile's padded extent holds, once, and a task puts a tile's parts together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

#: What a block is besides its plane's key.
OWN = {"y": "long", "x": "long", "height": "long", "width": "long", "size_y": "long", "size_x": "long", "dtype": "string", "data": "binary"}
#: The part of a tile that isn't padding.
CORE = {"core_y": "long", "core_x": "long", "core_height": "long", "core_width": "long"}
#: Pixels that a Python worker turns to rows at once.
PIXELS_AT_ONCE = 1 << 18


def plane_key(blocks: DataFrame) -> list[str]:
    return [c for c in blocks.columns if c not in OWN and c not in CORE]


def declared(df: DataFrame, keys: list[str], more: dict[str, str]) -> str:
    kinds = dict(df.dtypes)
    return ", ".join([*(f"{k} {kinds[k]}" for k in keys), *(f"{n} {k}" for n, k in more.items())])


def arrow_of(df: DataFrame, schema: str) -> pa.Schema:
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def values_of(row: dict) -> np.ndarray:
    return np.frombuffer(row["data"], row["dtype"]).reshape(row["height"], row["width"])


def each(df: DataFrame, work: Callable[[dict], Iterator[dict]], schema: str) -> DataFrame:
    """work() makes of one row any number; a batch is sent on when it has 8 MB."""
    arrow = arrow_of(df, schema)

    def run(batches):
        out, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                for row in work({n: batch.column(k)[i].as_py() for k, n in enumerate(batch.schema.names)}):
                    out.append(row)
                    size += len(row.get("data") or b"")
                    if size >= 8 << 20 or len(out) >= 4096:
                        yield pa.RecordBatch.from_pylist(out, schema=arrow)
                        out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return df.mapInArrow(run, schema)


def to_blocks(pixels: DataFrame, height: int | None, width: int | None, tile: int = 512, value: str = "value", dtype: str = "<f8") -> DataFrame:
    """Blocks of pixels (key columns, y, x, value) of planes of so many rows and columns, or as many as their columns size_y and size_x
    say; what isn't named is 0, and a value that doesn't fit the type an error. A block's pixels are one group of tile * tile at most."""
    keys = [c for c in pixels.columns if c not in ("y", "x", value, "size_y", "size_x")]
    if height is not None:
        pixels = pixels.withColumns({"size_y": F.lit(height).cast("long"), "size_x": F.lit(width).cast("long")})
    place = ((F.col("y") % tile) * tile + F.col("x") % tile).cast("int")
    grouped = pixels.groupBy(*keys, F.floor(F.col("y") / tile).alias("ty"), F.floor(F.col("x") / tile).alias("tx"), "size_y", "size_x").agg(F.collect_list(F.struct(place.alias("p"), F.col(value).alias("v"))).alias("at"))
    schema = declared(pixels, keys, OWN)
    arrow = arrow_of(pixels, schema)
    whole = np.iinfo(dtype) if np.dtype(dtype).kind in "iu" else None

    def run(batches):
        for batch in batches:
            at = batch.column(len(keys) + 4)
            ends, flat = np.asarray(at.offsets), at.values
            places, values = flat.field(0).to_numpy(zero_copy_only=False), flat.field(1).to_numpy(zero_copy_only=False)
            if whole and len(values) and (values.max() > whole.max or values.min() < whole.min):
                raise OverflowError(f"value exceeds the type {dtype}")
            ty, tx, sy, sx = (batch.column(len(keys) + k).to_numpy() for k in range(4))
            h, w = np.minimum(tile, sy - ty * tile), np.minimum(tile, sx - tx * tile)
            for i in range(batch.num_rows):
                block = np.zeros((h[i], w[i]), dtype)
                p = places[ends[i] : ends[i + 1]]
                block[p // tile, p % tile] = values[ends[i] : ends[i + 1]]
                own = [[int(ty[i] * tile)], [int(tx[i] * tile)], [int(h[i])], [int(w[i])], [int(sy[i])], [int(sx[i])], [dtype], [block.tobytes()]]
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(i, 1) for k in range(len(keys))), *(pa.array(v, t) for v, t in zip(own, arrow.types[len(keys) :], strict=True))], schema=arrow)

    return grouped.mapInArrow(run, schema)


def to_pixels(blocks: DataFrame, value: str = "value", kind: str = "double", sparse: bool = False) -> DataFrame:
    """A row (key columns, y, x, value) for each pixel, or with `sparse` for each that isn't 0. A whole number that a double doesn't
    hold is an error."""
    keys = plane_key(blocks)
    schema = declared(blocks, keys, {"y": "long", "x": "long", value: kind})
    arrow = arrow_of(blocks, schema)
    whole = kind != "double"

    def send(parts):
        n = [len(v) for _, _, _, v in parts]
        held = [pa.concat_arrays([pa.repeat(p[0][k], m) for p, m in zip(parts, n, strict=True)]) for k in range(len(keys))]
        y, x, v = (np.concatenate([p[j] for p in parts]) for j in (1, 2, 3))
        return pa.RecordBatch.from_arrays([*(h.cast(t) for h, t in zip(held, arrow.types, strict=False)), pa.array(y), pa.array(x), pa.array(v, arrow.types[-1])], schema=arrow)

    def run(batches):
        parts, held = [], 0
        for batch in batches:
            at = {n: k for k, n in enumerate(batch.schema.names)}
            for i in range(batch.num_rows):
                row = {n: batch.column(at[n])[i].as_py() for n in OWN}
                block = values_of(row)
                if not whole and block.dtype.kind in "iu" and block.size and max(abs(int(block.max())), abs(int(block.min()))) > 1 << 53:
                    raise OverflowError(f"a value of {row['dtype']} isn't exact as a double")
                for top in range(0, len(block), step := max(1, PIXELS_AT_ONCE // max(1, row["width"]))):
                    piece = block[top : top + step]
                    y, x = np.nonzero(piece) if sparse else (k.ravel() for k in np.indices(piece.shape))
                    parts.append(([batch.column(at[k])[i] for k in keys], y + (row["y"] + top), x + row["x"], piece[y, x].astype("int64" if whole else "float64")))
                    held += len(y)
                    if held >= PIXELS_AT_ONCE:
                        yield send(parts)
                        parts, held = [], 0
        if held:
            yield send(parts)

    return blocks.mapInArrow(run, schema)


def mapped(blocks: DataFrame, work: Callable[[np.ndarray, dict], np.ndarray]) -> DataFrame:
    """work(values, row) instead of each block's values, of the same shape; no shuffle."""

    def run(row):
        out = np.ascontiguousarray(work(values_of(row), row))
        if out.shape != (row["height"], row["width"]):
            raise ValueError(f"values of shape {out.shape} for a block of {(row['height'], row['width'])}")
        yield row | {"dtype": out.dtype.str, "data": out.tobytes()}

    return each(blocks, run, declared(blocks, blocks.columns, {}))


def retiled(blocks: DataFrame, tile: int | None, halo: int = 0) -> DataFrame:
    """The planes cut anew into tiles, each with a halo of its neighbours' pixels around its core as far as the plane goes; without a
    tile's side, whole planes. A pixel is shuffled once for each tile whose padded extent holds it."""
    keys = plane_key(blocks)
    part = {"ty": "long", "tx": "long"} | OWN

    def split(row):
        block, side = values_of(row), tile or max(row["size_y"], row["size_x"], 1)
        near = lambda at, n, size: range(max(0, (at - halo) // side), min((at + n - 1 + halo) // side, (size - 1) // side) + 1)
        for ty in near(row["y"], row["height"], row["size_y"]):
            for tx in near(row["x"], row["width"], row["size_x"]):
                y0, x0 = max(row["y"], ty * side - halo), max(row["x"], tx * side - halo)
                y1, x1 = min(row["y"] + row["height"], (ty + 1) * side + halo), min(row["x"] + row["width"], (tx + 1) * side + halo)
                piece = block[y0 - row["y"] : y1 - row["y"], x0 - row["x"] : x1 - row["x"]]
                yield {k: row[k] for k in (*keys, "size_y", "size_x", "dtype")} | {"ty": ty, "tx": tx, "y": y0, "x": x0, "height": y1 - y0, "width": x1 - x0, "data": piece.tobytes()}

    parts = each(blocks.select(*keys, *OWN), split, declared(blocks, keys, part))
    grouped = parts.groupBy(*keys, "ty", "tx", "size_y", "size_x", "dtype").agg(F.collect_list(F.struct("y", "x", "height", "width", "data")).alias("parts"))

    def join(row):
        side = tile or max(row["size_y"], row["size_x"], 1)
        core = [row["ty"] * side, row["tx"] * side]
        end = [min(c + side, row[s]) for c, s in zip(core, ("size_y", "size_x"), strict=True)]
        low, high = [max(0, c - halo) for c in core], [min(e + halo, row[s]) for e, s in zip(end, ("size_y", "size_x"), strict=True)]
        out = np.zeros((high[0] - low[0], high[1] - low[1]), row["dtype"])
        for p in row["parts"]:
            out[p["y"] - low[0] :, p["x"] - low[1] :][: p["height"], : p["width"]] = values_of(p | {"dtype": row["dtype"]})
        yield {k: row[k] for k in (*keys, "size_y", "size_x", "dtype")} | {"y": low[0], "x": low[1], "height": len(out), "width": out.shape[1], "data": out.tobytes(), "core_y": core[0], "core_x": core[1], "core_height": end[0] - core[0], "core_width": end[1] - core[1]}

    return each(grouped, join, declared(blocks, keys, OWN | CORE))


def trimmed(tiles: DataFrame) -> DataFrame:
    """Tiles without their halos, as blocks."""
    keys = plane_key(tiles)

    def run(row):
        core = values_of(row)[row["core_y"] - row["y"] :, row["core_x"] - row["x"] :][: row["core_height"], : row["core_width"]]
        yield {k: row[k] for k in (*keys, "size_y", "size_x", "dtype")} | {"y": row["core_y"], "x": row["core_x"], "height": len(core), "width": core.shape[1], "data": core.tobytes()}

    return each(tiles, run, declared(tiles, keys, OWN))


def on_tiles(blocks: DataFrame, tile: int, halo: int, work: Callable[[np.ndarray, dict], np.ndarray]) -> DataFrame:
    """work(values, row) on each tile with its halo; what it gives for the core is kept."""
    return trimmed(mapped(retiled(blocks, tile, halo), work))


def binomial(values: np.ndarray, row: dict | None = None) -> np.ndarray:
    """3 by 3 binomial smoothing, edges repeated."""
    v = np.pad(values.astype(float), 1, mode="edge")
    v = v[:-2] + 2 * v[1:-1] + v[2:]
    return (v[:, :-2] + 2 * v[:, 1:-1] + v[:, 2:]) / 16


def smoothed(blocks: DataFrame, tile: int = 512) -> DataFrame:
    """Binomial smoothing over blocks of finite values: a halo of one pixel is all that is exchanged."""
    return on_tiles(blocks, tile, 1, binomial)
