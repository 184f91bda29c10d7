"""Media columns: texts as 8-bit greyscale PNG, checked and read back with numpy, and a low-frequency cosine hash.

Edge cases: a null or empty text is 64 zero bytes; any length is stored whole; equal texts give equal rows;
an empty table gives an empty result; only the id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, record_batch, table, texts_of

SIGNATURE = b"\x89PNG\r\n\x1a\n"
WIDTH = 64
#: Bytes of compressed data in one IDAT chunk.
CHUNK = 1 << 16
#: Eight lowest frequencies over 32 samples, in integers, so that equal pictures give equal bits on any machine.
COSINES = np.rint(np.cos((2 * np.arange(32) + 1) * np.arange(8)[:, None] * np.pi / 64) * 4096).astype(np.int64)


def padded(text: bytes) -> bytes:
    return text + bytes(-len(text) % WIDTH if text else WIDTH)


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode_png(payload: bytes, level: int = 6) -> bytes:
    """A PNG of WIDTH columns; each row is stored plain, by its left or by its upper neighbour, whichever differences are smallest."""
    pixels = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    forms = np.repeat(pixels[None], 3, axis=0)
    forms[1, :, 1:] -= pixels[:, :-1]
    forms[2, 1:] -= pixels[:-1]
    best = np.minimum(forms, -forms).sum(axis=2, dtype=np.int64).argmin(axis=0)
    rows = np.empty((len(pixels), WIDTH + 1), np.uint8)
    rows[:, 0] = best
    rows[:, 1:] = forms[best, np.arange(len(pixels))]
    data = zlib.compress(rows.tobytes(), level)
    head = struct.pack(">IIBBBBB", WIDTH, len(pixels), 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + b"".join(_chunk(b"IDAT", data[i : i + CHUNK]) for i in range(0, len(data), CHUNK)) + _chunk(b"IEND", b"")


def unfilter(kinds: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The pixels of filtered rows of one byte a pixel, for all five filters. Runs of the first three are sums, without a loop."""
    if kinds.size and kinds.max() > 4:
        raise ValueError("unknown PNG filter")
    if not (kinds > 2).any():
        rows = np.where((kinds == 1)[:, None], rows.cumsum(axis=1, dtype=np.uint8), rows)
        base = np.maximum.accumulate(np.where(kinds != 2, np.arange(len(kinds)), 0))
        sums = np.zeros((len(rows) + 1, rows.shape[1]), np.uint8)
        np.cumsum(rows, axis=0, dtype=np.uint8, out=sums[1:])
        return sums[1:] - sums[base]
    out, above = np.empty_like(rows), np.zeros(rows.shape[1], np.uint8)
    for i, (kind, row) in enumerate(zip(kinds.tolist(), rows, strict=True)):
        if kind < 3:
            above = out[i] = row if kind == 0 else row.cumsum(dtype=np.uint8) if kind == 1 else row + above
            continue
        left, corner, line = 0, 0, []
        for value, up in zip(row.tolist(), above.tolist(), strict=True):
            if kind == 3:
                guess = (left + up) // 2
            else:
                p = left + up - corner
                guess = min((abs(p - left), 0, left), (abs(p - up), 1, up), (abs(p - corner), 2, corner))[2]
            left, corner = (value + guess) & 255, up
            line.append(left)
        above = out[i] = np.array(line, np.uint8)
    return out


def decode_png(media: bytes) -> np.ndarray:
    """The pixels of an 8-bit greyscale PNG; ValueError if a checksum, length or form is wrong."""
    if media[:8] != SIGNATURE:
        raise ValueError("no PNG signature")
    at, head, parts, ended = 8, None, [], False
    while at < len(media) and not ended:
        if at + 12 > len(media):
            raise ValueError("cut chunk")
        (n,) = struct.unpack_from(">I", media, at)
        kind, data, crc = media[at + 4 : at + 8], media[at + 8 : at + 8 + n], media[at + 8 + n : at + 12 + n]
        if len(crc) != 4 or struct.unpack(">I", crc)[0] != zlib.crc32(data, zlib.crc32(kind)):
            raise ValueError(f"wrong checksum in {kind!r}")
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", data)
        elif kind == b"IDAT":
            parts.append(data)
        ended, at = kind == b"IEND", at + 12 + n
    if not ended or head is None or head[2:] != (8, 0, 0, 0, 0):
        raise ValueError("not a whole 8-bit greyscale PNG")
    unpack = zlib.decompressobj()
    size = head[1] * (head[0] + 1)
    raw = unpack.decompress(b"".join(parts), size + 1)
    if len(raw) != size or not unpack.eof:
        raise ValueError("wrong number of pixels")
    rows = np.frombuffer(raw, np.uint8).reshape(head[1], head[0] + 1)
    return unfilter(rows[:, 0], rows[:, 1:])


def cosine_hash(pixels: np.ndarray) -> bytes:
    """64 bits: which of the 8 by 8 lowest frequencies of the 32 by 32 picture exceed the median of those but the mean."""
    n = len(pixels)
    narrow = pixels.reshape(n, 32, -1).sum(axis=2, dtype=np.int64)
    if n < 32:
        small, count = narrow[(2 * np.arange(32) + 1) * n // 64], np.ones((32, 1), np.int64)
    else:
        edges = np.arange(33) * n // 32
        small, count = np.add.reduceat(narrow, edges[:-1], axis=0), np.diff(edges)[:, None]
    waves = (COSINES @ (small * 128 // count) @ COSINES.T).ravel()
    return np.packbits(waves > np.sort(waves[1:])[31]).tobytes()


SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, media binary, phash binary"


def media_columns(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", level: int = 6) -> DataFrame:
    """For each row the PNG of its text and its hash (binary), and digests of both and of what the PNG holds when read back. A map without a shuffle."""

    def work(batch):
        out = [[] for _ in range(9)]
        for text in texts_of(batch.column(1)):
            media = encode_png(padded(text), level)
            pixels = decode_png(media)
            stored, phash = pixels.tobytes(), cosine_hash(pixels)
            row = (len(text), len(stored), hashlib.sha256(stored).hexdigest(), zlib.crc32(stored[-64:]), len(media), hashlib.sha256(media).hexdigest(), phash.hex(), media, phash)
            for column, value in zip(out, row, strict=True):
                column.append(value)
        return record_batch(SCHEMA, [batch.column(0), *out])

    return map_batches(documents.select(F.col(id_col).cast("long"), text_col), lambda: work, SCHEMA, rows=64)


def op1_media_columns(spark, sf_dir: str) -> DataFrame:
    return media_columns(table(spark, sf_dir, "documents"))
