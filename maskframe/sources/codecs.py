"""Compressed chunks of arrays as bytes: the codecs that stores use, on what pyarrow and the standard library offer."""

from __future__ import annotations

import bz2
import gzip
import lzma
import struct
import zlib

import numpy as np
import pyarrow as pa

# Fixed values of the blosc format: its header, its flags, the codecs by their number, and when blocks are split.
HEADER = struct.Struct("<BBBBIII")
SHUFFLED, COPIED, BIT_SHUFFLED, WHOLE = 1, 2, 4, 16
CODECS = {1: "lz4_raw", 2: "snappy", 3: "zlib", 4: "zstd"}
MOST_SPLITS, LEAST_SPLIT = 16, 128


def _plain(codec: str, data: bytes, size: int) -> bytes:
    return zlib.decompress(data) if codec == "zlib" else pa.Codec(codec).decompress(data, size, asbytes=True)


def unshuffled(data: bytes, width: int) -> bytes:
    """Undoes the sorting of values' bytes by their place; what is left over stands at the end as it is."""
    n = len(data) // width * width
    return np.frombuffer(data, np.uint8, n).reshape(width, -1).T.tobytes() + data[n:]


def bit_unshuffled(data: bytes, width: int) -> bytes:
    """Undoes the sorting of values' bits by their place, for a multiple of eight values; what is left over stays."""
    n = len(data) // (8 * width) * 8 * width
    bits = np.unpackbits(np.frombuffer(data, np.uint8, n), bitorder="little").reshape(8 * width, -1)
    return np.packbits(bits.T, bitorder="little").tobytes() + data[n:]


def blosc(data: bytes) -> bytes:
    """A blosc buffer of version 1 or 2: blocks, each of one stream or of one for each byte of a value."""
    _, _, flags, width, size, block, total = HEADER.unpack_from(data)
    if total != len(data):
        raise ValueError("a blosc buffer was cut")
    if flags & COPIED:
        return data[HEADER.size : HEADER.size + size]
    if not size:
        return b""
    codec, count = flags >> 5, -(-size // block)
    if codec not in CODECS:
        raise ValueError(f"blosc codec {codec} isn't known")
    out = []
    for k, at in enumerate(struct.unpack_from(f"<{count}i", data, HEADER.size)):
        length = min(block, size - k * block)
        split = width <= MOST_SPLITS and block // width >= LEAST_SPLIT and length == block and not flags & WHOLE
        parts = []
        for _ in range(width if split else 1):
            (n,), want = struct.unpack_from("<i", data, at), length // (width if split else 1)
            piece = data[at + 4 : at + 4 + n]
            parts.append(piece if n == want else _plain(CODECS[codec], piece, want))
            at += 4 + n
        whole = b"".join(parts)
        out.append(unshuffled(whole, width) if flags & SHUFFLED and width > 1 else bit_unshuffled(whole, width) if flags & BIT_SHUFFLED else whole)
    return b"".join(out)


def lz4(data: bytes) -> bytes:
    """The size in four bytes, then one block."""
    (size,) = struct.unpack_from("<i", data)
    return _plain("lz4_raw", data[4:], size)


def zstd(data: bytes) -> bytes:
    import io

    with pa.CompressedInputStream(pa.PythonFile(io.BytesIO(data), "r"), "zstd") as stream:
        return stream.read()


DECODERS = {None: bytes, "zlib": zlib.decompress, "gzip": gzip.decompress, "bz2": bz2.decompress, "lzma": lzma.decompress, "blosc": blosc, "lz4": lz4, "zstd": zstd}


def decoder(compressor: dict | None):
    """The function from stored to plain bytes; ValueError if the compressor isn't known."""
    kind = (compressor or {}).get("id")
    if kind not in DECODERS:
        raise ValueError(f"unknown compressor {kind}")
    return DECODERS[kind]
