"""Substring deduplication by content-defined chunks: a gear hash sets the cuts, digests find chunks that documents share.

The gear hash of a place covers the 32 bytes before it, so cuts inside a passage depend on the passage alone and an
insertion elsewhere moves none of them. Chunks whose 64-bit digest stands in two documents, or twice in one, are joined to runs where
they follow each other; runs of fewer than `min_words` words are left alone, so a chance collision of digests makes no run.
A run lacks part of a passage at both of its ends, some 10 words in all, so MIN_WORDS words are found of passages of 50.
A run is one span or several: a new one starts where the chunks begin or cease to stand in their first place (the first in their
first holder), so no chunk is cut there. A span to keep of fewer than `min_words` words has no row: it stays with the text around it.

Edge cases: null and empty texts have no chunks; a passage that repeats within one document only is kept where it stands first, by
that document itself; a document without repeats has no row; repeated rows count once; texts of one doc_id have spans of their own, told apart by text_key, but
share nothing with each other; rows without an id are documents by their text, come after all ids, and give a null first_doc_id
where no row with an id holds the chunk; texts are used whole; an empty table gives an empty result; only doc_id and text are
read, so other columns may have any name. Ids are below 2**62. Offsets count bytes, the end exclusive.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, map_batches, record_batch, table, texts_of

#: Bits of the hash that are zero at a cut (one place in 16), and the least and most bytes of a chunk.
MASK, LEAST, MOST = np.uint32(0xF0000000), 8, 64
MIN_WORDS = 32
#: Holders from here on are texts without an id.
NAMELESS = 1 << 62

_GEAR = np.random.Generator(np.random.PCG64(11)).integers(0, 1 << 32, 256, np.uint32)
_WHITE = np.isin(np.arange(256), [32, *range(9, 14)])


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash h = 2 h + gear[byte] mod 2**32 at each place, by doubling the window five times."""
    h = _GEAR[data]
    for shift in (1, 2, 4, 8, 16):
        more = h.copy()
        more[shift:] += h[:-shift] << np.uint32(shift)
        h = more
    return h


def cuts(data: np.ndarray) -> list[int]:
    """The ends of the chunks of a text. Where none of MOST bytes is a cut, the first of the greatest hash is one, so that
    repetitive stretches too are cut alike wherever they stand."""
    out, last, n, hashes = [], 0, len(data), gear(data)
    for at in [*(np.flatnonzero(hashes & MASK == 0) + 1).tolist(), n]:
        while at - last > MOST:
            last += LEAST + int(hashes[last + LEAST - 1 : last + MOST].argmax())
            out.append(last)
        if at - last >= LEAST or at == n > last:
            out.append(at)
            last = at
    return out


CHUNKS = "doc long, holder long, place array<long>, digest array<long>"


def named(documents: DataFrame) -> DataFrame:
    """(doc, holder, key, text): a number for each distinct (id, text), what holds it, and the text's hash."""
    text = F.col("text").cast("string")
    nameless = F.xxhash64(text).bitwiseAND(F.lit(NAMELESS - 1)) + F.lit(NAMELESS)
    rows = documents.select(F.coalesce(F.col("doc_id").cast("long"), nameless).alias("holder"), F.xxhash64(text).alias("key"), text.alias("text"))
    return rows.withColumn("doc", F.xxhash64("holder", "key"))


def chunks(documents: DataFrame) -> DataFrame:
    """Each document's chunks: where it begins, whether it stood in the document before, its bytes and the words that begin in it,
    packed as start << 17 | again << 16 | bytes << 8 | words, and its digest."""

    def work(batch):
        places, digests = [], []
        for text in texts_of(batch.column(2)):
            if not text:
                places.append([])
                digests.append([])
                continue
            data = np.frombuffer(text, np.uint8)
            white = _WHITE[data]
            begun = np.zeros(len(data) + 1, np.int64)
            np.cumsum(~white & np.concatenate([[True], white[:-1]]), out=begun[1:])
            ends = np.array(cuts(data))
            begins = np.concatenate([[0], ends[:-1]])
            found = np.array([xxhash.xxh3_64_intdigest(text[a:b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)], np.uint64).view(np.int64)
            again = np.ones(len(found), np.int64)
            again[np.unique(found, return_index=True)[1]] = 0
            places.append(begins << 17 | again << 16 | ends - begins << 8 | begun[ends] - begun[begins])
            digests.append(found)
        return record_batch(CHUNKS, [batch.column(0), batch.column(1), places, digests])

    return map_batches(named(documents).select("doc", "holder", "text"), lambda: work, CHUNKS, rows=256)


SPANS = "doc_id long, text_key long, start long, stop long, n_words long, n_chunks long, first_doc_id long, keep boolean"


def spans_of(holder: int, shared: list[tuple[int, int]], min_words: int) -> list[tuple[int, int, int, int, int, bool]]:
    """(start, stop, words, chunks, first holder, keep) from a document's shared chunks (place, first holder). Where a span may be
    cut, the words of its whole run count, as a passage isn't shorter for having several first holders."""
    out, run = [], []

    def close():
        words = sum(x[2] for x in run)
        out.extend((*x, first) for *x, first in run if (x[2] if first else words) >= min_words)
        run.clear()

    for place, by in sorted(shared):
        start, size, words, first = place >> 17, place >> 8 & 255, place & 255, by == holder and not place >> 16 & 1
        if run and run[-1][1] != start:
            close()
        if run and run[-1][5] == first:
            last = run[-1]
            last[1], last[2], last[3], last[4] = start + size, last[2] + words, last[3] + 1, min(last[4], by)
        else:
            run.append([start, start + size, words, 1, by, first])
    close()
    return out


def repeated_spans(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """A row for each span of a document that stands elsewhere too: doc_id, text_key, start, stop, n_words, n_chunks,
    first_doc_id (the smallest that holds one of its chunks) and keep (whether all its chunks stand here in their first place; if not,
    none does, and the span may be cut).

    Digests go through one combining sum, written, and one join, which adaptive execution may split at a digest that a third of all
    documents hold; what is then gathered is one document's shared chunks, once however often its row repeats. Chunks are cut
    once for each of the two, as that costs less than a table of all of them."""
    scratch = Scratch(documents.sparkSession)
    flat = lambda *c: chunks(documents).select(*c, F.explode(F.arrays_zip("place", "digest")).alias("x")).select(*c, "x.*")
    shared = flat("holder").groupBy("digest").agg(F.min("holder").alias("first"), F.max("holder").alias("last"), F.max(F.col("place").bitwiseAND(1 << 16)).alias("again")).filter("first <> last or again > 0")
    shared = scratch.save(shared.select("digest", "first"))
    held = flat("doc").join(shared, "digest").groupBy("doc").agg(F.collect_set(F.struct("place", "first")).alias("shared"))
    held = held.join(named(documents).select("doc", "holder", "key").distinct(), "doc").select("holder", "key", "shared")

    def work(batch):
        out = []
        known = lambda h: h if h < NAMELESS else None
        for holder, key, found in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            spans = spans_of(holder, [(x["place"], x["first"]) for x in found], min_words)
            out += [(known(holder), key, a, b, words, n, known(first), keep) for a, b, words, n, first, keep in spans]
        return record_batch(SPANS, [[x[i] for x in out] for i in range(8)])

    return map_batches(held, lambda: work, SPANS, rows=256)


def op9_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return repeated_spans(table(spark, sf_dir, "documents"))
