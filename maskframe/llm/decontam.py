"""Benchmark decontamination by the q-gram lemma: shared q-grams in overlapping diagonal bands, then banded alignment.

A passage of m characters within k edits of a text keeps m - q + 1 - k q of its q-grams, and they lie on k + 1
neighbouring diagonals. Bands of 2 (k + 1) diagonals, each overlapping the next by half, hold any such range whole, so
a band with fewer shared q-grams cannot match; the others are aligned within the band, all bands of a batch at once.
Texts and items are compared with A-Z lower-cased, white space as single spaces, and a space at both ends.

One rule holds for items of any length: an item's parts are its windows of PART characters (the item itself, if it is no longer), one
every PART / 2 and one at its end, and a text holds the item if it holds a part with an edit for each CHARS_PER_EDIT of the part's
characters at most. So what makes a match of a longer item is a stretch of the same length in any item, and one more character
changes nothing. A text with the whole item holds it where the edits of some part are within that part's share. Edits are never
so many that the lemma asks for no q-gram: parts under 2 q characters must stand exactly, as whole words. Items under q characters
are looked up as phrases.

Edge cases: empty and null items never match; null and empty texts match nothing; repeated items count once, repeated documents
repeat; items without an id are searched and have a row each with a null item_id, unless an item with an id has the same text;
ties go to the fewest edits, then the first place; an empty table on either side gives an empty result; only doc_id, text and
item_id, text are read, and other columns may have any name. Offsets count bytes of the normal text, and leave its end spaces out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, record_batch, table, texts_of

Q = 10
#: Characters of a part.
PART = 120
#: Characters for each edit that a match may have.
CHARS_PER_EDIT = 12
#: Bytes of items in one broadcast index; a larger benchmark is searched in several passes.
BLOCK_BYTES = 8 << 20
#: Shared q-grams that are counted at once.
HITS = 1 << 20
_BITS = 22
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xC2B2AE3D27D4EB4F


def normal(text: bytes) -> bytes:
    return b" %s " % b" ".join(text.lower().split())


def grams(data: np.ndarray) -> np.ndarray:
    """A hash of the q-gram at each place, built by doubling; equal q-grams have equal hashes."""
    n, out, done = len(data) - Q + 1, None, 0
    if n < 1:
        return np.empty(0, np.uint64)
    runs, size, rest = data.astype(np.uint64) + np.uint64(1), 1, Q
    while rest:
        if rest & 1:
            part = runs[done : done + n]
            out = part if out is None else out * np.uint64(pow(_BASE, size, 1 << 64)) + part
            done += size
        if rest > 1:
            runs = runs[:-size] * np.uint64(pow(_BASE, size, 1 << 64)) + runs[size:]
        size, rest = 2 * size, rest >> 1
    return out * _SPREAD


def budget(m: int, chars_per_edit: int = CHARS_PER_EDIT) -> int:
    """The edits allowed, so few that the lemma asks for one shared q-gram at least; a text's end spaces aren't the item's."""
    return max(0, min((m - 2) // chars_per_edit, (m - Q) // Q))


def parts_of(text: bytes) -> list[bytes]:
    """The item's windows of PART characters: one every half of that, and the last at its end."""
    last = max(0, len(text) - PART)
    return [text[a : a + PART] for a in (*range(0, last, PART // 2), last)]


class Index:
    def __init__(self, items: list[tuple[int, bytes]], chars_per_edit: int = CHARS_PER_EDIT):
        self.short: dict[bytes, list[int]] = {}
        parts: list[tuple[int, bytes]] = []
        for item, text in items:
            if 2 < len(text) < Q:
                self.short.setdefault(text[1:-1], []).append(item)
            elif len(text) > 2:
                parts += [(item, s) for s in parts_of(text)]
        self.lengths = sorted({t.count(b" ") + 1 for t in self.short})
        self.items, self.parts = np.array([i for i, _ in parts], np.int64), [np.frombuffer(s, np.uint8) for _, s in parts]
        self.size = np.array([len(s) for s in self.parts], np.int64)
        self.edits = np.array([budget(len(s), chars_per_edit) for s in self.parts], np.int64)
        codes = [grams(s) for s in self.parts]
        code = np.concatenate([*codes, np.empty(0, np.uint64)])
        order = code.argsort(kind="stable")
        self.code = code[order]
        self.part = np.repeat(np.arange(len(codes), dtype=np.int32), [len(c) for c in codes])[order]
        self.place = np.concatenate([*(np.arange(len(c)) for c in codes), np.empty(0, np.int64)]).astype(np.int32)[order]
        self.known = np.zeros(1 << _BITS, bool)
        self.known[self.code >> np.uint64(64 - _BITS)] = True

    def bands(self, data: np.ndarray) -> np.ndarray:
        """(part, first diagonal) of each band with as many shared q-grams as the lemma asks for."""
        code = grams(data)
        at = np.flatnonzero(self.known[code >> np.uint64(64 - _BITS)])
        lo, hi = np.searchsorted(self.code, code[at], "left"), np.searchsorted(self.code, code[at], "right")
        n = hi - lo
        if not n.sum():
            return np.empty((0, 2), np.int64)
        counted = []
        # in pieces of about HITS shared q-grams, as repetitive texts and items share a multiple of their length
        ends = np.unique(np.concatenate([np.searchsorted(n.cumsum(), np.arange(HITS, n.sum(), HITS)) + 1, [len(n)]]))
        for i, j in zip([0, *ends], ends, strict=False):
            some = n[i:j]
            hit = np.repeat(lo[i:j] - np.concatenate([[0], some.cumsum()[:-1]]), some) + np.arange(some.sum())
            where, part = np.repeat(at[i:j], some), self.part[hit].astype(np.int64)
            band = (where - self.place[hit]) // (self.edits[part] + 1)  # from -m on
            counted.append(np.unique(np.concatenate([part << 40 | band + (1 << 30), part << 40 | band - 1 + (1 << 30)]), return_counts=True))
        keys, back = np.unique(np.concatenate([k for k, _ in counted]), return_inverse=True)
        counts = np.bincount(back, np.concatenate([c for _, c in counted]))
        part, band = keys >> 40, (keys & (1 << 40) - 1) - (1 << 30)
        fit = counts >= self.size[part] - Q + 1 - self.edits[part] * Q
        return np.stack([part[fit], band[fit] * (self.edits[part[fit]] + 1)], axis=1)

    def search(self, texts: list[bytes]) -> list[tuple[int, int, int, int, int]]:
        """(index of the text, item, edits, start, end) of the best place of each item in each text."""
        found: dict[tuple[int, int], tuple[int, int, int]] = {}
        wanted, docs = [], []
        for k, text in enumerate(texts):
            text = normal(text)
            if self.short:
                self.phrases(k, text, found)
            data = np.frombuffer(text, np.uint8)
            docs.append(data)
            wanted += [(k, p, d) for p, d in (self.bands(data).tolist() if len(self.code) else ())]
        for i in range(0, len(wanted), 512):
            some = wanted[i : i + 512]
            for (k, p, d), (edits, start, end) in zip(some, self.align(docs, some), strict=True):
                if edits <= self.edits[p]:
                    a, b = max(0, d + start), min(len(docs[k]), d + end)
                    a, b = a + (docs[k][a] == 32), b - (docs[k][b - 1] == 32)
                    key, place = (k, int(self.items[p])), (edits, a - 1, b - 1)
                    found[key] = min(place, found.get(key, place))
        return sorted((k, item, *x) for (k, item), x in found.items())

    def phrases(self, k: int, text: bytes, found: dict) -> None:
        """The first place of each item that is looked up as a whole phrase."""
        words = text.split()
        starts = np.cumsum([0, *(len(w) + 1 for w in words)]).tolist()
        for n in self.lengths:
            for i in range(len(words) - n + 1):
                for item in self.short.get(b" ".join(words[i : i + n]), ()):
                    place = (0, starts[i], starts[i + n] - 1)
                    found[k, item] = min(place, found.get((k, item), place))

    def align(self, docs: list[np.ndarray], wanted: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """For each (text, part, first diagonal) the fewest edits of the whole part along the band, and the stretch, from the first diagonal."""
        sizes = np.array([self.size[p] for _, p, _ in wanted])
        widths = np.array([2 * (self.edits[p] + 1) for _, p, _ in wanted])
        rows, wide = int(sizes.max()), int(widths.max())
        part = np.zeros((len(wanted), rows), np.uint8)
        text = np.full((len(wanted), rows + wide), 255, np.uint8)  # no byte of UTF-8
        for c, (k, p, d) in enumerate(wanted):
            part[c, : sizes[c]] = self.parts[p]
            piece = docs[k][max(0, d) : d + rows + wide]
            text[c, max(0, -d) : max(0, -d) + len(piece)] = piece
        # a cell holds its cost above the diagonal on which it began
        one, far = 1 << 16, 1 << 40
        steps = np.arange(wide, dtype=np.int64) * one
        cost = np.where(np.arange(wide) < widths[:, None], np.arange(wide, dtype=np.int64), far)
        out: list = [None] * len(wanted)
        ends: dict[int, list[int]] = {}
        for c, m in enumerate(sizes.tolist()):
            ends.setdefault(m, []).append(c)
        shut = np.arange(wide) >= widths[:, None]
        for i in range(1, rows + 1):
            best = cost + np.where(text[:, i - 1 : i - 1 + wide] != part[:, i - 1 : i], one, 0)
            np.minimum(best[:, :-1], cost[:, 1:] + one, out=best[:, :-1])
            cost = np.minimum.accumulate(best - steps, axis=1) + steps
            cost[shut] = far
            for c in ends.get(i, ()):
                j = int((cost[c] // one).argmin())
                out[c] = (int(cost[c, j]) // one, int(cost[c, j]) % one, j + i)
        return out


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, bytes]]]:
    """Distinct items in blocks of bounded size; the driver holds one block at a time."""
    block, size = [], 0
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text is not null").distinct()
    named = items.filter("item_id is not null")
    items = named.unionByName(items.filter("item_id is null").join(named.select("text").distinct(), "text", "left_anti"))
    for r in items.orderBy("item_id", "text").toLocalIterator():
        text = normal(r.text.encode())
        block.append((r.item_id, text))
        size += len(text)
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def numbered(block: list[tuple[int | None, bytes]]) -> tuple[list[tuple[int, bytes]], set[int]]:
    """The block with a number of its own for each item without an id, and these numbers."""
    ids = {i for i, _ in block}
    free = (i for i in count(-1, -1) if i not in ids)
    items = [(next(free) if i is None else i, text) for i, text in block]
    return items, {i for i, _ in items} - ids


SCHEMA = "doc_id long, item_id long, edits long, start long, end long"


def contaminations(documents: DataFrame, benchmark: DataFrame, chars_per_edit: int = CHARS_PER_EDIT) -> DataFrame:
    """A row for each document and item that it holds: the fewest edits and the stretch of the normal text."""
    spark, out = documents.sparkSession, None
    for block in blocks(benchmark):
        sent = spark.sparkContext.broadcast(block)

        def start(sent=sent):
            items, nameless = numbered(sent.value)
            index = Index(items, chars_per_edit)

            def work(batch):
                found = index.search(texts_of(batch.column(1)))
                ids = [None if f[1] in nameless else f[1] for f in found]
                return record_batch(SCHEMA, [batch.column(0).take(pa.array([f[0] for f in found], pa.int64())), ids, *([f[i] for f in found] for i in range(2, 5))])

            return work

        part = map_batches(documents.select(F.col("doc_id").cast("long"), "text"), start, SCHEMA, rows=256)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], SCHEMA) if out is None else out


def decontaminated(documents: DataFrame, benchmark: DataFrame, chars_per_edit: int = CHARS_PER_EDIT) -> DataFrame:
    """The documents that hold no item, with all columns; one map for each block of items, no shuffle."""
    at = documents.columns.index("text")
    for block in blocks(benchmark):
        sent = documents.sparkSession.sparkContext.broadcast(block)

        def start(sent=sent):
            index = Index(numbered(sent.value)[0], chars_per_edit)

            def work(batch):
                held = {f[0] for f in index.search(texts_of(batch.column(at)))}
                return batch.filter(pa.array([k not in held for k in range(batch.num_rows)], pa.bool_()))

            return work

        documents = map_batches(documents, start, documents.schema, rows=256)
    return documents


def op4_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
