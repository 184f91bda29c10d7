"""Ranked lexical search by sort-based accumulation.

The items, in blocks of bounded size, become a table of their terms: for each term the items that hold it and how often. Two scans
of the documents answer a block. The first counts documents, terms, and the documents of each of the block's terms; a task emits a
row for each term it met, and these are summed. The second makes, for each matched term of each document, an array of (item,
document) keys and their impact. A task gathers these arrays until it has FLUSH entries, concatenates them, sorts the packed keys by
radix (16 bits at a time), and adds up the runs of equal keys with reduceat. Of an item's sums only those that still beat the task's
own best K go on a heap. The tasks' winners, K an item at most, are range-partitioned by item and part, selected by heap, and
range-partitioned by item for the last selection.

No document meets an item with which it shares no term, no list of an item's documents exists anywhere, and all weights are integers
of 64 bits, so ranks don't depend on how rows are dealt.

Edge cases: null and empty texts and those without a term count in neither N nor L and are never found; null or termless items have
no results; each row of the items is an item, so repeated rows repeat their results, and so do documents' rows (each is a document);
equal scores go by ascending doc_id, null last; long texts are read whole; empty tables give an empty result; only doc_id, text and
item_id are read, and other columns may have any name.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from heapq import heappush, heappushpop

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, freed, kept, record_batch, slices, table, texts_of

#: Results of an item; bytes of the items' texts in a block; entries that a task sorts at once; parts of the first selection.
K, BLOCK_BYTES, FLUSH, PARTS = 10, 8 << 20, 1 << 21, 16
# Fixed values of the ranking.
SCALE, SATURATION, UNIT, LENGTH_SHARE = 1_000_000_000, 8, 1000, 75

#: What isn't a letter or digit of ASCII, or a byte of another character, parts terms; A-Z become a-z.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def blocks(items: DataFrame, most: int = BLOCK_BYTES) -> Iterator[list[tuple[int | None, bytes]]]:
    """The items in blocks of about `most` bytes, one at the driver at a time."""
    named = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    block, size = [], 0
    for r in named.toLocalIterator():
        block.append((r[0], r[1].encode()))
        size += len(block[-1][1])
        if size >= most:
            yield block
            block, size = [], 0
    if block:
        yield block


class Terms:
    """A block's terms, numbered, and for each the items (by place in the block) that hold it, each as often as it does."""

    def __init__(self, block: list[tuple[int | None, bytes]]):
        held: dict[bytes, tuple[list[int], list[int]]] = {}
        for k, (_, text) in enumerate(block):
            for term, n in Counter(terms(text)).items():
                items, times = held.setdefault(term, ([], []))
                items.append(k)
                times.append(n)
        self.number = {term: j for j, term in enumerate(held)}
        self.items = [np.array(i, np.int64) for i, _ in held.values()]
        self.times = [np.array(n, np.int64) for _, n in held.values()]


COUNTS = "term int, n long"


def counted(texts: DataFrame, sent, key: int) -> DataFrame:
    """(term, documents that hold it), and in rows -1 and -2 the documents with a term and all their terms."""

    def run(batches):
        freed()
        number = kept(("lexical", key), lambda: Terms(sent.value)).number
        df, docs, total = np.zeros(len(number), np.int64), 0, 0
        for batch in batches:
            for part in slices(batch, 256):
                for text in texts_of(part.column(1)):
                    words = terms(text)
                    docs, total = docs + bool(words), total + len(words)
                    df[[number[w] for w in number.keys() & set(words)]] += 1
        met = np.flatnonzero(df)
        yield record_batch(COUNTS, [[-1, -2, *met.tolist()], [docs, total, *df[met].tolist()]])

    return texts.mapInArrow(run, COUNTS).groupBy("term").agg(F.sum("n").alias("n"))


def radix_order(keys: np.ndarray) -> np.ndarray:
    """The stable order of keys of 0 or more, by digits of 16 bits, for which numpy sorts by radix."""
    order, top, shift = np.arange(len(keys)), int(keys.max(initial=0)), 0
    while top >> shift:
        digit = ((keys[order] >> shift) & 0xFFFF).astype(np.uint16)
        order, shift = order[np.argsort(digit, kind="stable")], shift + 16
    return order


class Accumulator:
    """Sums of impacts by item and document, and each item's best K."""

    def __init__(self, items: int, k: int):
        self.k, self.best = k, [[] for _ in range(items)]
        self.floor = np.ones(items, np.int64)  # scores below can't be among an item's best
        self.clear()

    def clear(self):
        self.keys, self.impacts, self.ids, self.size = [], [], [], 0

    def add(self, doc: int | None, impacts: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """A document's arrays of items and impacts, one for each term."""
        at = len(self.ids)
        self.ids.append(doc)
        for items, impact in impacts:
            self.keys.append(items << 32 | at)
            self.impacts.append(impact)
            self.size += len(items)
        if self.size >= FLUSH:
            self.flush()

    def flush(self) -> None:
        if self.size:
            keys = np.concatenate(self.keys)
            order = radix_order(keys)
            keys = keys[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            sums, keys = np.add.reduceat(np.concatenate(self.impacts)[order], first), keys[first]
            items = keys >> 32
            fit = sums >= self.floor[items]
            for item, at, score in zip(items[fit].tolist(), (keys[fit] & 0xFFFFFFFF).tolist(), sums[fit].tolist(), strict=True):
                self.floor[item] = put(self.best[item], score, self.ids[at], self.k)
        self.clear()


def put(heap: list, score: int, doc: int | None, k: int) -> int:
    """Puts a result on the heap of the best k; what a score must reach now."""
    entry = (score, doc is not None, -(doc or 0))
    if len(heap) < k:
        heappush(heap, entry)
    else:
        heappushpop(heap, entry)
    return heap[0][0] if len(heap) == k else 1


def rows_of(heap: list) -> list[tuple[int, int | None]]:
    """A heap's (score, doc_id), the best first."""
    return [(score, -doc if named else None) for score, named, doc in sorted(heap, reverse=True)]


FOUND = "item int, score long, doc_id long"


def scored(texts: DataFrame, sent, key: int, df: dict[int, int], k: int) -> DataFrame:
    """Each task's best k documents of each of the block's items. df: from term to documents, -1 all documents, -2 all terms."""
    n_docs, all_terms = df.get(-1, 0), df.get(-2, 0)
    weights = {t: math.floor(UNIT * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items() if t >= 0}

    def run(batches):
        freed()
        block = kept(("lexical", key), lambda: Terms(sent.value))
        known, worth = block.number, [times * weights.get(t, 0) for t, times in enumerate(block.times)]
        found = Accumulator(len(sent.value), k)
        for batch in batches:
            for part in slices(batch, 256):
                for doc, text in zip(part.column(0).to_pylist(), texts_of(part.column(1)), strict=True):
                    words = terms(text)
                    counts = Counter(w for w in words if w in known)
                    if counts:
                        m = 100 - LENGTH_SHARE + (LENGTH_SHARE * len(words) * n_docs) // all_terms
                        found.add(doc, [(block.items[t], worth[t] * (SCALE * tf // (UNIT * tf + SATURATION * m))) for t, tf in ((known[w], tf) for w, tf in counts.items())])
        found.flush()
        rows = [(item, *r) for item, heap in enumerate(found.best) for r in rows_of(heap)]
        yield record_batch(FOUND, [list(c) for c in zip(*rows, strict=True)] if rows else [[]] * 3)

    return texts.mapInArrow(run, FOUND)


def selected(found: DataFrame, k: int) -> DataFrame:
    """The best k of each item within each partition, by heap."""

    def run(batches):
        heaps: dict[int, list] = {}
        for batch in batches:
            for item, score, doc in zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True):
                put(heaps.setdefault(item, []), score, doc, k)
        rows = [(item, *r, i + 1) for item, heap in heaps.items() for i, r in enumerate(rows_of(heap))]
        yield record_batch(FOUND + ", rank int", [list(c) for c in zip(*rows, strict=True)] if rows else [[]] * 4)

    return found.select("item", "score", "doc_id").mapInArrow(run, FOUND + ", rank int")


def ranked(documents: DataFrame, items: DataFrame, k: int = K, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Each item's k best documents (item_id, rank, doc_id, score). A block of items takes two scans of the documents."""
    spark, out = documents.sparkSession, None
    scratch = Scratch(spark)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    for block in blocks(items, block_bytes):
        sent, key = spark.sparkContext.broadcast(block), xxhash.xxh3_64_intdigest(repr(block).encode())
        df = {r["term"]: r["n"] for r in counted(texts, sent, key).collect()}  # a row for each of the block's terms
        # written, as ranges are sampled before they are dealt, and a scan isn't to run twice for that
        found = scratch.save(scored(texts, sent, key, df, k)).withColumn("part", F.pmod(F.xxhash64("doc_id", "score"), F.lit(PARTS)))
        best = selected(selected(found.repartitionByRange("item", "part"), k).repartitionByRange("item"), k)
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], "item int, item_id long")
        part = scratch.save(best.join(names, "item").select("item_id", "rank", "doc_id", "score"))
        sent.unpersist()
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out


def op13_ranked_search(spark, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
s AS (SELECT count(*) AS n_docs, sum(len(t))::BIGINT AS total FROM d WHERE len(t) > 0),
tf AS (SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(t) AS term FROM d) GROUP BY 1, 2),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*)::DOUBLE AS df FROM tf GROUP BY 1), s),
q AS (SELECT k, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT row_number() OVER () AS k, item_id, text FROM benchmark)),
m AS (SELECT k, doc_id, 100 - 75 + (75 * len(t) * n_docs) // total AS m FROM d, s WHERE len(t) > 0),
x AS (SELECT q.k AS i, any_value(item_id) AS item_id, any_value(doc_id) AS doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m ON m.k = tf.k GROUP BY q.k, tf.k),
r AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM x WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM r WHERE rank <= 10"""
