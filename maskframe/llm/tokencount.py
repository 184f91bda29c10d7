"""Token counts from two tiers: a broadcast table of frequent pre-tokens' lengths, then exact encoding remembered by worker.

Which pre-tokens are frequent is counted over all documents: each task keeps the MOST pre-tokens that occur oftest by the
frequent-items summary of Misra and Gries (when a task's counts exceed KEPT entries, the least are lowered away, so what
stands for more than a share of 1 / MOST of a task's pre-tokens is never lost), and emits one row. Summaries meet pairwise in a
tree of FAN by FAN merges; no row is a pre-token, and none is shuffled by one. The driver gets a single summary of MOST
entries, encodes each, and broadcasts their bytes and lengths. A worker looks there first; keys are compared whole, so a hit is
the pre-token itself. Misses are encoded exactly and remembered by the worker, within a bound. Counts don't depend on the table.

Edge cases: null and empty texts have 0 bytes and 0 tokens; strings of special tokens in a text count as one token each;
texts are counted whole; those with code points that Python's Unicode tables don't assign are split by the tokenizer library's own
tables; repeated rows repeat; an empty table gives an empty result; only doc_id and text are read, and other
columns may have any name.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from itertools import islice

import pyarrow as pa
import regex
import tiktoken
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

from .bpe import byte_letters, newer, tokenizer_json
from .common import Scratch, kept, map_batches, record_batch, slices, table

PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)
_ANY = regex.compile(PRE_TOKENS)
_LIBRARY = pre_tokenizers.Split(Regex(PRE_TOKENS), "isolated")
#: Pre-tokens of the broadcast table; those that a task counts at once; summaries that one merge takes.
MOST, KEPT, FAN = 8192, 1 << 17, 64
#: Pre-tokens that a worker remembers at most, and the longest of them in characters.
CACHE_WORDS, CACHE_CHARS = 300_000, 64


def pre_tokens(text: str) -> list[str]:
    if text.isascii():
        return _ASCII.findall(text)
    return [w for w, _ in _LIBRARY.pre_tokenize_str(text)] if newer(text) else _ANY.findall(text)


def ranks_of(spec: dict) -> dict[bytes, int]:
    """The vocabulary of a byte-level tokenizer as bytes; its ids are in the order of its merges."""
    byte = {c: b for b, c in enumerate(byte_letters())}
    special = {x["content"] for x in spec["added_tokens"]}
    return {bytes([byte[c] for c in t]): i for t, i in spec["model"]["vocab"].items() if t not in special}


def lowered(counts: Counter, most: int) -> Counter:
    """The `most` largest counts, all lowered by the largest that goes."""
    if len(counts) <= most:
        return counts
    ranked = counts.most_common(most + 1)
    less = ranked[-1][1]
    return Counter({w: n - less for w, n in ranked[:most] if n > less})


SUMMARY = "words array<string>, counts array<long>"


def summaries(documents: DataFrame, most: int = MOST) -> DataFrame:
    """A row for each task: its frequent pre-tokens and lower bounds of their counts."""

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for part in slices(batch, 256):
                for text in part.column(0).to_pylist():
                    if text:
                        counts.update(pre_tokens(text))
                if len(counts) > KEPT:
                    counts = lowered(counts, KEPT // 2)
        top = [x for x in lowered(counts, most).most_common() if len(x[0]) <= CACHE_CHARS]
        yield record_batch(SUMMARY, [[[w for w, _ in top]], [[n for _, n in top]]])

    return documents.select(F.col("text").cast("string")).mapInArrow(run, SUMMARY)


def merged(table: pa.Table, most: int = MOST) -> pa.Table:
    """One summary of several."""
    counts: Counter = Counter()
    for words, numbers in zip(table["words"].to_pylist(), table["counts"].to_pylist(), strict=True):
        counts.update(dict(zip(words, numbers, strict=True)))
    top = lowered(counts, most).most_common()
    return pa.Table.from_batches([record_batch(SUMMARY, [[[w for w, _ in top]], [[n for _, n in top]]])])


def frequent(documents: DataFrame, most: int = MOST) -> list[str]:
    """The most frequent pre-tokens of all documents, the commonest first, through a tree of merges."""
    scratch = Scratch(documents.sparkSession)
    found = scratch.save(summaries(documents, most))
    while (n := found.count()) > 1:
        dealt = found.withColumn("node", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(-(-n // FAN))))
        last, found = found, scratch.save(dealt.groupBy("node").applyInArrow(lambda t: merged(t, most), SUMMARY))
        scratch.drop(last)
    rows = found.collect()
    scratch.drop(found)
    counts: Counter = Counter()
    for r in rows:
        counts.update(dict(zip(r["words"], r["counts"], strict=True)))
    return sorted(lowered(counts, most), key=lambda w: (-counts[w], w))


def core(ranks: dict[bytes, int]):
    """The exact encoder of one pre-token's bytes."""
    return tiktoken.Encoding("counts", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece


class Lengths(dict):
    """The first tier: the broadcast table's pre-tokens and their lengths. What isn't there comes from the second."""

    def __init__(self, ranks: dict[bytes, int], table: tuple[bytes, list[int], list[int]]):
        data, ends, lengths = table
        super().__init__(zip((data[a:b].decode() for a, b in zip([0, *ends], ends, strict=False)), lengths, strict=True))
        self.encode, self.cache = core(ranks), {}

    def __missing__(self, word: str) -> int:
        n = self.cache.get(word)
        if n is None:
            n = len(self.encode(word.encode()))
            if len(word) <= CACHE_CHARS:
                if len(self.cache) >= CACHE_WORDS:  # frequent pre-tokens come early: the first half stays
                    self.cache = dict(islice(self.cache.items(), CACHE_WORDS // 2))
                self.cache[word] = n
        return n


def compact(words: list[str], ranks: dict[bytes, int]) -> tuple[bytes, list[int], list[int]]:
    """The table as it is broadcast: the pre-tokens' bytes, where each ends, and its tokens."""
    encode, data = core(ranks), [w.encode() for w in words]
    ends, at = [], 0
    for x in data:
        at += len(x)
        ends.append(at)
    return b"".join(data), ends, [len(encode(x)) for x in data]


class Tokens:
    def __init__(self, ranks: dict[bytes, int], special: list[str], table: tuple[bytes, list[int], list[int]]):
        self.lengths = Lengths(ranks, table)
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

    def count(self, text: str) -> int:
        find = self.lengths.__getitem__
        if self.special and "<|" in text and len(parts := self.special.split(text)) > 1:
            return len(parts) // 2 + sum(find(w) for part in parts[::2] for w in pre_tokens(part))
        return sum(map(find, pre_tokens(text)))


SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def token_counts(documents: DataFrame, tokenizer: str, limit: int = 1024) -> DataFrame:
    """For each row its bytes, its tokens and whether they exceed the limit. Two maps; only summaries of tasks are shuffled, where
    there are more than FAN of them."""
    spec = json.loads(tokenizer)
    ranks = ranks_of(spec)
    table = compact(frequent(documents), ranks)
    sent = documents.sparkSession.sparkContext.broadcast((ranks, [x["content"] for x in spec["added_tokens"]], table))
    key = xxhash.xxh3_64_intdigest(tokenizer.encode() + table[0])

    def start():
        tokens = kept(("counts", key), lambda: Tokens(*sent.value))

        def work(batch):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            n = [tokens.count(t) for t in texts]
            return record_batch(SCHEMA, [batch.column(0), [len(t.encode()) for t in texts], n, [x > limit for x in n]])

        return work

    return map_batches(documents.select(F.col("doc_id").cast("long"), "text"), start, SCHEMA, rows=256)


def op6_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_json("byte_bpe_50k.json"))
