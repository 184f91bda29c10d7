"""Byte-pair encoding by speculation: longest matches propose tokens, pair checks accept them, only failing words are merged exactly.

A sequence of tokens is what exact merging gives if and only if each adjacent pair stays apart when merged alone. That
is decided for all pairs of a batch at once: walk down the merge trees of both tokens along the seam and look whether a
merge across it would have come earlier than the one that built the side. Words are remembered by worker, within a bound.

Edge cases: null and empty texts have no tokens; strings of special tokens inside a text become those tokens; texts are
encoded whole, words of any length too (the exact merge takes n log n); texts with code points that Python's Unicode tables don't
assign are split into words by the tokenizer library's own tables; repeated rows repeat; an empty table gives an
empty result; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex, normalizers, pre_tokenizers

from .common import kept, map_batches, record_batch, table

#: Words that a worker remembers at most, and the longest of them in characters.
CACHE_WORDS, CACHE_CHARS = 300_000, 64
END = "</w>"
_ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
_WORDS = regex.compile(WORDS)
_LIBRARY_NORMAL = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
_LIBRARY_WORDS = pre_tokenizers.Split(Regex(WORDS), "removed", invert=True)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in plain}
    letters |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in letters)}
    return [letters[b] for b in range(256)]


class Bpe:
    """An encoder for the JSON of a BPE tokenizer whose tokens are numbered in the order of their merges."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.end = model["end_of_word_suffix"] or ""
        self.tokens = [""] * (max([*self.vocab.values(), *self.special.values()]) + 1)
        for t, i in [*self.vocab.items(), *self.special.items()]:
            self.tokens[i] = t
        self.letters = byte_letters()
        n = len(self.tokens)
        # children of each merged token (itself if it is none), and what each pair merges into
        self.first, self.second = np.arange(n), np.arange(n)
        self.merged: dict[tuple[int, int], int] = {}
        for pair in model["merges"]:
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            x, y, z = self.vocab[a], self.vocab[b], self.vocab[a + b]
            if self.merged and z <= last:
                raise ValueError("tokens aren't numbered in the order of their merges")
            last = self.merged[x, y] = z
            self.first[z], self.second[z] = x, y
        self.pair_keys = np.array([a << 32 | b for a, b in self.merged], np.int64)
        order = self.pair_keys.argsort()
        self.pair_keys, self.pair_ids = self.pair_keys[order], np.array(list(self.merged.values()), np.int64)[order]
        whole = np.flatnonzero(self.first != np.arange(n))
        sound = self.apart(self.first[whole], self.second[whole], whole)
        self.proposals = {t: i for t, i in self.vocab.items()}
        for i in whole[~sound]:
            del self.proposals[self.tokens[i]]
        # the longest token that begins with two given letters
        self.reach: dict[str, int] = {}
        for t in self.proposals:
            self.reach[t[:2]] = max(self.reach.get(t[:2], 0), len(t))
        self.cache: dict[str, tuple[str, str]] = {}

    def merge_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The token that each pair merges into, or a number above all."""
        keys = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ids[at], 1 << 40)

    def apart(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether each pair of tokens stays apart, as far as merges before `limit` go."""
        out, live = np.ones(len(a), bool), np.arange(len(a))
        a, b = a.astype(np.int64), b.astype(np.int64)
        limit = np.full(len(a), 1 << 40) if limit is None else limit.astype(np.int64)
        while len(live):
            met = self.merge_of(a, b) < limit
            out[live[met]] = False
            # go back in time: undo the later of both sides' merges; a merge of the left side at the same rank comes first
            leaf_a, leaf_b = self.second[a] == a, self.first[b] == b
            left = ~leaf_a & (leaf_b | (a > b))
            going = ~met & ~(leaf_a & leaf_b)
            limit = np.where(left, a, b + 1)
            a, b = np.where(left, self.second[a], a), np.where(left, b, self.first[b])
            live, a, b, limit = live[going], a[going], b[going], limit[going]
        return out

    def symbols(self, word: str) -> str:
        return word if word.isascii() and word.isalnum() else "".join([self.letters[b] for b in word.encode()])

    def speculate(self, symbols: str) -> list[int]:
        """Longest matches from the left."""
        find, n, at, out = self.proposals.get, len(symbols), 0, []
        t = find(symbols + self.end)
        if t is not None:
            return [t]
        while at < n:
            for to in range(min(n, at + self.reach.get(symbols[at : at + 2], 1)), at, -1):
                t = find(symbols[at:to] + self.end if to == n else symbols[at:to])
                if t is not None:
                    break
            else:
                raise ValueError(f"no token for {symbols[at]!r}")
            out.append(t)
            at = to
        return out

    def exact(self, symbols: str) -> list[int]:
        """Merging by rank, leftmost first."""
        ids = [self.vocab[c] for c in symbols[:-1]] + [self.vocab[symbols[-1] + self.end]]
        return self.merge_all(ids) if len(ids) > 40 else self.merge_few(ids)

    def merge_few(self, ids: list[int]) -> list[int]:
        find, far = self.merged.get, 1 << 40
        merges = [find(p, far) for p in zip(ids, ids[1:])]  # noqa: B905
        while merges and (m := min(merges)) < far:
            i = merges.index(m)
            ids[i : i + 2] = [m]
            del merges[i]
            if i:
                merges[i - 1] = find((ids[i - 1], m), far)
            if i < len(merges):
                merges[i] = find((m, ids[i + 1]), far)
        return ids

    def merge_all(self, ids: list[int]) -> list[int]:
        """For long words: a heap over a linked list."""
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        find = self.merged.get
        heap = [(m, i) for i in range(len(ids) - 1) if (m := find((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            m, i = heapq.heappop(heap)
            if ids[i] < 0 or (j := after[i]) >= len(ids) or find((ids[i], ids[j])) != m:
                continue
            ids[i], ids[j], after[i] = m, -1, after[j]
            if after[i] < len(ids):
                before[after[i]] = i
                if (m := find((ids[i], ids[after[i]]))) is not None:
                    heapq.heappush(heap, (m, i))
            if before[i] >= 0 and (m := find((ids[before[i]], ids[i]))) is not None:
                heapq.heappush(heap, (m, before[i]))
        return [x for x in ids if x >= 0]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        symbols = [self.symbols(w) for w in words]
        guesses = [self.speculate(s) for s in symbols]
        many = [k for k, g in enumerate(guesses) if len(g) > 1]
        if many:
            flat = np.array([t for k in many for t in guesses[k]], np.int64)
            owner = np.repeat(many, [len(guesses[k]) for k in many])
            inner = owner[1:] == owner[:-1]
            a, b, owner = flat[:-1][inner], flat[1:][inner], owner[1:][inner]
            keys, back = np.unique(a << 32 | b, return_inverse=True)
            good = self.apart(keys >> 32, keys & 0xFFFFFFFF)[back]
            for k in np.unique(owner[~good]).tolist():
                guesses[k] = self.exact(symbols[k])
        return guesses

    def learn(self, words: set[str]) -> list[str]:
        """Adds what isn't known yet; returns the words too long to keep."""
        if len(self.cache) > CACHE_WORDS:  # frequent words come early: the first half stays
            self.cache = dict(islice(self.cache.items(), CACHE_WORDS // 2))
        new = list(words.difference(self.cache))
        for w, ids in zip(new, self.encode_words(new), strict=True):
            self.cache[w] = " ".join(map(str, ids)), self.decode(ids)
        return [w for w in new if len(w) > CACHE_CHARS]

    def decode(self, ids: list[int]) -> str:
        """Without a decoder in the tokenizer's file, its tokens joined by a space."""
        return " ".join([self.tokens[i] for i in ids])

    def pieces(self, text: str) -> list[str]:
        """Words of the normalised text; strings of special tokens stand for themselves."""
        if self.split_special and "<|" in text and len(parts := self.split_special.split(text)) > 1:
            return [w for k, part in enumerate(parts) for w in ([part] if k % 2 else words_of(part))]
        return words_of(text)

    def encode_texts(self, texts: list[str]) -> list[tuple[str, str]]:
        """For each text its ids and its decoded text, each joined by a space."""
        pieces = [self.pieces(t) for t in texts]
        long = self.learn(set().union(*pieces).difference(self.special))
        known = self.cache | {t: (str(i), t) for t, i in self.special.items()} if any("<|" in t for t in texts) else self.cache
        out = []
        for words in pieces:
            found = [known[w] for w in words]
            out.append((" ".join([x[0] for x in found]), " ".join([x[1] for x in found])))
        for w in long:
            del self.cache[w]
        return out


def newer(text: str) -> bool:
    """Whether a text holds code points that Python's Unicode tables don't assign; others may class and compose them otherwise."""
    return "Cn" in map(unicodedata.category, set(text))


def words_of(text: str) -> list[str]:
    if text.isascii():
        return _ASCII_WORDS.findall(text.lower())
    if newer(text):
        return [w for w, _ in _LIBRARY_WORDS.pre_tokenize_str(_LIBRARY_NORMAL.normalize_str(text))]
    # lower-casing here knows no final sigma
    return _WORDS.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())


def encoder(text: str) -> Bpe:
    """The worker's encoder for a tokenizer's JSON."""
    return kept(("bpe", hashlib.sha256(text.encode()).hexdigest()), lambda: Bpe(text))


SCHEMA = "doc_id long, n_tokens long, ids string, decoded string"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def tokenizer_json(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def encoded(documents: DataFrame, tokenizer: str, digests: bool = False) -> DataFrame:
    """For each row its ids and the text decoded from them, or digests of both. The tokenizer's JSON, of a few MB, is broadcast. A map without a shuffle."""
    sent = documents.sparkSession.sparkContext.broadcast(tokenizer)

    def start():
        bpe = encoder(sent.value)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()

        def work(batch):
            pairs = bpe.encode_texts([t or "" for t in batch.column(1).to_pylist()])
            n = [i.count(" ") + 1 if i else 0 for i, _ in pairs]
            rows = [(sha(i), sha(d)) for i, d in pairs] if digests else pairs
            return record_batch(DIGESTS if digests else SCHEMA, [batch.column(0), n, [r[0] for r in rows], [r[1] for r in rows]])

        return work

    return map_batches(documents.select(F.col("doc_id").cast("long"), "text"), start, DIGESTS if digests else SCHEMA, rows=256)


def with_tokens(documents: DataFrame, tokenizer: str) -> DataFrame:
    """The documents, with all columns, and n_tokens, token_ids and decoded_sha256 (prefixed by _ where the name is taken)."""
    sent = documents.sparkSession.sparkContext.broadcast(tokenizer)
    at, names = documents.columns.index("text"), list(documents.columns)
    for name in ("n_tokens", "token_ids", "decoded_sha256"):
        while name in names:
            name = "_" + name
        names.append(name)
    schema = T.StructType([*documents.schema.fields, *map(T.StructField, names[-3:], (T.LongType(), T.ArrayType(T.IntegerType()), T.StringType()))])

    def start():
        bpe = encoder(sent.value)

        def work(batch):
            pairs = bpe.encode_texts([t or "" for t in batch.column(at).to_pylist()])
            ids = [np.array(i.split(), np.int32) for i, _ in pairs]
            new = [pa.array([len(i) for i in ids], pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array([hashlib.sha256(d.encode()).hexdigest() for _, d in pairs])]
            return pa.RecordBatch.from_arrays([*batch.columns, *new], names=names)

        return work

    return map_batches(documents, start, schema, rows=256)


def op5_bpe_round_trip(spark, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"), tokenizer_json(), digests=True)
