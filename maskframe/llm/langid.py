"""Language identification by a bidirectional gated recurrent network over bytes, trained in numpy through time.

The network reads all bytes of a text (A-Z lower-cased) in both directions and gives every position a distribution over the
languages; a document gets the mean over its positions. A recurrence cannot be run for millions of steps at once, so a text is
read in stretches of STRETCH bytes, all of a batch side by side; each direction starts CONTEXT bytes before its stretch and
carries its state into it. The cut is the same at any length, and no byte is left out. Bytes beyond an end are OUTSIDE.

Training: TRAIN_ROWS distinct windows of WINDOW bytes at most, drawn by hash from all places of all texts with a language, but
for those with crc32(doc_id) mod 3 = 1, which are held out. One more label stands for what is in none of the languages; its
windows are drawn ones with their bytes shuffled or their letters swapped for others. A prediction names a language always;
the pipeline's stage rejects a document by the odds that it is in none: those of its positions' mean, which count once for
each EVIDENCE bytes as neighbours go together, against the odds of PRIOR for a language beforehand. That is one rule at any length.

Edge cases: a null text or one without a letter is `und` with score 0; so is any text if no row can be learned from; with a
single language that one is given. A null doc_id is neither held out nor learned from. Texts are read whole; repeated rows
repeat, and are learned from once; ties go to the first language by name; an empty table gives an empty result; only doc_id,
text and lang are read, and other columns may have any name.
"""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, record_batch, table

#: Bytes of a stretch, and those before it that each direction reads first.
STRETCH, CONTEXT = 256, 32
#: Stretches that run side by side: what a step works on stays in a core's cache.
SIDE_BY_SIDE = 1024
TRAIN_ROWS, WINDOW = 12_000, 64
#: Of how many windows one is corrupted too.
CORRUPT = 2
#: Bytes that are one piece of evidence, and the logarithm of the odds for a language before there is any.
EVIDENCE, PRIOR = 8, 5.0
UNITS, STEPS, BATCH, RATE = 16, 500, 128, 0.02
#: The symbol of places before and after a text.
OUTSIDE = 256

_LOWER = np.array([*range(65), *range(97, 123), *range(91, OUTSIDE + 1)], np.intp)
_LETTER = regex.compile(r"\p{L}")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Gru:
    """One direction: inputs are rows of a table, by byte. x: time by batch."""

    def __init__(self, units: int, rng: np.random.Generator):
        self.h = units
        self.p = {"table": rng.normal(0, 0.3, (OUTSIDE + 1, 3 * units)), "u": rng.normal(0, units**-0.5, (units, 3 * units)), "b": np.zeros(units)}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def forward(self, x: np.ndarray, keep: bool = False) -> np.ndarray:
        h, p = self.h, self.p
        state = np.zeros((x.shape[1], h), np.float32)
        out = np.empty((*x.shape, h), np.float32)
        self.steps = []
        for t in range(len(x)):
            a, g = p["table"][x[t]], state @ p["u"]
            zr = _sigmoid(a[:, : 2 * h] + g[:, : 2 * h])
            z, r, c = zr[:, :h], zr[:, h:], g[:, 2 * h :] + p["b"]
            n = np.tanh(a[:, 2 * h :] + r * c)
            if keep:
                self.steps.append((state, z, r, c, n))
            state = out[t] = n + z * (state - n)
        return out

    def backward(self, x: np.ndarray, grad: np.ndarray) -> dict[str, np.ndarray]:
        """Through time: the gradients of the parameters, from those of the outputs."""
        h, p = self.h, self.p
        table, u, b = np.zeros_like(p["table"]), np.zeros_like(p["u"]), np.zeros_like(p["b"])
        flow = np.zeros_like(grad[0])
        for t in range(len(x) - 1, -1, -1):
            state, z, r, c, n = self.steps[t]
            d = grad[t] + flow
            dn = d * (1 - z) * (1 - n * n)
            dz, dr, dc = d * (state - n) * z * (1 - z), dn * c * r * (1 - r), dn * r
            dg = np.concatenate([dz, dr, dc], axis=1)
            u += state.T @ dg
            b += dc.sum(axis=0)
            np.add.at(table, x[t], np.concatenate([dz, dr, dn], axis=1))
            flow = d * z + dg @ p["u"].T
        return {"table": table, "u": u, "b": b}


def corrupted(windows: list[bytes], seed: int = 5) -> list[bytes]:
    """One of CORRUPT windows, its bytes shuffled or its letters A-Z (lower-cased) swapped at random, for letters or other bytes."""
    rng, out, letters = random.Random(seed), [], range(97, 123)
    for k, w in enumerate(windows[::CORRUPT]):
        data = bytearray(w)
        if k % 3 == 0:
            rng.shuffle(data)
        else:
            others = letters if k % 3 == 1 else range(128, 256)
            data = data.lower().translate(bytes.maketrans(bytes(letters), bytes(rng.sample(others, 26))))
        out.append(bytes(data))
    return out


class Network:
    """Outputs: the languages in order of their names, then what is in none of them."""

    def __init__(self, langs: list[str], units: int = UNITS, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.langs, self.ahead, self.back = langs, Gru(units, rng), Gru(units, rng)
        self.w, self.b = rng.normal(0, 0.1, (2 * units, len(langs) + 1)).astype(np.float32), np.zeros(len(langs) + 1, np.float32)

    def positions(self, x: np.ndarray, keep: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The distribution at each position of byte strings of one length (time by batch), and the states."""
        states = np.concatenate([self.ahead.forward(x, keep), self.back.forward(x[::-1], keep)[::-1]], axis=2)
        scores = states @ self.w + self.b
        odds = np.exp(scores - scores.max(axis=2, keepdims=True))
        return odds / odds.sum(axis=2, keepdims=True), states

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy over all positions that lie in a text."""
        p, states = self.positions(x, keep=True)
        p[:, np.arange(len(y)), y] -= 1
        inside = x != OUTSIDE
        p *= (inside / max(1, inside.sum()))[:, :, None]
        h, d = self.ahead.h, p @ self.w.T
        out = {"w": np.einsum("tbi,tbj->ij", states, p), "bias": p.sum(axis=(0, 1))}
        out |= {f"ahead.{k}": v for k, v in self.ahead.backward(x, d[:, :, :h]).items()}
        return out | {f"back.{k}": v for k, v in self.back.backward(x[::-1], d[::-1, :, h:]).items()}

    def parameters(self) -> dict[str, np.ndarray]:
        return {"w": self.w, "bias": self.b} | {f"ahead.{k}": v for k, v in self.ahead.p.items()} | {f"back.{k}": v for k, v in self.back.p.items()}

    def train(self, rows: list[tuple[bytes, int]], steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = 5) -> None:
        """Adam over batches of windows; shorter ones are followed by OUTSIDE."""
        rows = sorted(rows)
        x = np.full((max(len(r) for r, _ in rows), len(rows)), OUTSIDE, np.intp)
        for k, (r, _) in enumerate(rows):
            x[: len(r), k] = _LOWER[np.frombuffer(r, np.uint8)]
        y, rng, params = np.array([k for _, k in rows]), np.random.default_rng(seed), self.parameters()
        first, second = ({k: np.zeros_like(v) for k, v in params.items()} for _ in range(2))
        for step in range(1, steps + 1):
            some = rng.integers(0, len(y), batch)
            pace = rate * min(1, 2 * (1 - step / (steps + 1)))
            for k, g in self.gradients(x[:, some], y[some]).items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                params[k] -= pace * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)


class Reader:
    """A network laid out for reading: both directions side by side, features by rows. As exp() costs half of what tanh() does, all three
    gates are logistic: with states s = (h + 1) / 2 a step is the same mean of s and the new one, so twos and ones go into the weights."""

    def __init__(self, network: Network):
        h, sides = network.ahead.h, (network.ahead, network.back)
        # what exp() gets is the negative of a gate's input, and twice that for the new state
        turn, own = np.repeat(np.array([-1.0, -1.0, -2.0], np.float32), h), np.repeat(np.array([1.0, 1.0, 0.0], np.float32), h)
        sums = [g.p["u"].sum(axis=0) for g in sides]
        self.langs, self.h = network.langs, h
        self.table = [np.ascontiguousarray(((g.p["table"] - k * own) * turn).T) for g, k in zip(sides, sums, strict=True)]
        self.u = np.ascontiguousarray(np.stack([(2 * g.p["u"] * turn).T for g in sides]))
        self.b = np.stack([-2 * (g.p["b"] - k[2 * h :]) for g, k in zip(sides, sums, strict=True)])[:, :, None]
        self.w, self.bias = [np.ascontiguousarray(2 * w.T) for w in (network.w[:h], network.w[h:])], (network.b - network.w.sum(axis=0))[:, None]

    def distributions(self, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Position by language by stretch, for stretches of the symbols `flat` that begin at `starts`."""
        h, n = self.h, len(starts)
        state, a, g = np.full((2, h, n), 0.5, np.float32), np.empty((2, 3 * h, n), np.float32), np.empty((2, 3 * h, n), np.float32)
        out = np.broadcast_to(self.bias, (STRETCH, len(self.bias), n)).copy()
        gates, r, fresh = a[:, : 2 * h], a[:, h : 2 * h], g[:, 2 * h :]

        def logistic(x: np.ndarray) -> None:
            np.exp(x, out=x)
            x += 1
            np.divide(1, x, out=x)

        with np.errstate(over="ignore"):  # 1 / inf is the gate's 0
            for t in range(CONTEXT + STRETCH):
                at = t - CONTEXT
                np.take(self.table[0], flat[starts + at], axis=1, out=a[0], mode="clip")
                np.take(self.table[1], flat[starts + (STRETCH - 1 - at)], axis=1, out=a[1], mode="clip")
                np.matmul(self.u, state, out=g)
                gates += g[:, : 2 * h]
                logistic(gates)
                fresh += self.b
                fresh *= r
                fresh += a[:, 2 * h :]
                logistic(fresh)
                state -= fresh
                state *= a[:, :h]
                state += fresh
                if at >= 0:
                    out[at] += self.w[0] @ state[0]
                    out[STRETCH - 1 - at] += self.w[1] @ state[1]
        out -= out.max(axis=1, keepdims=True)
        np.exp(out, out=out)
        out /= out.sum(axis=1, keepdims=True)
        return out

    def read(self, texts: list[bytes], each=None) -> np.ndarray:
        """For each text the sum of its positions' distributions. each(text's number, first position, array of position by
        language) is called for every stretch, in order within a text."""
        sizes = np.array([len(t) for t in texts], np.int64)
        gap = CONTEXT + STRETCH
        begins = np.concatenate([[0], (sizes + gap).cumsum()])[:-1] + gap
        flat = np.full(int(sizes.sum()) + gap * (len(texts) + 1), OUTSIDE, np.uint16)
        for t, b in zip(texts, begins.tolist(), strict=True):
            flat[b : b + len(t)] = _LOWER[np.frombuffer(t, np.uint8)]
        many = -(-sizes // STRETCH)
        owner = np.repeat(np.arange(len(texts)), many)
        place = (np.arange(len(owner)) - np.repeat(many.cumsum() - many, many)) * STRETCH
        sums = np.zeros((len(texts), len(self.bias)))
        for i in range(0, len(owner), SIDE_BY_SIDE):
            who, first = owner[i : i + SIDE_BY_SIDE], place[i : i + SIDE_BY_SIDE]
            p = self.distributions(flat, begins[who] + first)
            left = sizes[who] - first
            if each:
                for k in range(len(who)):
                    each(int(who[k]), int(first[k]), p[: left[k], :, k])
            p *= (np.arange(STRETCH)[:, None] < left)[:, None, :]
            np.add.at(sums, who, p.sum(axis=0, dtype=np.float64).T)
        return sums

    def predict(self, texts: list[str | None], spans: list | None = None) -> list[tuple[str, float, float]]:
        """(language, score, share in no language) of each text. `spans`, if given, gets a list start:stop:language (bytes; `und`
        for no language) for each."""
        data = [t.encode() if t and self.langs and _LETTER.search(t) else b"" for t in texts]
        runs: list[list[list]] = [[] for _ in texts]

        def each(k, first, p):
            best = p.argmax(axis=1)
            turns = [0, *(np.flatnonzero(best[1:] != best[:-1]) + 1).tolist(), len(best)]
            for a, b in zip(turns, turns[1:], strict=False):
                if runs[k] and runs[k][-1][2] == best[a]:
                    runs[k][-1][1] = first + b
                else:
                    runs[k].append([first + a, first + b, best[a]])

        out = []
        for d, total in zip(data, self.read(data, each if spans is not None else None), strict=True):
            if not d:
                out.append(("und", 0.0, 1.0))
                continue
            best = int(total[:-1].argmax())
            out.append((self.langs[best], round(min(1.0, float(total[best] / len(d))), 5), float(total[-1] / len(d))))
        if spans is not None:
            names = [*self.langs, "und"]
            spans += [[f"{a}:{b}:{names[k]}" for a, b, k in r] for r in runs]
        return out


def held_out(col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(col).cast("string")) % 3 == 1, F.lit(False))


def labelled(documents: DataFrame) -> DataFrame:
    known = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    return known.filter("doc_id is not null and text is not null and lang is not null and octet_length(text) > 0")


def drawn_windows(documents: DataFrame, train_rows: int) -> DataFrame:
    """(lang, part): distinct windows of the texts that may be learned from, the first `train_rows` in the order of their draws.
    Every window of every text is as likely to be drawn, and copies of one count once; no order of rows or partitions matters."""
    known = labelled(documents).filter(~held_out()).select("text", "lang", F.expr(f"ceil(octet_length(text) / {WINDOW})").alias("n"))
    total = known.agg(F.sum("n")).first()[0] or 0
    share = int((1 << 62) * min(1.0, 1.5 * train_rows / max(1, total)))
    # a text is hashed once; its windows' draws are hashes of that and their numbers
    seeded = known.select("lang", F.encode("text", "utf-8").alias("data"), F.xxhash64("text", "lang").alias("seed"), "n")
    drawn = F.expr(f"filter(sequence(0L, n - 1), k -> (xxhash64(seed, k) & {(1 << 62) - 1}L) < {share}L)")
    parts = seeded.select("lang", "data", "seed", F.explode(drawn).alias("k")).select("lang", F.expr(f"substring(data, cast(k * {WINDOW} + 1 as int), {WINDOW})").alias("part"), F.expr("xxhash64(seed, k)").alias("draw"))
    return parts.groupBy("part", "lang").agg(F.min("draw").alias("draw")).orderBy("draw", "part", "lang").limit(train_rows).select("lang", "part")


def fitted(documents: DataFrame, train_rows: int = TRAIN_ROWS) -> Network:
    """A network trained on windows of the texts that may be learned from."""
    rows = drawn_windows(documents, train_rows).collect()
    langs = sorted({r.lang for r in rows})
    network = Network(langs)
    if rows:
        drawn = [(bytes(r.part), langs.index(r.lang)) for r in rows]
        network.train(drawn + [(w, len(langs)) for w in corrupted([w for w, _ in drawn])])
    return network


SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"
SPANS = "doc_id long, spans array<string>"


def _ids(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out().alias("held"))


def languages(documents: DataFrame, network: Network | None = None) -> DataFrame:
    """For each row its language and the mean probability of that. A map without a shuffle once the network is trained."""
    network = network or fitted(documents)

    def start():
        reader = Reader(network)

        def work(batch):
            found = reader.predict(batch.column(1).to_pylist())
            return record_batch(SCHEMA, [batch.column(0), batch.column(2), [x[0] for x in found], [x[1] for x in found]])

        return work

    return map_batches(_ids(documents), start, SCHEMA, rows=256)


def language_spans(documents: DataFrame, network: Network | None = None) -> DataFrame:
    """For each row the stretches start:stop:language (bytes) of positions that bear one label; they cover the whole text. Null
    texts, and texts without a letter, have none."""
    network = network or fitted(documents)

    def start():
        reader = Reader(network)

        def work(batch):
            spans: list[list[str]] = []
            reader.predict(batch.column(1).to_pylist(), spans)
            return record_batch(SPANS, [batch.column(0), spans])

        return work

    return map_batches(_ids(documents), start, SPANS, rows=256)


def in_none(size: int, other: float, prior: float = PRIOR) -> bool:
    """Whether a text of so many bytes, of whose positions' mean `other` is in no language, is more likely in none than in one."""
    other = min(max(other, 1e-9), 1 - 1e-9)
    return size / EVIDENCE * math.log(other / (1 - other)) > prior


def in_a_language(documents: DataFrame, prior: float = PRIOR, network: Network | None = None) -> DataFrame:
    """The documents, with all columns, that have letters and are likely in one of the languages; those without a lang get theirs."""
    network = network or fitted(documents)
    at, lang = documents.columns.index("text"), documents.columns.index("lang") if "lang" in documents.columns else None

    def start():
        reader = Reader(network)

        def clear(text: str, lang: str, other: float) -> bool:
            return lang != "und" and not in_none(len(text.encode()), other, prior)

        def work(batch):
            texts = batch.column(at).to_pylist()
            found = reader.predict(texts)
            columns = list(batch.columns)
            if lang is not None:
                old = columns[lang].to_pylist()
                columns[lang] = pa.array([x[0] if y is None else y for x, y in zip(found, old, strict=True)], columns[lang].type)
            rows = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
            return rows.filter(pa.array([clear(t or " ", x, other) for t, (x, _, other) in zip(texts, found, strict=True)], pa.bool_()))

        return work

    return map_batches(documents, start, documents.schema, rows=256)


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"))
