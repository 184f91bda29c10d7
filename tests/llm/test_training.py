"""Mixing, fill-in-middle and ranked search against plain versions, and their edge cases."""

import collections
import hashlib
import math
import random
import re
import struct

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from maskframe.llm import infill, lexical, mixing
from maskframe.llm.common import Scratch

SCHEMA = "doc_id long, text string, source string, n long, key string, size long, range int, no string, block string"
LONG = "Von der einen Seite " * 3000


def docs(spark, rows):
    """(doc_id, text, source) with columns whose names also occur inside the operators."""
    return spark.createDataFrame([(d, t, s, 1, "k", 2, 3, "x", "y") for d, t, s in rows], SCHEMA)


EDGES = [(1, None, "a"), (2, "", "a"), (3, " \n\t", "b"), (4, LONG, "b"), (5, "same text here", "c"), (5, "same text here", "c"), (6, "same text here", None), (None, "no id", None), (7, "é漢字 😀 \x00", "~"), (8, "one", "z" * 300), (9, None, "only nulls")]


@pytest.fixture(scope="module")
def edges(spark):
    return docs(spark, EDGES)


@pytest.fixture(scope="module")
def nothing(spark):
    return docs(spark, [])


# mixing


def hashed(*values):
    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else struct.pack("<q", v) if v.bit_length() > 40 or isinstance(v, Long) else struct.pack("<i", v)
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed - (1 << 64) if seed >> 63 else seed


class Long(int):
    """Hashed as 64 bits."""


def swapped(x, n, *seed):
    for k in range(mixing.ROUNDS):
        mirror = (hashed(*seed, k) % n - x) % n
        if hashed(*seed, k, Long(max(x, mirror))) < 0:
            x = mirror
    return x


def plain_mix(rows):
    """The mix with lists of words: (doc_id, size, source_size, target, taken) and the words by (shard, place)."""
    size = lambda t: re.findall(mixing.WORD, t or "")
    names = sorted({s for _, _, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(len(size(t)) for _, t, x in rows if x == s) for s in names}
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(names)}
    target, free = {}, set(names)
    while True:  # as the contract tells it
        left = sum(total.values()) - sum(target.values())
        now = {s: weight[s] * left / sum(weight[x] for x in free) for s in free}
        if not (above := {s for s in free if now[s] > 3 * total[s]}):
            break
        target.update({s: 3 * total[s] for s in above})
        free -= above
        if not free:
            break
    target.update({s: now[s] for s in free})
    sequence = {s: [] for s in names}
    hash_of = lambda d, t: hashed(*([Long(d)] if d is not None else []), *([t] if t is not None else []))
    for k, (d, t, s) in sorted(enumerate(rows), key=lambda r: ((h := hash_of(*r[1][:2])) % mixing.RANGES, h)):
        sequence[s] += [(k, w) for w in size(t)]
    slots = []
    for no, s in enumerate(names):
        n, words = total[s], min(round(target[s]), 3 * total[s])
        whole = math.ceil(n / mixing.BLOCK)
        draw = 0
        while words > 0:
            part, place = divmod(draw, whole)
            block = swapped(place, n // mixing.BLOCK, Long(no), Long(part)) if place < n // mixing.BLOCK else place
            piece = sequence[s][block * mixing.BLOCK :][: min(mixing.BLOCK, words)]
            slots.append((s, piece))
            words, draw = words - len(piece), draw + 1
    taken = collections.Counter(k for _, piece in slots for k, _ in piece)
    places = [swapped(k, len(slots), "slots") for k in range(len(slots))]
    assert sorted(places) == list(range(len(slots)))
    out = [(d, len(size(t)), total[s], round(float(target[s]), 6), taken[k]) for k, (d, t, s) in enumerate(rows)]
    return out, sorted((p // mixing.SHARD, p % mixing.SHARD, str(s), [w for _, w in piece]) for p, (s, piece) in zip(places, slots, strict=True))


def rounded(rows):
    return sorted(((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in rows), key=str)


def made(n, seed=11):
    rng = random.Random(seed)
    pick = [("hot", 6), ("b", 3), ("tiny", 0.3), (None, 1), ("é", 1)]
    return [(k, " ".join(rng.choices(["a", "bb", "é", "漢字"], k=rng.choice([0, 3, 40, 200]))), rng.choices([s for s, _ in pick], [w for _, w in pick])[0]) for k in range(n)]


def test_mix_equals_the_plain_version(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 16)
    monkeypatch.setattr(mixing, "SHARD", 64)
    rows = made(120)
    want, slots = plain_mix(rows)
    table = docs(spark, rows).repartition(5)
    found = mixing.taken(table).collect()
    assert rounded(found) == sorted(want, key=str)
    assert rounded(mixing.taken(table.repartition(3)).collect()) == rounded(found)
    mix = mixing.mixed(table).collect()
    assert sorted((r.shard, r.place, str(r.source), r.words) for r in mix) == slots
    assert all(len(r.words) <= 16 for r in mix) and len({(r.shard, r.place) for r in mix}) == len(mix)


def test_mix_meets_targets_and_limits(spark):
    for rows in (made(400, 3), EDGES, [(k, "w " * 500, "abcde"[k % 5] if k < 20 else "a") for k in range(60)]):
        by = collections.defaultdict(lambda: [0, None])
        for r in mixing.taken(docs(spark, rows)).collect():
            assert 0 <= r.taken <= 3 * r["size"]
            got = by[r.source_size, r.target]
            got[0], got[1] = got[0] + r.taken, r.target
        twins = collections.Counter(round(t, 6) for _, t in by)
        assert all(abs(n - t) <= 1 for n, t in by.values() if twins[round(t, 6)] == 1) or len(by) < len({s for _, _, s in rows})


def test_mix_edges(spark, edges, nothing):
    want, _ = plain_mix(EDGES)
    found = rounded(mixing.taken(edges).collect())
    assert len(found) == len(EDGES) and mixing.taken(nothing).count() == 0 and mixing.mixed(nothing).count() == 0
    # copies of a row may have words taken from either
    assert [r[:4] for r in found] == [r[:4] for r in sorted(want, key=str)]
    assert rounded(mixing.taken(docs(spark, [(1, None, None), (2, "", "a")])).collect()) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_shards_are_mixed(spark, monkeypatch):
    """Counts of a shard spread as a multinomial draw's do."""
    monkeypatch.setattr(mixing, "SHARD", 256)
    sources, _ = mixing.laid_out(docs(spark, [(k, "w " * 3000, "abcdef"[k % 6]) for k in range(240)]), Scratch(spark))
    share = {r.no: r.slots for r in sources.collect()}
    all_slots = sum(share.values())
    counts = mixing.shard_counts(sources).collect()
    full = [r for r in counts if (r.shard + 1) * 256 <= all_slots]
    z = [(r.slots - 256 * share[r.no] / all_slots) / math.sqrt(256 * share[r.no] / all_slots * (1 - share[r.no] / all_slots)) for r in full]
    assert len(z) > 60 and abs(np.mean(z)) < 0.4 and 0.6 < np.std(z) < 1.4 and sum(r.slots for r in counts) == all_slots


def test_permutations_are_exact(spark):
    for n in (1, 2, 3, 100, 1001):
        got = [r[0] for r in spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit("s"))).collect()]
        assert sorted(got) == list(range(n)) and got == [swapped(x, n, "s") for x in range(n)]
    moves = np.array(got) - np.arange(1001)
    assert len(set(moves.tolist())) > 500


# fill in the middle


def plain_fill(d, t):
    t = t or ""
    h = hashlib.sha256(f"1:{'' if d is None else d}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(t)
    if not t or "<P>" in t or "<S>" in t or "<M>" in t or h3 % 100 >= 90:
        return n, "plain", None, None, t
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = t[:a], t[a:b], t[b:]
    return (n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else (n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def test_fill_in_middle(spark, edges, nothing):
    rng = random.Random(12)
    more = [(100 + k, "".join(rng.choices("ab<>PSM é漢😀\n\x00", k=rng.choice([0, 1, 2, 5, 30, 300]))), "s") for k in range(300)]
    table = docs(spark, [*EDGES, *more])
    rows = infill.filled_in(table).withColumn("back", infill.restored(F.col("form"), F.col("output"))).collect()
    for r, (d, t, _) in zip(rows, [*EDGES, *more], strict=True):
        assert (r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == (d, *plain_fill(d, t)) and r.back == (t or "")
    assert {r.form for r in rows} == {"plain", "psm", "spm"} and infill.filled_in(nothing).count() == 0


def test_units_of_any_pattern(spark):
    """Words as units: cuts lie at the ends of words, and what stands between goes with the next."""
    text = "  one two,three  four "
    unit = re.compile(r"\w+")
    for k in range(60):
        n, form, a, b = infill.cut(text, k, unit)
        h1, h2, *_ = infill.draws(k)
        at = [0, *(m.end() for m in unit.finditer(text))]
        assert n == 4 and (form == "plain" or (a, b) == tuple(sorted((at[h1 % 5], at[h2 % 5]))))
    assert infill.ends(iter(()), 0, 0) == (0, 0)


def test_the_matcher_holds_one_match():
    """The second pass goes no further than it must."""
    seen = []

    def lazily():
        for m in re.finditer(infill.UNIT, "x" * 1000):
            seen.append(m.end())
            yield m

    assert infill.ends(lazily(), 3, 7) == (3, 7) and seen == list(range(1, 8))


# ranked search


def plain_ranks(rows, items, k=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    terms = [(d, words(t)) for d, t in rows]
    n_docs, total = sum(bool(w) for _, w in terms), sum(len(w) for _, w in terms)
    df = collections.Counter(w for _, ws in terms for w in set(ws))
    out = []
    for item, text in items:
        wanted, scores = words(text), []
        for d, ws in terms:
            if ws:
                tf, m = collections.Counter(ws), 25 + 75 * len(ws) * n_docs // total
                s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * tf[w] // (1000 * tf[w] + 8 * m)) for w in wanted if tf[w])
                if s > 0:
                    scores.append((-s, d is None, d or 0))
        out += [(item, i + 1, None if none else d, -s) for i, (s, none, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def test_ranked_search(spark, edges, nothing, monkeypatch):
    monkeypatch.setattr(lexical, "FLUSH", 300)
    rng = random.Random(13)
    vocabulary = [f"w{k}" for k in range(40)] + ["É", "漢字", "THE", "a-b"]
    text = lambda: " ".join(rng.choices(vocabulary, [1 / (k + 1) for k in range(44)], k=rng.choice([0, 1, 5, 60])))
    rows = [*((d, t) for d, t, _ in EDGES), *((100 + k, text()) for k in range(200)), *((500, "w1 w2 w3") for _ in range(15)), *((600 + k, "w7 w8") for k in range(15))]
    items = [(1, text()), (2, "w1 w1 w9"), (2, "w1 w1 w9"), (None, "same TEXT É"), (4, None), (5, "..."), (6, "nowhere"), (7, "the w8 w7 w40")]
    table = docs(spark, [(d, t, "s") for d, t in rows])
    asked = spark.createDataFrame(items, "item_id long, text string")
    for size in (1 << 20, 8):
        found = lexical.ranked(table.repartition(6), asked, block_bytes=size).collect()
        assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in found), key=str) == plain_ranks(rows, items)
    assert lexical.ranked(nothing, asked).count() == 0 and lexical.ranked(table, asked.limit(0)).count() == 0 and lexical.ranked(edges, asked.filter("item_id = 4")).count() == 0


def test_radix_order():
    rng = np.random.default_rng(5)
    for keys in (np.empty(0, np.int64), rng.integers(0, 5, 1000), rng.integers(0, 1 << 50, 1000), np.array([3, 1 << 40, 3, 0])):
        assert (lexical.radix_order(keys) == np.argsort(keys, kind="stable")).all()


def test_new_queries_equal_their_sql(spark, data):
    import duckdb

    from maskframe.llm.queries import ORACLES, QUERIES

    duck = duckdb.connect()
    for t in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    for name in ("op12_fill_in_middle", "op13_ranked_search"):
        found, want = QUERIES[name](spark, data), duck.execute(ORACLES[name])
        columns = [d[0] for d in want.description]
        assert found.columns == columns and sorted(map(tuple, found.collect())) == sorted(want.fetchall())
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text", "source").collect()]
    assert rounded(QUERIES["op11_source_mix"](spark, data).collect()) == sorted(plain_mix(rows)[0], key=str)
