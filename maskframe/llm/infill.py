"""Fill-in-middle transformation by a two-pass streaming matcher.

The first pass over a text counts its units and keeps nothing else. Digests of the document's id then name two ranks, and the second
pass advances one lazy iterator of matches to the smaller and on to the larger; where those matches end, the text is cut. No list of
units exists, so a text takes the same memory beside itself whatever its length. A unit is any pattern's match; by default it is a
code point. What no match holds goes with the unit after it, or with the last piece.

Output: prefix, suffix and middle with a mark in front of each, in one of two orders; texts that hold a mark stay plain.

Edge cases: null and empty texts have no units, are plain and give an empty output; a null doc_id is hashed as an id of no digits;
repeated rows and rows of one doc_id are cut alike, as only the id and the text decide; there are no ties beyond equal ranks, which
leave the middle empty; long texts are cut whole; an empty table gives an empty result; only doc_id and text are read, and other
columns may have any name.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import islice

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, record_batch, table

PREFIX, SUFFIX, MIDDLE = MARKS = ("<P>", "<S>", "<M>")
#: A code point.
UNIT = r"(?s:.)"
#: Of a hundred texts so many are transformed, and so many of these with the suffix in front.
TRANSFORMED, SUFFIX_FIRST = 90, 20


def count(matches: Iterator) -> int:
    """The first pass."""
    return sum(1 for _ in matches)


def ends(matches: Iterator, low: int, high: int) -> tuple[int, int]:
    """The second pass: where the low-th and the high-th match end; 0 for the rank 0."""
    first = next(islice(matches, low - 1, None)).end() if low else 0
    return first, next(islice(matches, high - low - 1, None)).end() if high > low else first


def draws(doc_id: int | None) -> list[int]:
    name = "1:" if doc_id is None else f"1:{doc_id}"
    digest = hashlib.sha256(name.encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


def cut(text: str, doc_id: int | None, unit: re.Pattern) -> tuple[int, str, int, int]:
    """(units, form, where the middle begins, where it ends)."""
    n = count(unit.finditer(text))
    h1, h2, h3, h4 = draws(doc_id)
    if not text or h3 % 100 >= TRANSFORMED or any(m in text for m in MARKS):
        return n, "plain", 0, 0
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    return n, "spm" if h4 % 100 < SUFFIX_FIRST else "psm", *ends(unit.finditer(text), low, high)


SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def filled_in(documents: DataFrame, unit: str = UNIT) -> DataFrame:
    """For each row its units, its form, the lengths of prefix and middle (null if plain), and the output; one map, no shuffle."""

    def start():
        pattern = re.compile(unit)

        def work(batch):
            ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            rows = []
            for doc_id, text in zip(ids, texts, strict=True):
                n, form, a, b = cut(text, doc_id, pattern)
                if form == "plain":
                    rows.append((doc_id, n, form, None, None, text))
                    continue
                first = (SUFFIX, text[b:], PREFIX, text[:a]) if form == "spm" else (PREFIX, text[:a], SUFFIX, text[b:])
                rows.append((doc_id, n, form, a, b - a, "".join((*first, MIDDLE, text[a:b]))))
            return record_batch(SCHEMA, [list(c) for c in zip(*rows, strict=True)] if rows else [[]] * 6)

        return work

    return map_batches(documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), start, SCHEMA, rows=256)


def restored(form: Column, output: Column) -> Column:
    """The text from an output: marks stand in no text that is transformed, so they part the output into its pieces."""
    parts = F.split(output, "<[PSM]>", -1)
    at = lambda *order: F.concat(*(parts[k] for k in order))
    return F.when(form == "psm", at(1, 3, 2)).when(form == "spm", at(2, 3, 1)).otherwise(output)


def op12_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    rows = filled_in(table(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(restored(F.col("form"), F.col("output"))).alias("restored_sha256"))


#: Every column by the contract's own words; code points of a text are DuckDB's characters.
ORACLE = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || doc_id) AS h FROM documents),
u AS (SELECT *, length(text) AS n, ('0x' || h[1:8])::UBIGINT AS h1, ('0x' || h[9:16])::UBIGINT AS h2, ('0x' || h[17:24])::UBIGINT AS h3, ('0x' || h[25:32])::UBIGINT AS h4 FROM d),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1))::BIGINT AS a, greatest(h1 % (n + 1), h2 % (n + 1))::BIGINT AS b, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle, substr(text, b + 1) AS suffix FROM f)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256 FROM p"""
