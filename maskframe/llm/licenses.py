"""License scans: exact phrases by place, and known notices within an edit budget by seeds and bounded-error matching.

A notice of m characters with at most k edits is cut into k + 3 pieces; three of them stand unchanged in any match
(pigeonhole), so only places with three such pieces are handed to the regex library. Both work on the text with A-Z
lower-cased and its words joined by one space.
Edge cases: a null or empty text has no words, no labels and score 0; texts are searched whole; repeated rows repeat;
an empty table gives an empty result; only the id and text columns are read.
"""

from __future__ import annotations

from bisect import bisect
from collections import Counter
from functools import lru_cache

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, record_batch, table, texts_of

# Phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# Short notices, as their words, and their labels. Others can be given to license_scan.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "released under the mit license": "mit-notice",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit-grant",
    "licensed under the gnu general public license version 3": "gpl-3.0",
    "licensed under the gnu general public license version 2": "gpl-2.0",
    "licensed under the gnu lesser general public license": "lgpl",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "licensed under cc by 4 0": "cc-by-4.0",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "creative commons attribution 4 0 international": "cc-by-4.0",
    "subject to the terms of the mozilla public license": "mpl",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "this program is free software you can redistribute it": "gpl-header",
    "under the terms of the gnu affero general public license": "agpl",
    "permission to use copy modify and or distribute this software": "isc",
    "boost software license version 1 0": "bsl",
    "eclipse public license version 2 0": "epl",
    "unless required by applicable law or agreed to in writing": "apache-header",
    "neither the name of the copyright holder nor the names": "bsd-3",
    "has waived all copyright and related or neighboring rights": "cc0",
    "all rights reserved no part of this publication may be reproduced": "reserved",
}
#: Characters of a notice for each edit that a match may have.
CHARS_PER_EDIT = 12
#: Pieces of a notice that a match leaves unchanged, at least.
INTACT = 3

_WORD = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def normal_words(text: bytes) -> list[bytes]:
    """The words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of the UTF-8 text after A-Z are lower-cased."""
    return text.lower().translate(_WORD).split()


class Notice:
    """A notice of m characters with at most k edits, cut into k + INTACT pieces: edits reach k of them at most, so any match
    holds INTACT pieces unchanged, at shifts that differ by k at most. Only places with that many are matched with errors."""

    def __init__(self, words: str, label: str, chars_per_edit: int = CHARS_PER_EDIT):
        self.words, self.label = words.encode(), label
        m, self.edits = len(self.words), len(words) // chars_per_edit
        n = self.edits + min(INTACT, m - self.edits)
        cuts = [i * m // n for i in range(n + 1)]
        self.need = n - self.edits
        self.seeds = [(a, self.words[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
        self.pattern = regex.compile(b"(?b)(?:%s){e<=%d}" % (regex.escape(self.words), self.edits))
        self.verify = lru_cache(4096)(self._verify)

    def _verify(self, window: bytes) -> tuple[int, int, int] | None:
        m = self.pattern.search(window)
        return m and (m.start(), m.end(), sum(m.fuzzy_counts))

    def places(self, line: bytes) -> list[int]:
        """Where a match may begin, but for edits: the first shift of each group of enough different pieces."""
        hits = []
        for k, (offset, seed) in enumerate(self.seeds):
            at = line.find(seed)
            while at >= 0:
                hits.append((at - offset, k))
                at = line.find(seed, at + 1)
        if len(hits) < self.need:
            return []
        hits.sort()
        out, inside, last = [], Counter(), 0
        for place, k in hits:
            while last < len(hits) and hits[last][0] <= place + self.edits:
                inside[hits[last][1]] += 1
                last += 1
            if len(inside) >= self.need and (not out or out[-1] != place):
                out.append(place)
            inside[k] -= 1
            if not inside[k]:
                del inside[k]
        return out

    def find(self, line: bytes) -> list[tuple[int, int, int]]:
        """Matches (start, end, edits) in the joined words, one at most for each place."""
        found = set()
        for place in self.places(line):
            a = max(0, place - self.edits)
            if m := self.verify(line[a : max(0, place + len(self.words) + 2 * self.edits)]):
                found.add((a + m[0], a + m[1], m[2]))
        return sorted(found)


def best_apart(found: list[tuple[int, int, int, str, float]]) -> list[tuple[int, int, int, str, float]]:
    """Of the matches (start, end, edits, label, score) those that overlap none of a better score; ties go to the first."""
    kept: list[tuple[int, int, int, str, float]] = []
    for x in sorted(found, key=lambda x: (-x[4], x[0], x[3])):
        at = bisect(kept, x)  # those kept are apart, so only the neighbours can overlap
        if (not at or kept[at - 1][1] <= x[0]) and (at == len(kept) or x[1] <= kept[at][0]):
            kept.insert(at, x)
    return kept


def base_places(line: bytes, phrases: dict[str, str]) -> list[tuple[int, str]]:
    """(word index, label) of each place where a phrase's words stand consecutively; line is the words joined by a space."""
    line, found = b" %s " % line, []
    for phrase, label in phrases.items():
        key = b" %s " % phrase.encode()
        at, last, n = line.find(key), 0, -1
        while at >= 0:
            n, last = n + line.count(b" ", last, at + 1), at + 1
            found.append((n, label))
            at = line.find(key, at + 1)
    return found


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<string>"


def license_scan(documents: DataFrame, phrases: dict[str, str] | None = None, notices: dict[str, str] | None = None, chars_per_edit: int = CHARS_PER_EDIT) -> DataFrame:
    """For each row its base phrases, the labels of notices found, the best score (1 less edits by length) and the spans
    label:first word:end word:edits. A map without a shuffle."""
    phrases, notices = PHRASES if phrases is None else phrases, NOTICES if notices is None else notices

    def start():
        known = [Notice(*x, chars_per_edit) for x in notices.items()]

        def work(batch):
            out = [[] for _ in range(8)]
            for text in texts_of(batch.column(1)):
                words = normal_words(text)
                line = b" ".join(words)
                base = base_places(line, phrases)
                places, labels = [p for p, _ in base], {x for _, x in base}
                found = best_apart([(a, b, e, n.label, 1 - e / len(n.words)) for n in known for a, b, e in n.find(line)])
                spans = [f"{x[3]}:{line.count(b' ', 0, x[0])}:{line.count(b' ', 0, x[1]) + 1}:{x[2]}" for x in found]
                row = (len(words), len(base), min(places, default=None), max(places, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | {x[3] for x in found})), max([float(bool(base)), *(x[4] for x in found)]), spans)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            return record_batch(SCHEMA, [batch.column(0), *out])

        return work

    return map_batches(documents.select(F.col("doc_id").cast("long"), "text"), start, SCHEMA)


def op2_license_scan(spark, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents")).withColumn("spans", F.array_join("spans", ","))
