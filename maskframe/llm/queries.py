"""The queries of the text operators, by name, and the SQL of those that SQL can express; tests hold the others against
brute force, exact round trips or held-out rows."""

from __future__ import annotations

import importlib

from . import infill, lexical

_NAMES = {
    "media": "op1_media_columns",
    "licenses": "op2_license_scan",
    "neardup": "op3_near_duplicates",
    "decontam": "op4_benchmark_decontamination",
    "bpe": "op5_bpe_round_trip",
    "tokencount": "op6_token_counts",
    "urls": "op7_url_filter",
    "pii": "op8_pii",
    "substring": "op9_substring_dedup",
    "langid": "op10_language_id",
    "mixing": "op11_source_mix",
    "infill": "op12_fill_in_middle",
    "lexical": "op13_ranked_search",
}
QUERIES = {name: getattr(importlib.import_module(f"{__package__}.{module}"), name) for module, name in _NAMES.items()}

#: All pairs that share a shingle, and all that they reach.
NEAR_DUPLICATES = r"""WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY 1),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS node FROM words UNION SELECT r.doc_id, b FROM reach r JOIN ways ON a = r.node),
roots AS (SELECT doc_id, min(node) AS component_id FROM reach GROUP BY 1)
SELECT words.doc_id, coalesce(n, 0) AS n_shingles, component_id, words.doc_id = component_id AS kept FROM words JOIN roots USING (doc_id) LEFT JOIN sizes USING (doc_id)"""
ORACLES: dict[str, str] = {"op3_near_duplicates": NEAR_DUPLICATES, "op12_fill_in_middle": infill.ORACLE, "op13_ranked_search": lexical.ORACLE}
