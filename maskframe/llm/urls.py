"""URL filters: rules by host and path, and for the rest gradient-boosted trees on lexical features.

The trees (logistic loss, depth DEPTH, splits at quantiles) are trained in numpy on distinct URLs that a rule labels, each
weighted by its rows; TRAIN_ROWS of them at most are used, the first in the order of their hashes, so neither copies nor
partitions choose them. Suffix statistics come from the same URLs: how often a host's last label is blocked, drawn towards the
mean, and how often it occurs; a URL that is trained on gets those of the other folds, so no label reaches its own features.
Each prediction reads lexical features of one URL only.

Edge cases: a null URL or one without `://` has an empty host and path and fits no rule; its features are those of the
string; if rules label no URL, or all alike, every other URL gets that verdict (allow, if none is labelled); repeated rows
repeat; URLs are read whole, however long; an empty table gives an empty result; only page_id and url are read, and other
columns may have any name.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, record_batch, table

# Fixed values: (verdict, host/path).
RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]
TRAIN_ROWS = 20_000
#: Parts of the labelled URLs whose suffix statistics come from the other parts.
FOLDS = 5
ROUNDS, DEPTH, RATE, BINS, LEAST_ROWS = 40, 3, 0.2, 32, 5
_UPPER = {c: c + 32 for c in range(65, 91)}
_HOST_END = re.compile("[/?#]")
_PATH_END = re.compile("[?#]")


def host_path(url: str | None) -> tuple[str, str]:
    if not url or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3 :]
    end = m.start() if (m := _HOST_END.search(rest)) else len(rest)
    path = rest[end:]
    return rest[:end].translate(_UPPER), path[: m.start()] if (m := _PATH_END.search(path)) else path


def rule_of(host: str, path: str, rules: list[tuple[str, str]] = RULES) -> tuple[str, str] | None:
    """The longest rule that fits the host or a domain above it and begins the path."""
    fit = []
    for verdict, rule in rules:
        of, slash, begin = rule.partition("/")
        if (host == of or host.endswith("." + of)) and path.startswith(slash + begin):
            fit.append((len(rule), rule, verdict))
    return max(fit)[1:] if fit else None


def features(url: str | None, suffixes: dict[str, tuple[float, float]], base: float) -> list[float]:
    url = url or ""
    host, path = host_path(url)
    n = len(url)
    digits = sum(c.isdigit() for c in url)
    entropy = -sum(k / n * math.log2(k / n) for k in Counter(url).values())
    query = url.partition("?")[2].partition("#")[0]
    rate, often = suffixes.get(host.rpartition(".")[2], (base, 0.0))
    return [n, len(host), len(path), path.count("/"), host.count("."), host.count("-"), digits / max(1, n), entropy, query.count("&") + bool(query), query.count("="), float("#" in url), float(url.startswith("https")), rate, often]


class Trees:
    """Boosted trees of one depth, as arrays: the feature and threshold of each inner node, the value of each leaf."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None):
        weight = np.ones(len(y)) if weight is None else weight
        mean = float((y * weight).sum() / weight.sum())
        self.base = math.log((mean + 1e-3) / (1 - mean + 1e-3))
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        edges = [np.unique(np.quantile(c, np.arange(1, BINS) / BINS)) for c in x.T]
        codes = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)], axis=1)
        score = np.full(len(y), self.base)
        for _ in range(ROUNDS):
            p = 1 / (1 + np.exp(-score))
            grad, hess, node = weight * (y - p), weight * p * (1 - p), np.zeros(len(y), np.int64)
            feature, cut = np.zeros(2**DEPTH - 1, np.int64), np.full(2**DEPTH - 1, np.inf)
            for level in range(DEPTH):
                for k in range(2**level):
                    at = np.flatnonzero(node == k)
                    if (best := self.split(codes[at], grad[at], hess[at])) is not None:
                        feature[2**level - 1 + k], cut[2**level - 1 + k] = best[0], edges[best[0]][best[1]]
                node = 2 * node + self.right(x, feature, cut, 2**level - 1 + node)
            g, h = (np.bincount(node, v, 2**DEPTH) for v in (grad, hess))
            leaf = RATE * g / (h + 1)
            self.trees.append((feature, cut, leaf))
            score += leaf[node]

    @staticmethod
    def right(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, node: np.ndarray) -> np.ndarray:
        return (x[np.arange(len(x)), feature[node]] > cut[node]).astype(np.int64)

    @staticmethod
    def split(codes: np.ndarray, grad: np.ndarray, hess: np.ndarray) -> tuple[int, int] | None:
        """The feature and edge of the largest gain; ties go to the first."""
        best, found = 1e-9, None
        for f in range(codes.shape[1]):
            g, h, n = (np.bincount(codes[:, f], v, BINS).cumsum() for v in (grad, hess, np.ones(len(grad))))
            gain = g**2 / (h + 1) + (g[-1] - g) ** 2 / (h[-1] - h + 1) - g[-1] ** 2 / (h[-1] + 1)
            gain[(n < LEAST_ROWS) | (n[-1] - n < LEAST_ROWS)] = 0
            if len(gain) and gain.max() > best:
                best, found = float(gain.max()), (f, int(gain.argmax()))
        return found

    def probability(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.base)
        for feature, cut, leaf in self.trees:
            node = np.zeros(len(x), np.int64)
            for level in range(DEPTH):
                node = 2 * node + self.right(x, feature, cut, 2**level - 1 + node)
            score += leaf[node]
        return 1 / (1 + np.exp(-score))


class Suffixes:
    """How often hosts with a last label are blocked, drawn towards the mean, and the logarithm of their number."""

    def __init__(self, rows: list[tuple[str, str, int]]):
        seen: dict[str, list[float]] = {}
        for url, verdict, n in rows:
            of = seen.setdefault(host_path(url)[0].rpartition(".")[2], [0.0, 0.0])
            of[0] += n * (verdict == "block")
            of[1] += n
        blocked, total = (sum(x[i] for x in seen.values()) for i in range(2))
        self.base = blocked / total if total else 0.0
        self.rates = {s: ((k + 10 * self.base) / (n + 10), math.log1p(n)) for s, (k, n) in seen.items()}


class Filter:
    """What is learned from labelled URLs (url, verdict, rows): suffix statistics and trees, or one verdict if all are alike."""

    def __init__(self, labelled: list[tuple[str, str, int]]):
        labelled = sorted(labelled)
        self.suffixes = Suffixes(labelled)
        self.base, self.trees = self.suffixes.base, None
        if 0 < self.base < 1:
            fold = [zlib.crc32(u.encode()) % FOLDS for u, _, _ in labelled]
            others = [Suffixes([r for r, g in zip(labelled, fold, strict=True) if g != f]) for f in range(FOLDS)]
            x = np.array([features(u, others[f].rates, others[f].base) for (u, _, _), f in zip(labelled, fold, strict=True)])
            self.trees = Trees(x, np.array([v == "block" for _, v, _ in labelled], float), np.array([n for _, _, n in labelled], float))

    def matrix(self, urls: list[str | None]) -> np.ndarray:
        return np.array([features(u, self.suffixes.rates, self.base) for u in urls]).reshape(len(urls), -1)

    def probability(self, urls: list[str | None]) -> np.ndarray:
        return self.trees.probability(self.matrix(urls)) if self.trees and urls else np.full(len(urls), self.base)


SCHEMA = "page_id long, host string, path string, rule string, verdict string, score double"


def training_urls(pages: DataFrame, rules: list[tuple[str, str]] = RULES, train_rows: int = TRAIN_ROWS) -> list[tuple[str, str, int]]:
    """(url, verdict, rows) of distinct labelled URLs, `train_rows` at most. Rows combine by URL before they are shuffled, and only
    those of about twice as many URLs as are wanted are."""

    def label(batch):
        rows = [(u, r[1]) for u in batch.column(0).to_pylist() if (r := rule_of(*host_path(u), rules))]
        return record_batch("url string, verdict string", [[u for u, _ in rows], [v for _, v in rows]])

    by_hash = F.pmod(F.xxhash64(F.col("url"), F.lit(17)), F.lit(1 << 30))
    labelled = lambda df: map_batches(df, lambda: label, "url string, verdict string", rows=4096)
    urls = pages.select(F.col("url").cast("string").alias("url")).filter("url is not null")
    n = labelled(urls).agg(F.approx_count_distinct("url")).first()[0]
    some = urls.filter(by_hash < F.lit(int((1 << 30) * min(1.0, 2 * train_rows / max(1, n)))))
    counted = labelled(some).groupBy("url", "verdict").agg(F.count("*").alias("n"))
    return [(r.url, r.verdict, r.n) for r in counted.orderBy(by_hash, "url").limit(train_rows).collect()]


def url_verdicts(pages: DataFrame, rules: list[tuple[str, str]] = RULES, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """For each row host, path, rule, verdict and the trees' probability of block. Maps only, and one small collect to train."""
    learned = Filter(training_urls(pages, rules, train_rows))

    def work(batch):
        urls = batch.column(1).to_pylist()
        score = learned.probability(urls).round(6).tolist()
        places = [host_path(u) for u in urls]
        fits = [rule_of(*p, rules) for p in places]
        verdicts = [r[1] if r else "block" if s >= 0.5 else "allow" for r, s in zip(fits, score, strict=True)]
        return record_batch(SCHEMA, [batch.column(0), [h for h, _ in places], [p for _, p in places], [r and r[0] for r in fits], verdicts, score])

    return map_batches(pages.select(F.col("page_id").cast("long"), F.col("url").cast("string")), lambda: work, SCHEMA, rows=4096)


def op7_url_filter(spark, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"))
