"""URL filters: rules by host and path, and gradient-boosted trees on lexical features for the URLs that no rule fits.

The trees learn from the URLs that a rule labels. Features are lexical: lengths, depth, digit ratio, entropy, parameter
counts, and how often URLs of a suffix (last host label, file suffix) are blocked. Suffix statistics cover all labelled
URLs in SUFFIXES hashed classes, so they stay that small; the trees are fitted here in numpy on a bounded sample of
labelled URLs, those with the smallest hashes. Rules are DataFrame expressions; prediction is one map over Arrow batches.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from urllib.parse import unquote_to_bytes

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm import textkernel

#: The rules of the production query, verdict and host/path.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: The bound of the training sample, and the classes of suffix statistics.
SAMPLE, SUFFIXES = 20_000, 512
TREES, DEPTH, RATE, BINS, LEAST = 40, 3, 0.2, 32, 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z in lower case, and path; both empty for null and without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda k: F.coalesce(F.regexp_extract(url, pattern, k), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (null if none does) and its verdict; of equally long ones the first."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(reversed(rules), key=lambda r: len(r[1])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def suffix_classes(host: Column, path: Column) -> tuple[Column, Column]:
    """Classes of the last host label and of the file suffix (that of no suffix included)."""
    name = F.substring_index(path, "/", -1)
    suffix = F.when(F.contains(name, F.lit(".")), F.substring_index(name, ".", -1)).otherwise("")
    number = lambda kind, x: (F.crc32(F.concat(F.lit(kind), F.lower(x))) % SUFFIXES).cast("int")
    return number("h", F.substring_index(host, ".", -1)), number("f", suffix)


def _entropy(x: bytes) -> float:
    if not x:
        return 0.0
    n = np.bincount(np.frombuffer(x, np.uint8))
    p = n[n > 0] / len(x)
    return float(-(p * np.log2(p)).sum())


def features(url: str, h: int, f: int, blocked: np.ndarray) -> list[float]:
    """The lexical features of a URL with suffix classes h and f; ``blocked``: the share of blocked URLs of each class."""
    rest = url.partition("://")[2]
    raw = rest.encode("utf-8", "replace")
    query = rest.partition("#")[0].partition("?")[2]
    path = rest.partition("#")[0].partition("?")[0].partition("/")[2]
    host = rest.partition("/")[0]
    digits = sum(c.isdigit() for c in rest)
    first = path.partition("/")[0]
    return [
        len(url), len(host), len(path), len(query), host.count("."), host.count("-"), path.count("/"), query.count("&") + bool(query), "#" in url,
        digits / max(len(rest), 1), sum(c.isdigit() for c in host) / max(len(host), 1), _entropy(raw), _entropy(host.encode("utf-8", "replace")), len(unquote_to_bytes(raw)) / max(len(raw), 1),
        url.startswith("https"), len(first), zlib.crc32(first.lower().encode("utf-8", "replace")) % 97, blocked[h], blocked[f],
    ]


class Trees:
    """Boosted regression trees on binned features, logistic loss."""

    def __init__(self) -> None:
        self.edges: list[np.ndarray] = []
        self.trees: list[list] = []
        self.start = 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], "right") for k, e in enumerate(self.edges)], 1).astype(np.int64) if len(self.edges) else np.zeros((len(x), 0), np.int64)

    def _grow(self, x: np.ndarray, g: np.ndarray, h: np.ndarray, n: np.ndarray, rows: np.ndarray, depth: int):
        leaf = float(-g[rows].sum() / (h[rows].sum() + 1.0))
        if not depth or n[rows].sum() < 2 * LEAST:
            return leaf
        best = (1e-6, None, None)
        whole = g[rows].sum() ** 2 / (h[rows].sum() + 1.0)
        for k in range(x.shape[1]):
            gs, hs, ns = (np.bincount(x[rows, k], w, BINS + 1).cumsum()[:-1] for w in (g[rows], h[rows], n[rows]))
            gr, hr = g[rows].sum() - gs, h[rows].sum() - hs
            gain = np.where((ns >= LEAST) & (n[rows].sum() - ns >= LEAST), gs**2 / (hs + 1.0) + gr**2 / (hr + 1.0) - whole, -1)
            if gain.max() > best[0]:
                best = (float(gain.max()), k, int(gain.argmax()))
        if best[1] is None:
            return leaf
        left = x[rows, best[1]] <= best[2]
        return [best[1], best[2], self._grow(x, g, h, n, rows[left], depth - 1), self._grow(x, g, h, n, rows[~left], depth - 1)]

    def _leaves(self, node, x: np.ndarray) -> np.ndarray:
        if not isinstance(node, list):
            return np.full(len(x), node)
        left = x[:, node[0]] <= node[1]
        out = np.empty(len(x))
        out[left], out[~left] = self._leaves(node[2], x[left]), self._leaves(node[3], x[~left])
        return out

    def fit(self, x: np.ndarray, y: np.ndarray, n: np.ndarray | None = None) -> Trees:
        """``n``: the rows that each one stands for, 1 if not given."""
        n = np.ones(len(y)) if n is None else n
        share = min(max(np.average(y, weights=n), 1e-3), 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        binned, score = self._binned(x), np.full(len(y), self.start)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            tree = self._grow(binned, n * (p - y), n * p * (1 - p), n, np.arange(len(y)), DEPTH)
            self.trees.append(tree)
            score += RATE * self._leaves(tree, binned)
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        """The chance of being blocked."""
        binned = self._binned(x)
        return 1 / (1 + np.exp(-(self.start + RATE * sum(self._leaves(t, binned) for t in self.trees))))


def train(labelled: DataFrame, url: str = "url", label: str = "verdict", sample: int = SAMPLE) -> tuple[Trees, np.ndarray] | None:
    """Trees and suffix statistics from URLs labelled ``allow`` or ``block``; None without any. Null labels and URLs don't count; a URL
    weighs as much as it has rows."""
    rows = labelled.filter(F.col(label).isNotNull() & F.col(url).isNotNull()).select(F.col(url).alias("url"), (F.col(label) == "block").cast("long").alias("blocked"))
    rows = rows.select("*", *[c.alias(k) for k, c in zip("hf", suffix_classes(*host_and_path(F.col("url"))), strict=True)])
    counts = rows.select(F.explode(F.array("h", "f")).alias("class"), "blocked").groupBy("class").agg(F.sum("blocked").alias("blocked"), F.count(F.lit(1)).alias("n")).collect()
    if not counts:
        return None
    mean = sum(r["blocked"] for r in counts) / sum(r["n"] for r in counts)
    blocked = np.full(SUFFIXES, mean)
    for r in counts:
        blocked[r["class"]] = (r["blocked"] + 5 * mean) / (r["n"] + 5)
    # A share of the hashes holds about twice the sample of distinct URLs, so tasks send few each; the count is within some
    # per cent. A URL weighs as much as it has rows.
    hashed = F.pmod(F.xxhash64("url"), F.lit(1 << 40))
    distinct = max(rows.agg(F.approx_count_distinct(hashed)).first()[0], 1)

    def smallest(below: int) -> list:
        some = rows.filter(hashed < below).groupBy("url", "blocked", "h", "f").agg(F.count(F.lit(1)).alias("n"))
        return some.orderBy(hashed, "url", "blocked").limit(sample).collect()

    share = min(1 << 40, (sample * 2 << 40) // distinct)
    picked = smallest(share)
    if len(picked) < sample and share < 1 << 40:
        picked = smallest(1 << 40)
    x = np.array([features(r["url"], r["h"], r["f"], blocked) for r in picked], float)
    y, n = (np.array([r[c] for r in picked], float) for c in ("blocked", "n"))
    return Trees().fit(x, y, n), blocked


def _verdicts(model: tuple[Trees, np.ndarray] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls = batch.column(0).to_pylist()
            score = np.zeros(len(urls))
            if model and urls:
                h, f = batch.column(1).to_pylist(), batch.column(2).to_pylist()
                score = model[0].score(np.array([features(u or "", *c, model[1]) for u, *c in zip(urls, h, f, strict=True)], float))
            said = pa.array(np.where(score >= 0.5, "block", "allow"), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[3:-1], pa.compute.coalesce(batch.columns[-1], said), pa.array(score)], names=[*batch.schema.names[3:-1], "verdict", "score"])

    return run


def filter_urls(pages: DataFrame, url: str = "url", keep: tuple[str, ...] = ("page_id",), rules=RULES) -> DataFrame:
    """The columns ``keep`` with ``host``, ``path``, ``rule``, ``verdict`` and ``score`` (the trees' chance of a block).

    A null URL, or one without ``://``, has an empty host and path and no rule; the trees judge it as an empty URL. Without
    a single labelled URL the score is 0 and the verdict ``allow``; at a score of exactly 0.5 it is ``block``. Rows are judged
    each by itself, so repeated rows get equal results; URLs of any length are read whole; an empty table gives none. Columns of
    ``keep`` that are called like the results are replaced; others don't matter.
    """
    keep = tuple(k for k in keep if k not in ("host", "path", "rule", "verdict", "score"))
    host, path = host_and_path(F.col(url))
    parts = pages.select(F.col(url).alias("_url"), *[c.alias(k) for k, c in zip(("_h", "_f"), suffix_classes(host, path), strict=True)], *[F.col(k) for k in keep], host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = parts.withColumns({"rule": rule, "verdict": verdict})
    model = train(ruled, "_url", "verdict")
    kinds = dict(pages.dtypes)
    return textkernel.mapped(ruled, _verdicts(model), ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), "host string, path string, rule string, verdict string, score double"]))
