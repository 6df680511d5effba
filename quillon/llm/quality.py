"""Quality rules as a short-circuit cascade.

The counts of the base rules are computed for every text with numpy over whole batches. Further rules are judged one after
another, each only for texts that all earlier ones let pass. Their order comes from a sample: a rule's cost is its time for
a text, its selectivity the share that it rejects, and rules go by rejections per second. The order changes the cost and
never the verdict. The sample is measured where its texts lie, so that the driver sees sums alone; then one scan and one map
judge all texts: nothing else is shuffled.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm import textkernel

#: Texts on which costs and selectivities are estimated, about: a share of the hashes.
SAMPLE = 500
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LETTERS = re.compile(r"[^\W\d_]")
_ODD_LINES = re.compile(r"(?m)^[ \t]*[-*•]")
_DOTS = re.compile(r"(?m)(?:…|\.\.\.)[ \t]*$")


def _words_long(text: str, c: dict) -> bool:
    return not 2 <= c["word_chars"] / max(c["n_words"], 1) <= 15


def _symbols(text: str, c: dict) -> bool:
    return c["n_symbols"] > 0.3 * c["n_words"]


def _repeated_lines(text: str, c: dict) -> bool:
    return c["n_dup_lines"] > 0.3 * (text.count("\n") + 1)


def _few_letters(text: str, c: dict) -> bool:
    return sum(1 for w in _WORD.findall(text) if _LETTERS.search(w)) < 0.6 * c["n_words"]


def _bullets(text: str, c: dict) -> bool:
    return len(_ODD_LINES.findall(text)) > 0.9 * (text.count("\n") + 1)


def _ellipses(text: str, c: dict) -> bool:
    return len(_DOTS.findall(text)) > 0.3 * (text.count("\n") + 1)


#: A rule says whether it rejects a text, given its counts.
RULES: dict[str, Callable[[str, dict], bool]] = {"word_length": _words_long, "symbols": _symbols, "repeated_lines": _repeated_lines, "letters": _few_letters, "bullets": _bullets, "ellipses": _ellipses}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _sum_between(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[ends] - sums[starts]


def counted(column: pa.Array) -> np.ndarray:
    """COUNTS of each text, a row each."""
    out = np.zeros((len(column), len(COUNTS)), np.int64)
    for w in textkernel.words(column):
        docs = len(w.bounds) - 1
        own = out[w.first : w.first + docs]
        chars = (w.data & 0xC0) != 0x80
        inside = ~textkernel._SPACE[w.data]
        own[:, 0] = w.counts
        own[:, 1] = _sum_between(chars & inside, w.offsets[:-1], w.offsets[1:])
        own[:, 2] = _sum_between(_SYMBOL[w.data], w.offsets[:-1], w.offsets[1:])
        # Three-word windows that a text has twice: equal neighbours after sorting by (text, window).
        if len(w.hashes) > 2:
            owner = np.repeat(np.arange(docs), w.counts)
            grams = w.hashes[:-2] * np.uint64(0x9E3779B97F4A7C15) + w.hashes[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + w.hashes[2:] * np.uint64(0x165667B19E3779F9)
            whole = owner[:-2] == owner[2:]
            grams = textkernel.mix(grams[whole]) ^ textkernel.mix(owner[:-2][whole].astype(np.uint64) + np.uint64(1))
            order = np.argsort(grams)
            same = grams[order][1:] == grams[order][:-1]
            twice = np.zeros(len(grams), bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            first = np.flatnonzero(whole)[twice]
            covered = np.zeros(len(w.hashes), bool)
            for k in range(3):
                covered[first + k] = True
            own[:, 4] = _sum_between(covered, w.bounds[:-1], w.bounds[1:])
        breaks = _sum_between(w.data == 10, w.offsets[:-1], w.offsets[1:])
        raw = w.data.tobytes()
        for k in np.flatnonzero(breaks):
            lines = [x for x in raw[w.offsets[k] : w.offsets[k + 1]].split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
            own[k, 3] = len(lines) - len(set(lines))
    return out


def base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < 50) | (100 * counts[:, 4] > 50 * counts[:, 0])


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task's sample: rows (rule, texts, seconds, rejected), of the texts that the cascade would see."""
    told = {name: [0, 0.0, 0] for name in RULES}
    for batch in batches:
        column = batch.column(0)
        counts = counted(column)
        for k in np.flatnonzero(~base_failed(counts)):
            text, own = column[int(k)].as_py(), dict(zip(COUNTS, map(int, counts[k]), strict=True))
            for name, rule in RULES.items():
                began = time.perf_counter()
                rejected = rule(text, own)
                told[name] = [told[name][0] + 1, told[name][1] + time.perf_counter() - began, told[name][2] + bool(rejected)]
    yield pa.RecordBatch.from_pydict({"rule": list(told), **{c: [v[k] for v in told.values()] for k, c in enumerate(("texts", "seconds", "rejected"))}})


def ordered_rules(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> list[tuple[str, float, float]]:
    """(rule, seconds a text, share rejected) on about ``sample`` texts of any length, in order of rejections per second; ties by
    name. The texts are those of a share of the hashes."""
    hashed = F.pmod(F.xxhash64(text), F.lit(1 << 40))
    near = docs.select(text).filter(F.col(text).isNotNull())
    near = near.filter(hashed < min(1 << 40, (sample << 40) // max(near.count(), 1)))
    sums = textkernel.mapped(near, _measure, "rule string, texts long, seconds double, rejected long").groupBy("rule").agg(*[F.sum(c).alias(c) for c in ("texts", "seconds", "rejected")]).collect()
    told = {r["rule"]: (r["seconds"] / max(r["texts"], 1), r["rejected"] / max(r["texts"], 1)) for r in sums}
    return sorted(((name, *told.get(name, (0.0, 0.0))) for name in RULES), key=lambda x: (-x[2] / max(x[1], 1e-9), x[1], x[0]))


def _cascade(order: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            counts = counted(column)
            failed = base_failed(counts)
            rejected: list[str | None] = [None] * len(column)
            alive = np.flatnonzero(~failed)
            held = dict(zip(alive.tolist(), column.take(pa.array(alive)).to_pylist(), strict=True))
            for name in order:
                rule = RULES[name]
                for k in list(held):
                    if rule(held[k], dict(zip(COUNTS, map(int, counts[k]), strict=True))):
                        rejected[k] = name
                        del held[k]
            kept = np.zeros(len(column), bool)
            kept[list(held)] = True
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *(pa.array(counts[:, k]) for k in range(len(COUNTS))), pa.array(failed), pa.array(kept), pa.array(rejected, pa.string())], names=[*batch.schema.names[1:], *COUNTS, "base_failed", "kept", "rejected_by"])

    return run


def quality_cascade(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), sample: int = SAMPLE) -> DataFrame:
    """The columns ``keep`` with COUNTS, ``base_failed``, ``kept`` and ``rejected_by`` (the first rule in the cascade's
    order that rejects; null if none does or the base fails).

    Null and empty texts have no words, so the base fails. Rows are judged each by itself, repeated ones alike, and texts of any
    length whole. Ties in the order of rules go by name, and change no verdict. An empty table gives none. Columns of ``keep``
    that are called like the results are replaced.
    """
    keep = tuple(k for k in keep if k not in (*COUNTS, "base_failed", "kept", "rejected_by"))
    order = [name for name, _, _ in ordered_rules(docs, text, sample)]
    kinds = dict(docs.dtypes)
    counts = ", ".join(f"{c} long" for c in COUNTS)
    rows = docs.select(F.col(text).alias("_text"), *keep)
    return textkernel.mapped(rows, _cascade(order), ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), counts, "base_failed boolean, kept boolean, rejected_by string"]))
