"""Words and word n-grams of Arrow text columns as 64-bit hashes, with numpy over whole batches.

Words are runs of bytes other than ASCII white space, so UTF-8 needs no decoding. A word's hash is a polynomial over its
bytes modulo 2**64, taken from running sums, and then mixed. Two different words share one with a chance of about 2**-60.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Bytes of text that one numpy pass covers, so that memory stays bounded whatever the batch; longer texts come alone.
CHUNK_BYTES = 1 << 19
#: Bytes of an Arrow batch between Spark and a worker; a longer row comes alone.
BATCH_BYTES = 4 << 20
_SEED = np.random.default_rng(20_231)
_ODD = lambda n: _SEED.integers(0, 1 << 62, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TABLE, _GRAM, _LENGTH = _ODD(256), _ODD(64), _ODD(64)
_BASE = np.uint64(0x5851F42D4C957F2D)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_TABLE[_SPACE] = 0
_FOLDED = _TABLE.copy()
_FOLDED[65:91] = _TABLE[97:123]
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def release() -> None:
    """Give freed memory back to the system: workers are kept for later tasks, and what they hold is lost to the executor."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, a map over a task's Arrow batches, with ``release`` after its last batch."""

    @functools.wraps(run)
    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return outer


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``df.mapInArrow(run, schema)`` in batches of BATCH_BYTES: rows say nothing about what a batch of texts takes, on either
    side. The limit is a setting of the session, which stays, as the result is lazy; a session's own setting wins."""
    conf, limit = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(limit, None) is None:
        conf.set(limit, str(BATCH_BYTES))
    return df.mapInArrow(released(run), schema)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and the offset of each text, one more at the end; null is empty."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data or b"", np.uint8), offsets


@dataclass
class Words:
    """The words of consecutive texts: those of text ``first + k`` are ``bounds[k]`` to ``bounds[k + 1]``."""

    first: int
    bounds: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray
    offsets: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def words(column: pa.Array, fold: bool = False, hashed: bool = True) -> Iterator[Words]:
    """The words of a text column, in chunks of whole texts; ``fold``: A-Z counts as a-z."""
    data, offsets = flat(column)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1)
        to = min(to, len(column))
        part, local = data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        inside = np.zeros(len(part) + 2, bool)
        np.logical_not(_SPACE[part], out=inside[1:-1])
        here = inside[1:-1]
        first, last = here & ~inside[:-2], here & ~inside[2:]
        edges = local[1:-1]
        edges = edges[(edges > 0) & (edges < len(part))]
        first[edges] = here[edges]
        last[edges - 1] = here[edges - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        hashes = np.zeros(0, np.uint64)
        if hashed:
            power, inverse = _power(len(part) + 1)
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum((_FOLDED if fold else _TABLE)[part] * power[: len(part)], out=sums[1:])
            hashes = mix((sums[ends] - sums[starts]) * inverse[starts])
        yield Words(at, np.searchsorted(starts, local), hashes, starts, ends, part, local)
        at = to


def grams(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words, and their bounds by text; a text of fewer words is one run, one of none has none."""
    counts = w.counts
    runs = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(runs)])
    total = len(w.hashes)
    every = np.zeros(max(total - n + 1, 0), np.uint64)
    for k in range(n):
        every += w.hashes[k : total - n + 1 + k] * _GRAM[k] if len(every) else every
    out = np.zeros(bounds[-1], np.uint64)
    place = np.repeat(w.bounds[:-1] - bounds[:-1], runs) + np.arange(bounds[-1])
    short = np.repeat(counts < n, runs)
    out[~short] = every[place[~short]]
    for k in np.flatnonzero((counts < n) & (counts > 0)):
        own = w.hashes[w.bounds[k] : w.bounds[k + 1]]
        out[bounds[k]] = np.append(own * _GRAM[: len(own)], _LENGTH[len(own)]).sum(dtype=np.uint64)
    return mix(out), bounds
