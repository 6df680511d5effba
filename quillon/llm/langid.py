"""Language identification with a byte convolutional network, trained here in numpy.

A text's UTF-8 bytes are cut into windows of WINDOW bytes, all of them, the last one padded. Bytes are embedded, filters of
several widths run over each window, the largest response of each filter is kept, and a linear layer gives a score for each
language. A text's scores are the mean of its windows', weighed by their bytes; softmax turns them into the answer.

Training takes a bounded sample: of each labelled language the PER_LANGUAGE distinct texts with the smallest hashes, and
WINDOWS windows spread over each; it goes to the driver, and grows with the number of languages alone. Prediction is one scan
and one map over Arrow batches; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillon.llm import textkernel
from quillon.plans.lineage import cut, sized_join

WINDOW, EMBED, FILTERS, WIDTHS = 256, 6, 12, (2, 3, 4)
#: The bound of the training sample, in texts of each language and windows of each text.
PER_LANGUAGE, WINDOWS = 400, 4
#: Windows in one numpy pass.
BLOCK = 256
UNKNOWN = "und"
#: A-Z is read as a-z.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


class ByteNet:
    """Embedding, one layer of multi-width filters, max pooling, softmax."""

    def __init__(self, langs: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.langs = langs
        self.p = {"e": rng.normal(0, 0.5, (256, EMBED)).astype(np.float32)}
        for w in WIDTHS:
            self.p[f"f{w}"] = rng.normal(0, (w * EMBED) ** -0.5, (w * EMBED, FILTERS)).astype(np.float32)
        self.p["o"] = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(langs))).astype(np.float32)
        self.p["b"] = np.zeros(len(langs), np.float32)
        self.p["e"][0] = 0

    def _spread(self, x: np.ndarray, w: int) -> np.ndarray:
        """Rows of w neighbouring embeddings: (windows, places, w * EMBED)."""
        n, places = x.shape[0], WINDOW - w + 1
        s = x.strides
        return np.lib.stride_tricks.as_strided(x, (n, places, w * EMBED), (s[0], s[1], s[2])).reshape(n * places, -1)

    def pooled(self, windows: np.ndarray, where: list | None = None) -> np.ndarray:
        x = np.ascontiguousarray(self.p["e"][windows])
        out = []
        for w in WIDTHS:
            y = (self._spread(x, w) @ self.p[f"f{w}"]).reshape(len(windows), WINDOW - w + 1, FILTERS)
            if where is not None:
                where.append(y.argmax(1))
            out.append(y.max(1))
        return np.maximum(np.concatenate(out, 1), 0)

    def logits(self, windows: np.ndarray) -> np.ndarray:
        return self.pooled(windows) @ self.p["o"] + self.p["b"]

    def _gradients(self, windows: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        where: list[np.ndarray] = []
        h = self.pooled(windows, where)
        z = h @ self.p["o"] + self.p["b"]
        z -= z.max(1, keepdims=True)
        prob = np.exp(z)
        prob /= prob.sum(1, keepdims=True)
        prob[np.arange(len(labels)), labels] -= 1
        prob /= len(labels)
        g = {"o": h.T @ prob, "b": prob.sum(0), "e": np.zeros_like(self.p["e"])}
        dh = (prob @ self.p["o"].T) * (h > 0)
        rows = np.arange(len(windows))[:, None]
        for k, w in enumerate(WIDTHS):
            d, at = dh[:, k * FILTERS : (k + 1) * FILTERS], where[k]
            own = np.stack([windows[rows, at + j] for j in range(w)], -1)  # (windows, FILTERS, w) bytes under each maximum
            x = self.p["e"][own].reshape(len(windows), FILTERS, w * EMBED)
            g[f"f{w}"] = np.einsum("nf,nfk->kf", d, x)
            dx = (d[:, :, None] * self.p[f"f{w}"].T[None]).reshape(len(windows), FILTERS, w, EMBED)
            np.add.at(g["e"], own.reshape(-1), dx.reshape(-1, EMBED))
        g["e"][0] = 0
        return g

    def train(self, windows: np.ndarray, labels: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.01, seed: int = 11) -> None:
        """Adam on cross-entropy; the same sample gives the same network."""
        rng = np.random.default_rng(seed)
        m, v, t = {k: np.zeros_like(x) for k, x in self.p.items()}, {k: np.zeros_like(x) for k, x in self.p.items()}, 0
        for _ in range(epochs):
            order = rng.permutation(len(labels))
            for a in range(0, len(order), batch):
                t += 1
                for k, d in self._gradients(windows[order[a : a + batch]], labels[order[a : a + batch]]).items():
                    m[k] = 0.9 * m[k] + 0.1 * d
                    v[k] = 0.999 * v[k] + 0.001 * d * d
                    self.p[k] -= (rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        """The language and its probability for every text of a column, over all its bytes."""
        data, offsets = textkernel.flat(column)
        sizes = np.diff(offsets)
        counts = -(-sizes // WINDOW)
        owner = np.repeat(np.arange(len(column)), counts)
        first = np.concatenate([[0], np.cumsum(counts)])
        starts = offsets[:-1][owner] + (np.arange(len(owner)) - first[owner]) * WINDOW
        lengths = np.minimum(WINDOW, offsets[1:][owner] - starts)
        total = np.zeros((len(column), len(self.langs)), np.float64)
        for a in range(0, len(owner), BLOCK):
            s, n = starts[a : a + BLOCK], lengths[a : a + BLOCK]
            place = np.minimum(s[:, None] + np.arange(WINDOW), len(data) - 1)
            windows = np.where(np.arange(WINDOW) < n[:, None], _FOLD[data[place]], 0)
            np.add.at(total, owner[a : a + BLOCK], self.logits(windows) * n[:, None])
        z = total / np.maximum(sizes, 1)[:, None]
        z -= z.max(1, keepdims=True)
        prob = np.exp(z)
        prob /= prob.sum(1, keepdims=True)
        best = prob.argmax(1)
        return [self.langs[k] for k in best], prob[np.arange(len(best)), best]


def training_sample(labelled: DataFrame, text: str, lang: str, per_language: int = PER_LANGUAGE) -> list[tuple[str, list[str]]]:
    """(language, pieces) of the ``per_language`` distinct texts of each language with the smallest hashes, all if there are
    fewer. Pieces are WINDOWS stretches of WINDOW characters, spread over the whole text.

    A share of the hashes, from each language's approximate number of distinct texts, holds about twice the sample and bounds
    what tasks send, whatever repeats; the ranking afterwards makes the sample exact.
    """
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    hashed = F.xxhash64("text")
    shares = rows.groupBy("lang").agg((F.lit(2.0 * per_language) / F.approx_count_distinct(hashed)).alias("share"))
    step = F.greatest((F.length("text") / WINDOWS).cast("int"), F.lit(WINDOW))
    pieces = F.filter(F.transform(F.sequence(F.lit(0), F.lit(WINDOWS - 1)), lambda k: F.substr(F.col("text"), k * step + 1, F.lit(WINDOW))), lambda x: F.length(x) > 0)
    near = sized_join(rows, cut(shares, "languages"), "lang", "inner", "lang").withColumn("h", F.pmod(hashed, F.lit(1 << 40)))
    some = near.filter(F.col("h") < F.col("share") * float(1 << 40)).groupBy("lang", "h").agg(F.min(pieces).alias("pieces"))
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).filter(F.col("rank") <= per_language)
    return [(r["lang"], r["pieces"]) for r in sorted(ranked.select("lang", "rank", "pieces").collect(), key=lambda r: (r["lang"], r["rank"]))]


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> ByteNet | None:
    """A network of the labels in ``labelled``; None if it has no labelled text with a letter. Repeated rows and texts count
    once, null labels and texts not at all; a long text gives as many windows as others, spread over its whole length."""
    sample = training_sample(labelled, text, lang, per_language)
    if not sample:
        return None
    langs = sorted({k for k, _ in sample})
    cut = [(langs.index(k), x.encode()[:WINDOW]) for k, pieces in sample for x in pieces]
    # Short texts and the ends of long ones give short windows: learn from some of those too.
    cut += [(k, x[: 24 + 8 * (i % 8)]) for i, (k, x) in enumerate(cut) if i % 4 == 0]
    windows = np.zeros((len(cut), WINDOW), np.uint8)
    for i, (_, x) in enumerate(cut):
        windows[i, : len(x)] = _FOLD[np.frombuffer(x, np.uint8)]
    net = ByteNet(langs)
    net.train(windows, np.array([k for k, _ in cut]))
    return net


def _predict(net: ByteNet | None, text: str, keep: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = np.array(batch.column(1).to_pylist(), bool)
            if net is None:
                langs, scores = [UNKNOWN] * len(known), np.zeros(len(known))
            else:
                langs, scores = net.predict(batch.column(0))
            langs = [x if k else UNKNOWN for x, k in zip(langs, known, strict=True)]
            others = iter(batch.columns[2:])
            kept = [batch.column(0) if k == text else next(others) for k in keep]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(langs, pa.string()), pa.array(np.where(known, scores, 0.0))], names=[*keep, "lang_pred", "score"])

    return run


def identify(docs: DataFrame, net: ByteNet | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` with ``lang_pred`` and ``score``.

    A text that is null or has no letter is ``und`` with score 0; so are all texts without a network. Texts are read whole,
    a few windows at a time, however long they are. Rows are judged each by itself, repeated ones alike; of equal scores the
    first language by name wins; an empty table gives none. Columns of ``keep`` that are called like the results are replaced;
    others don't matter.
    """
    keep = tuple(k for k in keep if k not in ("lang_pred", "score"))
    kinds = dict(docs.dtypes)
    letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    source = docs.select(F.col(text).alias("_text"), letter.alias("_letter"), *[k for k in keep if k != text])
    return textkernel.mapped(source, _predict(net, text, keep), ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), "lang_pred string, score double"]))


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from training: crc32 of its id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))
