"""Mix sources to target weights: subset-sum budget fitting.

1. Documents are counted by (source, exact size); sources' totals and targets come from the counts.
2. Each source takes all its documents ``floor(target / total)`` times. What is left of its target is split over its sizes:
   an equal share of each size's documents, rounded down, and a bounded-knapsack dynamic programme for the remainder. The
   programme sees distinct sizes and their counts, never documents; its table has ``TABLE`` words, whatever the texts' sizes.
3. Of each (source, size), the documents with the smallest seeded hashes are selected.

Scale: one map-side aggregate by (source, size, hash bucket), a table of distinct sizes for each source, and a join that
hands each size its quota: one row a source and size, broadcast up to QUOTA_BYTES, so that texts are not shuffled. A hot source
or size is spread over BUCKETS hash buckets, and only one bucket of each size is ever ranked in part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillon.llm import textkernel
from quillon.plans.lineage import cut, sized_join

#: Words that the dynamic programme's table covers.
TABLE = 1 << 16
BUCKETS = 256
#: Quotas that may be broadcast: those of 400,000 different sizes of a source.
QUOTA_BYTES = 64 << 20


def _sizes(kept: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [w.counts for w in textkernel.words(batch.column(0), hashed=False)]
            size = pa.array(np.concatenate(counts) if counts else [], pa.int64())
            yield pa.RecordBatch.from_arrays([size, *batch.columns[1 - kept :]], names=["size", *batch.schema.names[1 - kept :]])

    return run


def with_size(rows: DataFrame, text: str, drop: bool) -> DataFrame:
    """``size`` (number of words; null: 0) and the columns of ``rows``, whose first is the text, without it if ``drop``."""
    schema = ", ".join(["size long", *(f"`{k}` {kind}" for k, kind in rows.dtypes if k != text or not drop)])
    return textkernel.mapped(rows, _sizes(int(not drop)), schema)


def share_out(sizes: list[int], weights: list[float], words: float, most: float) -> list[float]:
    """Targets that share ``words`` by weight; one that would pass ``most`` times its source's size stops there, and the
    excess goes to the others by weight, until none is above."""
    targets, free, left = [0.0] * len(sizes), set(range(len(sizes))), float(words)
    while free:
        each = left / sum(weights[k] for k in free)
        over = {k for k in free if each * weights[k] > most * sizes[k]}
        for k in over or free:
            targets[k] = float(most * sizes[k]) if over else each * weights[k]
        if not over:
            break
        left -= sum(targets[k] for k in over)
        free -= over
    return targets


def _programme(sizes: np.ndarray, spare: np.ndarray, left: int) -> tuple[np.ndarray, int]:
    """How many of ``spare`` documents of each size come nearest to ``left`` words, at most TABLE / 2, and by how much they miss.

    Which sums can be reached is a bit each, in a bounded knapsack with counts in powers of two. A document beyond the table
    would pass ``left`` by more than there is of it.
    """
    mask, reach, steps, more = (1 << (TABLE + 1)) - 1, 1, [], np.zeros(len(sizes), np.int64)
    for k in np.argsort(-sizes.astype(np.int64), kind="stable"):
        rest, power = min(int(spare[k]), TABLE // int(sizes[k])) if sizes[k] else 0, 1
        while rest > 0 and not reach >> left & 1:
            use = min(power, rest)
            now = reach | (reach << use * int(sizes[k]) & mask)
            if now != reach:
                steps.append((k, use, reach))
                reach = now
            rest, power = rest - use, power * 2
        if reach >> left & 1:
            break
    below = (reach & ((1 << (left + 1)) - 1)).bit_length() - 1
    above = reach >> left
    above = left + ((above & -above).bit_length() - 1) if above else below
    goal = above if above - left < left - below else below
    miss = abs(goal - left)
    for k, use, before in reversed(steps):
        if not before >> goal & 1:
            more[k] += use
            goal -= use * int(sizes[k])
    return more, miss


def fit(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each size to take, ``counts`` at most, for a sum near ``budget``.

    An equal share of each size's documents comes first, then, while more is left than the table covers, the largest sizes,
    then the programme. Where that misses a budget that the table covers, the programme starts from nothing, and the sum is
    the nearest there is.
    """
    sizes, counts = sizes.astype(object), counts.astype(object)
    total = int((sizes * counts).sum())
    budget = min(max(int(budget), 0), total)
    if not total:
        return np.zeros(len(sizes), np.int64)
    taken = counts * budget // total
    left = budget - int((sizes * taken).sum())
    largest_first = np.argsort(-sizes.astype(np.int64), kind="stable")
    for room in (TABLE // 2, 0):
        for k in largest_first:
            if left > TABLE // 2 and sizes[k]:
                more = max(0, min(int(counts[k] - taken[k]), (left - room) // int(sizes[k])))
                taken[k] += more
                left -= more * int(sizes[k])
    if left > TABLE // 2:
        # Only documents of more words than are left: the smallest, if it passes by less.
        over = [int(k) for k in largest_first if taken[k] < counts[k] and sizes[k]]
        if over and int(sizes[over[-1]]) - left < left:
            taken[over[-1]] += 1
        return taken.astype(np.int64)
    more, miss = _programme(sizes, counts - taken, left)
    if miss and budget <= TABLE // 2:
        alone, least = _programme(sizes, counts, budget)
        if least < miss:
            return alone
    return taken.astype(np.int64) + more


def _targets(weights: tuple[float, ...], share: float, most: float):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        names = frame["source"]
        order = sorted(range(len(frame)), key=lambda k: (names.iloc[k] is None, names.iloc[k] or ""))
        frame = frame.iloc[order].reset_index(drop=True)
        sizes = [int(x) for x in frame["source_size"]]
        frame["target"] = share_out(sizes, [weights[k % len(weights)] for k in range(len(frame))], share * sum(sizes), most)
        return frame[["source", "source_size", "target"]]

    return run


def _plan(frame: pd.DataFrame) -> pd.DataFrame:
    """Of one source: how often each size's documents are all taken, and how many of them once more."""
    frame = frame.sort_values("size", kind="stable").reset_index(drop=True)
    total, target = int(frame["source_size"].iloc[0]), float(frame["target"].iloc[0])
    times = int(target // total) if total else 0
    frame["times"] = np.int64(times)
    frame["quota"] = fit(frame["size"].to_numpy(), frame["n"].to_numpy(), round(target - times * total)) if times < 2 else np.int64(0)
    return frame[["source", "size", "source_size", "target", "times", "quota"]]


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2, seed: int = 17, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` of every row, and its columns ``keep``.

    Sources are weighed in order of code point, null last, as a source of its own; texts that are null or without words
    have size 0 and are never taken more than their source's full passes. ``copies`` is 0, 1 or 2 by ``most``; ``taken``
    is copies times size. Ties in the seeded hash go by id; rows that repeat an id and size are interchangeable. An empty
    table gives none. Texts of any length are counted whole. Columns of ``keep`` that are called like the results are
    replaced by them; any other name will do, as columns are carried under names of their own.
    """
    results = ("doc_id", "source", "size", "source_size", "target", "copies", "taken")
    names = [k for k in keep if k not in (doc_id, source, *results)]
    carried = {k: f"_keep_{i}" for i, k in enumerate(names)}
    rows = docs.select(F.col(text).alias(carried.get(text, "_text")), F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), *[F.col(f"`{k}`").alias(c) for k, c in carried.items() if k != text])
    sized = cut(with_size(rows, rows.columns[0], text not in carried), "sizes")
    hashed = F.xxhash64(F.lit(seed), F.col("doc_id"))
    bucket = F.pmod(F.shiftrightunsigned(hashed, 20), F.lit(BUCKETS)).alias("bucket")
    counts = cut(sized.groupBy("source", "size", bucket).agg(F.count(F.lit(1)).alias("n")), "counts")
    by_size = counts.groupBy("source", "size").agg(F.sum("n").alias("n"))
    totals = by_size.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).cast("long").alias("source_size"))
    targets = cut(totals.groupBy().applyInPandas(_targets(weights, share, most), "source string, source_size long, target double"), "targets")
    with_target = sized_join(by_size.alias("b"), targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source")), "inner", "source").select("b.*", "source_size", "target")
    plan = cut(with_target.groupBy("source").applyInPandas(_plan, "source string, size long, source_size long, target double, times long, quota long"), "plan")
    # A size's quota goes to its buckets in order: whole ones up to a last, of which it takes a part; so one row a size tells all.
    same = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source")) & (F.col(f"{a}.size") == F.col(f"{b}.size"))
    earlier = F.coalesce(F.sum("n").over(Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    filled = sized_join(counts.withColumn("earlier", earlier).alias("c"), plan.alias("p"), same("c", "p"), "inner", "source").select("c.*", "source_size", "target", "times", "quota")
    reached = F.when(F.col("earlier") + F.col("n") > F.col("quota"), F.struct(F.col("bucket").alias("last"), (F.col("quota") - F.col("earlier")).alias("some")))
    quotas = filled.groupBy("source", "size", "source_size", "target", "times").agg(F.min(reached).alias("r"))
    quotas = cut(quotas.select("source", "size", "source_size", "target", "times", F.coalesce("r.last", F.lit(BUCKETS)).alias("last"), F.coalesce("r.some", F.lit(0)).alias("some")), "quotas")
    asked = sized_join(sized.withColumn("bucket", bucket).alias("s"), quotas.alias("q"), same("s", "q"), "inner", "source", limit=QUOTA_BYTES)
    asked = asked.select("s.*", "source_size", "target", "times", "last", "some")
    partly = (F.col("bucket") == F.col("last")) & (F.col("some") > 0)
    rank = F.row_number().over(Window.partitionBy("source", "size").orderBy(hashed, "doc_id"))
    once = asked.filter(~partly).withColumn("more", (F.col("bucket") < F.col("last")).cast("long"))
    part = asked.filter(partly).withColumn("more", (rank <= F.col("some")).cast("long"))
    out = once.unionByName(part).withColumn("copies", F.col("times") + F.col("more")).withColumn("taken", F.col("copies") * F.col("size"))
    return out.select(*results, *[F.col(c).alias(k) for k, c in carried.items()])
