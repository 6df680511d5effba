"""Exact Jaccard join over word shingles, as a join in the metric space of sets with the Jaccard distance.

Two documents link at a distance of 1 - t = eps at most. Equal sets are one class, of which one document goes on; shingles
that a single class has can't be shared, and count only by number.

1. Cells. Almost all distances of a corpus are 1, at which no pivot prunes anything (README has figures), so the space is
   first cut into cells where distances are less: two documents that link share one of the first |x| - ceil(t |x|) + 1
   shingles of either, in order of rarity, and the cell of a shingle is the documents that have it among those. This is
   a prefix filter over an inverted index, not a metric step; it loses no link.
2. Regions. A cell's first pivot is its most central document, and all others are measured against it. Cells whose
   documents are in different components by then join recursively: of PIVOTS document pivots, each document's nearest one,
   by measured distance, has it in its Voronoi region. By the triangle inequality a partner y of x is no farther from x's
   pivot p than d(y, p) <= d(y, q) + 2 eps, q being y's own, so y is replicated to every region within that window, and x and y
   meet in x's. Regions join in the same way, down to LEAF documents, which are compared pair by pair.
3. Where windows would replicate so much that regions save nothing (distances that are all alike), a region stays whole and
   takes more and more pivots at once.

At every step a pair is skipped if its documents are in one component, if their distances to the region's pivot differ by more
than eps (the window of one pivot), or if the shingles from the cell's on are too few for the threshold.

Exactness: shingles are 64-bit hashes, of which the shuffle keeps the bucket and 48 bits (all 64 of common ones): two documents of
300 shingles have one in common by accident with a chance of some 3 * 10^-11. All counts are exact.

Scale: one shuffle of 6 bytes a shingle in numpy blobs. Shingles that a share of 1 / HEAVY of all documents have bypass their
bucket, so that copies and passages make no hot task; tasks count them in Misra-Gries summaries of HELD entries, which find
every shingle that stands in rows / HEAVY + shingles / HELD documents (and LOCAL_HEAVY a task). Cells and regions are DataFrame
joins that Spark can split; none is numbered or gathered by key. A pivot's set is sent once to each salted group of those that
are measured against it. Each phase ends in a table in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.llm import textkernel
from quillon.llm.components import components
from quillon.plans.lineage import cut, sized_join

#: Shingles in one task's blobs, and in a bucket.
FLUSH, BUCKET = 300_000, 600_000
#: A shingle is heavy if a share of 1/HEAVY of all documents has it, and is among the HEAVY_MOST commonest (8 bytes each in every
#: task); a task's summary of HELD entries reports those that it saw LOCAL_HEAVY times.
HEAVY, HEAVY_MOST, HELD, LOCAL_HEAVY = 1000, 1 << 18, 1 << 18, 4
#: Pivots that split a region, documents of a region that is compared pair by pair, pairs in a salted group of one pivot.
PIVOTS, LEAF, GROUP = 8, 32, 250


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Lists of (id, distinct shingles), of about FLUSH shingles each."""
    held, total = [], 0
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for w in textkernel.words(batch.column(1), fold=True):
            hashes, bounds = textkernel.grams(w, n)
            for k in range(len(bounds) - 1):
                own = np.unique(hashes[bounds[k] : bounds[k + 1]])
                held.append((ids[w.first + k], own))
                total += len(own)
            if total >= FLUSH:
                yield held
                held, total = [], 0
    if held:
        yield held


def _digest(own: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        a, b = own.sum(dtype=np.uint64), textkernel.mix(own ^ np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


class _Often:
    """A Misra-Gries summary: counts of keys, too low by no more than all counts over HELD."""

    def __init__(self) -> None:
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray) -> None:
        own, times = np.unique(keys, return_counts=True)
        keys, counts = np.concatenate([self.keys, own]), np.concatenate([self.counts, times])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        keys, counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
        if len(keys) > HELD:
            counts = counts - np.partition(counts, len(counts) - HELD - 1)[len(counts) - HELD - 1]
            keys, counts = keys[counts > 0], counts[counts > 0]
        self.keys, self.counts = keys, counts


def _signatures(n: int):
    """Rows (doc_id, n, d1, d2) of every document, and (key, hits) of the shingles that a task's summary has often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, often = ["doc_id", "n", "d1", "d2", "key", "hits"], _Often()
        for held in _sets(batches, n):
            digests = [_digest(s) for _, s in held]
            null = pa.nulls(len(held), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in held], pa.int64()), pa.array([len(s) for _, s in held], pa.int64()), pa.array([a for a, _ in digests], pa.int64()), pa.array([b for _, b in digests], pa.int64()), null, null], names=names)
            once = {d: s for d, (_, s) in zip(digests, held, strict=True)}
            often.add(np.concatenate([*once.values()]))
        some = often.counts >= LOCAL_HEAVY
        null = pa.nulls(int(some.sum()), pa.int64())
        yield pa.RecordBatch.from_arrays([null, null, null, null, pa.array(often.keys[some].view(np.int64)), pa.array(often.counts[some])], names=names)

    return run


def _planes(x: np.ndarray) -> bytes:
    """The bytes of all values, lowest first: those that hardly vary then lie together, and the shuffle compresses them."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def _values(parts, kind: type) -> np.ndarray:
    """The values of several ``_planes``."""
    width = np.dtype(kind).itemsize
    return np.concatenate([np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(width, -1).T).view(kind)[:, 0] for x in parts])


def _ids(parts: pd.Series) -> np.ndarray:
    """The ids of several blobs, from their differences."""
    return np.concatenate([np.cumsum(_values([x], np.int64)) for x in parts])


def _shred(n: int, buckets: int, heavy: np.ndarray):
    """Blobs of 6-byte shingles by bucket: rows (bucket, ids, ns, counts, keys), and heavy ones of 8 bytes apart.

    Ids rise within a blob and go as differences, so that a document costs a bucket a few bytes besides its shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _sets(((b.filter(pa.compute.is_valid(b.column(0)))) for b in batches), n):
            once = sorted(((i, own) for i, own in held if len(own)), key=lambda x: x[0])
            if not once:
                continue
            ids = np.array([i for i, _ in once], np.int64)
            sizes = np.array([len(own) for _, own in once], np.int32)
            keys, owner = np.concatenate([own for _, own in once]), np.repeat(np.arange(len(ids)), sizes)
            often = np.isin(keys, heavy)
            place = np.where(often, textkernel.mix(ids.view(np.uint64))[owner] % np.uint64(buckets), textkernel.mix(keys) % np.uint64(buckets)).astype(np.int64)
            rows: dict[str, list] = {k: [] for k in ("bucket", "heavy", "ids", "ns", "counts", "keys")}
            order = np.lexsort((owner, often, place))
            group = place[order] * 2 + often[order]
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]])
            for a, b in zip(cuts, cuts[1:], strict=False):
                part = order[a:b]
                whose, counts = np.unique(owner[part], return_counts=True)
                own = keys[part]
                is_heavy = bool(group[a] % 2)
                packed = own if is_heavy else np.ascontiguousarray(own.view(np.uint8).reshape(-1, 8)[:, :6])
                for k, v in zip(rows, (int(group[a] // 2), is_heavy, _planes(np.diff(ids[whose], prepend=0)), _planes(sizes[whose]), _planes(counts.astype(np.int32)), packed.tobytes()), strict=True):
                    rows[k].append(v)
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("bucket", pa.int64()), ("heavy", pa.bool_()), *((k, pa.binary()) for k in ("ids", "ns", "counts", "keys"))]))

    return run


def _shared(groups: int):
    """Of a bucket, the shingles that two texts have or more, in blobs by groups of documents: rows (grp, ids, ns, counts,
    keys, dfs); heavy shingles have df 255. There are as many groups as buckets, and no more rows than shingles."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for is_heavy in (False, True):
            part = group[group["heavy"] == is_heavy]
            if not len(part):
                continue
            ids, ns, counts = _ids(part["ids"]), _values(part["ns"], np.int32), _values(part["counts"], np.int32)
            raw = b"".join(part["keys"])
            if is_heavy:
                keys = np.frombuffer(raw, np.uint64)
            else:
                wide = np.zeros((len(raw) // 6, 8), np.uint8)
                wide[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
                keys = wide.view(np.uint64)[:, 0]
            order = np.argsort(ids, kind="stable")
            rank = np.empty(len(ids), np.int64)
            rank[order] = np.arange(len(ids))
            # A row that repeats counts once.
            keep = np.zeros(len(ids), bool)
            keep[np.unique(ids, return_index=True)[1]] = True
            owner = np.repeat(np.arange(len(ids)), counts)
            mask = keep[owner]
            owner, keys, ids, ns = rank[owner[mask]], keys[mask], ids[order], ns[order]
            if is_heavy:
                dfs = np.full(len(keys), 255, np.uint8)
            else:
                order = np.argsort(keys, kind="stable")
                owner, keys = owner[order], keys[order]
                edge = np.concatenate([[True], keys[1:] != keys[:-1]])
                first = np.flatnonzero(edge)
                df = np.diff(np.append(first, len(keys)))[np.cumsum(edge) - 1]
                some = df > 1
                # Bucket and 48 bits tell shingles apart as well as 48 + log2(buckets) bits do.
                owner, dfs = owner[some], np.minimum(df[some], 254).astype(np.uint8)
                keys = textkernel.mix(keys[some] ^ textkernel.mix(np.full(1, group["bucket"].iloc[0], np.uint64)))
            place = (textkernel.mix(ids.view(np.uint64)) % np.uint64(groups)).astype(np.int64)
            order = np.lexsort((owner, place[owner]))
            owner, keys, dfs = owner[order], keys[order], dfs[order]
            grp = place[owner]
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(grp)) + 1, [len(grp)]]) if len(grp) else [0]
            for a, b in zip(cuts, cuts[1:], strict=False):
                whose, counts = np.unique(owner[a:b], return_counts=True)
                out.append((int(grp[a]), _planes(np.diff(ids[whose], prepend=0)), _planes(ns[whose]), _planes(counts.astype(np.int32)), keys[a:b].tobytes(), dfs[a:b].tobytes()))
        textkernel.release()
        return pd.DataFrame(out, columns=["grp", "ids", "ns", "counts", "keys", "dfs"])

    return run


def _regions(pct: int):
    """Of a group of documents, those that can have a partner: their shared shingles in order of value, how many and how
    common these are, and those whose regions the document is replicated to."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        ids, ns, counts = _ids(group["ids"]), _values(group["ns"], np.int32), _values(group["counts"], np.int32)
        keys, dfs = (np.frombuffer(b"".join(group[k]), t) for k, t in (("keys", np.uint64), ("dfs", np.uint8)))
        docs, size = np.repeat(ids, counts), np.repeat(ns, counts)
        order = np.argsort(docs, kind="stable")
        docs, size, keys, dfs = docs[order], size[order], keys[order], dfs[order]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(docs)) + 1, [len(docs)]]) if len(docs) else [0]
        out = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            n, had, own, df = int(size[a]), int(b - a), keys[a:b], dfs[a:b]
            if had * 100 < n * pct:
                continue
            most = n - -(-pct * n // 100) + 1 - (n - had)
            first = own[np.lexsort((own, df))[:most]].view(np.int64)
            out.append((int(docs[a]), n, had, 1000 * int(df.sum(dtype=np.int64)) // n, np.sort(own).tobytes(), first))
        textkernel.release()
        return pd.DataFrame(out, columns=["doc_id", "n", "had", "central", "keys", "pivots"])

    return run


def _distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (p, x, n, keys) in order of p, the pivot's own first with null x: rows (p, x, common, total)."""
    head = own = None
    for batch in batches:
        p, x, n, keys = (c.to_pylist() for c in batch.columns)
        out = []
        for k in range(len(p)):
            if x[k] is None:
                head, own = (p[k], n[k]), np.frombuffer(keys[k], np.uint64)
                continue
            common = len(np.intersect1d(own, np.frombuffer(keys[k], np.uint64), assume_unique=True))
            out.append((p[k], x[k], common, head[1] + n[k] - common))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(4)], names=["p", "x", "common", "total"])


def _measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``p, x, common, total, d`` of distinct pairs (p, x): each salted group of a pivot gets its set once, then its partners."""
    pairs = cut(pairs.distinct(), "pairs")
    many = cut(pairs.groupBy("p").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > GROUP), "hubs")
    salt = F.when(F.col("n").isNotNull(), F.pmod(F.xxhash64("x"), F.floor(F.col("n") / GROUP) + 1)).otherwise(F.lit(0))
    salted = sized_join(pairs, many, "p", "left").select("p", "x", salt.cast("long").alias("salt"))
    heads = salted.select("p", "salt").distinct().join(sets.select(F.col("doc_id").alias("p"), "n", "keys"), "p").select("p", "salt", F.lit(None).cast("long").alias("x"), "n", "keys")
    others = salted.join(sets.select(F.col("doc_id").alias("x"), "n", "keys"), "x").select("p", "salt", "x", "n", "keys")
    groups = heads.unionByName(others).repartition("p", "salt").sortWithinPartitions("p", "salt", F.col("x").asc_nulls_first())
    told = cut(textkernel.mapped(groups.select("p", "x", "n", "keys"), _distances, "p long, x long, common long, total long"), "distances")
    return told.withColumn("d", 1 - F.col("common") / F.col("total"))


def _roots(sets: DataFrame, pct: int) -> DataFrame:
    """``node, root`` of the documents that have a partner at J >= pct/100: the components of enough of their links."""
    eps = 1 - pct / 100 + 1e-9

    def fits(x: str, y: str) -> Column:
        """Whether J can reach the threshold by shingles that come no earlier than the cell's: of n, each has ``had`` of
        those. A pair with an earlier one in common meets in that one's cell."""
        (n, h), (m, k) = ((F.col(f"{c}.n"), F.col(f"{c}.had")) for c in (x, y))
        return F.least(h, k) * 100 >= (n - h + m - k + F.greatest(h, k)) * pct

    near = F.col("common") * 100 >= F.col("total") * pct
    placed = sets.select("doc_id", "n", "had", "central", F.posexplode("pivots").alias("pos", "s"))
    cells = placed.select("s", F.struct((-F.col("central")).alias("order"), "doc_id", "n", (F.col("had") - F.col("pos")).alias("had")).alias("x"))
    first = cells.groupBy("s").agg(F.min("x").alias("p"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = cells.join(first, "s").filter("x.doc_id <> p.doc_id")
    known = _measured(members.filter(fits("x", "p")).select(F.col("p.doc_id").alias("p"), F.col("x.doc_id").alias("x")), sets)
    roots = cut(components(known.filter(near).select(F.col("p").alias("a"), F.col("x").alias("b"))), "roots")
    # Regions: number, members with their distance to its pivot (null: more than eps), whether a member is at home or replicated to
    # it, and how many pivots it takes next.
    own = known.select(F.col("p").alias("first"), F.col("x").alias("id"), "d")
    rest = members.filter("size > 2").select(F.col("s").alias("g"), F.col("x.doc_id").alias("id"), "x", F.col("p.doc_id").alias("first"))
    rest = rest.join(own, ["first", "id"], "left").select("g", "id", "x", "d", F.lit(True).alias("home"), F.lit(PIVOTS).cast("long").alias("pivots"))
    while True:
        named = rest.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
        mixed = named.groupBy("g").agg(F.count(F.lit(1)).alias("size"), F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("g", "size")
        few = F.greatest(F.lit(LEAF), F.when(F.col("pivots") > PIVOTS, F.col("pivots")).otherwise(0))
        rest = cut(named.join(mixed, "g").withColumn("leaf", F.col("size") <= few), "regions")
        if not rest.limit(1).count():
            return roots
        # The most central document of each of as many classes as the region takes pivots, by hash; all of a leaf's.
        one = F.when(F.col("leaf"), F.col("id")).otherwise(F.pmod(F.xxhash64("id", "pivots"), F.col("pivots")))
        picked = rest.groupBy("g", one.alias("class")).agg(F.min(F.struct("x", "root", "d", "home")).alias("q"))
        picked = cut(picked.select("g", F.col("q.x").alias("q"), F.col("q.root").alias("root_q"), F.col("q.d").alias("d_q"), F.col("q.home").alias("home_q")), "pivots")
        split = ~F.col("leaf") & (F.col("pivots") == PIVOTS)
        within = F.coalesce(F.abs(F.col("d") - F.col("d_q")) <= eps, F.lit(True)) & (F.col("root") != F.col("root_q")) & fits("x", "q") & (F.col("home") | F.col("home_q"))
        once = ~F.col("leaf") | (F.col("q.doc_id") < F.col("id"))
        asked = rest.join(picked, "g").filter((F.col("id") != F.col("q.doc_id")) & (split | (within & once)))
        found = _measured(asked.select(F.col("q.doc_id").alias("p"), F.col("id").alias("x")), sets)
        new = found.filter(near).select(F.col("p").alias("a"), F.col("x").alias("b"))
        if new.limit(1).count():
            known_links = roots.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
            roots = cut(components(known_links.unionByName(new)), "roots")
        # A pivot has met its whole region and leaves it; a leaf is done.
        left = rest.filter(~F.col("leaf")).join(picked.select("g", F.col("q.doc_id").alias("id")), ["g", "id"], "left_anti")
        whole = left.filter(F.col("pivots") > PIVOTS).select("g", "id", "x", "d", "home", (F.col("pivots") * 16).alias("pivots"))
        # Voronoi regions of the pivots, with the window that replicates boundary documents.
        to = left.filter(F.col("pivots") == PIVOTS).select("g", "id", "x", "home", "size").join(picked.select("g", F.col("q.doc_id").alias("q")), "g")
        to = cut(to.join(found.select(F.col("p").alias("q"), F.col("x").alias("id"), "d"), ["q", "id"]), "to-pivots")
        nearest = to.groupBy("g", "id").agg(F.min(F.struct("d", "q")).alias("own"))
        dealt = to.join(nearest, ["g", "id"]).filter(F.col("d") <= F.col("own.d") + 2 * eps).withColumn("home", F.col("home") & (F.col("q") == F.col("own.q")))
        dealt = cut(dealt.drop("own"), "dealt")
        # Regions that would compare more than half the pairs of the whole stay whole, with the distances to one pivot.
        sizes = dealt.groupBy("g", "q").agg(F.count(F.lit(1)).cast("double").alias("n"), F.max("size").cast("double").alias("size"))
        gain = sizes.groupBy("g").agg((F.sum(F.col("n") * F.col("n")) * 2 <= F.max(F.col("size") * F.col("size"))).alias("saves"), F.min("q").alias("one"))
        judged = dealt.join(gain.filter("saves").select("g"), "g", "left_semi")
        regions = judged.select(F.xxhash64("g", "q").alias("g"), "id", "x", "d", "home", F.lit(PIVOTS).cast("long").alias("pivots"))
        kept = to.join(gain.filter(~F.col("saves")).select("g", F.col("one").alias("q")), ["g", "q"]).select("g", "id", "x", "d", "home", F.lit(PIVOTS * 16).cast("long").alias("pivots"))
        rest = regions.unionByName(kept).unionByName(whole)


def jaccard_components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", n: int = 5, pct: int = 75) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row: set size, and the smallest id that links reach.

    Null and empty texts have no shingles and link with nothing, not even each other. A row without an id gets its set
    size and no component, and links nothing. Ids are whole numbers; rows that repeat one must repeat its text, and get
    equal results. Ties in J count as links. Texts of any length are read whole; a task holds about FLUSH shingles, or one
    text's. An empty table gives none; other columns don't matter.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    seen = cut(textkernel.mapped(docs, _signatures(n), "doc_id long, n long, d1 long, d2 long, key long, hits long"), "signatures")
    marks = seen.filter("n is not null").select("doc_id", "n", "d1", "d2")
    total, rows = marks.agg(F.sum("n"), F.count(F.lit(1))).first()
    buckets = max(12, (total or 0) // BUCKET + 1)
    often = seen.filter("key is not null").groupBy("key").agg(F.sum("hits").alias("hits")).filter(F.col("hits") >= max(HEAVY, rows // HEAVY))
    heavy = np.sort(np.array([r["key"] for r in often.orderBy(F.desc("hits"), "key").limit(HEAVY_MOST).collect()], np.int64).view(np.uint64))
    # Equal sets are one class; only its smallest document goes on.
    classes = marks.filter("n > 0 and doc_id is not null").groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("k"))
    classes = cut(classes, "classes")
    copies = marks.join(classes.filter("k > 1").drop("k"), ["d1", "d2", "n"]).filter("doc_id <> rep").select("doc_id").distinct()
    own = sized_join(docs, cut(copies, "copies"), "doc_id", "left_anti")
    blobs = textkernel.mapped(own, _shred(n, buckets, heavy), "bucket long, heavy boolean, ids binary, ns binary, counts binary, keys binary")
    shared = blobs.groupBy("bucket").applyInPandas(_shared(buckets), "grp long, ids binary, ns binary, counts binary, keys binary, dfs binary")
    sets = shared.groupBy("grp").applyInPandas(_regions(pct), "doc_id long, n long, had long, central long, keys binary, pivots array<long>")
    sets = cut(sets, "sets")
    roots = _roots(sets, pct)
    # Only sets that several rows have, or that have a partner, say anything; written, so that Spark can split the join.
    named = classes.join(roots.withColumnRenamed("node", "rep"), "rep", "left").filter("k > 1 or root <> rep")
    named = cut(named.select("d1", "d2", "n", F.coalesce("root", "rep").alias("root")), "named")
    out = marks.join(named, ["d1", "d2", "n"], "left")
    own = F.when((F.col("n") == 0) | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.coalesce("root", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", pct: int = 75) -> DataFrame:
    """``docs`` with one document of each component: that of the smallest id, once if its row repeats. Rows without an id
    stay."""
    found = cut(jaccard_components(docs, text, doc_id, pct=pct).select("doc_id", "component_id"), "found")
    gone = cut(found.filter("component_id <> doc_id").select(F.col("doc_id").alias(doc_id)).distinct(), "gone")
    left = sized_join(docs, gone, doc_id, "left_anti")
    if found.filter("component_id = doc_id").groupBy("doc_id").count().filter("count > 1").limit(1).count():
        left = left.filter(F.col(doc_id).isNotNull()).dropDuplicates([doc_id]).unionByName(left.filter(F.col(doc_id).isNull()))
    return left.select(*docs.columns)
