"""Benchmark decontamination with a distributed positional inverted index; DataFrame functions only.

1. Count in the training corpus every term that a test item uses (map-side partial counts; a broadcast probe).
2. Each window of a test item names its two rarest terms, and each item its rarest one. Postings ``(term, document,
   position)`` of those are stored as a table: the lists of all other terms would never be read. A window with a term that the
   corpus lacks can't occur.
3. Offset-adjusted lists meet on (document, item, diagonal), diagonal being document position less item position: a
   document keeps a diagonal on which two anchors of a window agree. Around the postings of an item's rarest term, all its
   other terms may stand nearby.
4. Both are verified against the document's and the item's words: exact phrase matches, and proximity matches.

Scale: tokens are never shuffled, except as term counts; postings of rare terms, then a few diagonals are. The test set's
vocabulary and anchors are broadcast only after measuring them; beyond the limit, the same joins shuffle by term, a term that
is common salted over as many groups as its postings need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.plans import lineage
from quillon.plans.lineage import cut, sized_join

#: Runs of what ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` accepts, written as ranges: the regex engine runs this form several times faster.
WORD = r"[0-9a-z\x{80}-\x{10FFFF}]++"
#: Different words that an item needs for proximity matches, as few words stand near each other anywhere; words beyond its length
#: that they may spread over; postings of one salt.
NEAR_LEAST, NEAR_SLOP, SPAN = 5, 5, 1 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, nothing else changed; ``lower`` is faster and the same for ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.coalesce(F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def _texts(items: DataFrame, item_id: str, item_text: str) -> DataFrame:
    """One row per distinct word list of the test items: ``tid, iw, ids``."""
    named = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), words_of(F.col(item_text)).alias("iw")).filter(F.size("iw") > 0)
    return named.groupBy("iw").agg(F.collect_set("item").alias("ids")).select(F.xxhash64("iw").alias("tid"), "iw", "ids")


def _frequency(tokens: DataFrame, texts: DataFrame) -> DataFrame:
    """``term, df``: how often the corpus has each term of the test items; terms that it lacks have no row."""
    vocabulary = cut(texts.select(F.explode("iw").alias("term")).distinct(), "vocabulary")
    every = F.count(F.lit(1)).alias("df")
    # A vocabulary beyond a broadcast meets the corpus's counts, so that no token is shuffled by itself.
    if lineage.measured_bytes(vocabulary, "term") <= lineage.BROADCAST_BYTES:
        return cut(tokens.select("term").join(F.broadcast(vocabulary), "term").groupBy("term").agg(every), "frequency")
    return cut(tokens.groupBy("term").agg(every).join(vocabulary, "term"), "frequency")


def _anchors(frequency: DataFrame, texts: DataFrame, window: int) -> DataFrame:
    """``term, tid, p, alone``: the two rarest terms of each window; alone if the window is a single word."""
    starts = F.sequence(F.lit(0), F.greatest(F.size("iw") - window, F.lit(0)))
    windows = texts.select("tid", "iw", F.explode(starts).alias("k")).select("tid", "k", F.posexplode(F.slice("iw", F.col("k") + 1, window)).alias("j", "term"))
    # The inner join keeps frequent terms; a window that is not whole afterwards has a term that the corpus lacks.
    size = windows.groupBy("tid", "k").agg(F.count(F.lit(1)).alias("size"))
    ranked = windows.join(frequency, "term").groupBy("tid", "k").agg(F.array_sort(F.collect_list(F.struct("df", "term", (F.col("k") + F.col("j")).alias("p")))).alias("terms"))
    picked = ranked.join(size, ["tid", "k"]).filter(F.size("terms") == F.col("size")).select("tid", (F.col("size") == 1).alias("alone"), F.explode(F.slice("terms", 1, 2)).alias("t"))
    return picked.select(F.col("t.term").alias("term"), "tid", F.col("t.p").alias("p"), "alone").distinct()


def _rarest(frequency: DataFrame, texts: DataFrame, least: int) -> DataFrame:
    """``term, tid`` of the rarest term of each item with ``least`` different terms, all of which the corpus has."""
    terms = texts.filter(F.size(F.array_distinct("iw")) >= least).select("tid", F.explode(F.array_distinct("iw")).alias("term"))
    rare = terms.join(frequency, "term", "left").groupBy("tid").agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "term")).alias("t"))
    return rare.filter("t.df > 0").select(F.col("t.term").alias("term"), "tid")


def _postings(tokens: DataFrame, terms: DataFrame, frequency: DataFrame) -> DataFrame:
    """The stored index: ``term, _id, _h, _pos, _salt`` of the given terms. A term has a salt for every SPAN of its postings."""
    wanted = cut(terms.distinct().join(frequency, "term").select("term", F.floor(F.col("df") / SPAN).cast("int").alias("_salts")), "terms")
    found = sized_join(tokens, wanted, "term", "inner", "term")
    return cut(found.select("term", "_id", "_h", "_pos", F.pmod(F.xxhash64("_id", "_h"), F.col("_salts") + 1).cast("int").alias("_salt")), "postings")


def _salted(anchors: DataFrame, frequency: DataFrame) -> DataFrame:
    """Anchors once for each salt of their term."""
    return anchors.join(frequency, "term").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.floor(F.col("df") / SPAN).cast("int")))).drop("df")


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.withColumns({"_id": F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "_no_id": F.col(doc_id).isNull(), "_h": F.xxhash64(text)})


def match(docs: DataFrame, items: DataFrame, window: int = 10, slop: int | None = NEAR_SLOP, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``hits`` (sorted word positions inside phrase matches), ``hit_items`` (sorted item ids as text)
    and ``near_items`` (those of proximity matches, which phrase matches of whole items are among; none if ``slop`` is None).

    A phrase match is ``window`` consecutive words of an item, or all words of an item that has fewer. A proximity match is all
    different words of an item, at least NEAR_LEAST, within its length plus ``slop`` words of the document, in any order: an item
    with words put in, or moved. Null texts have no words; items without words match nothing; items of one id count once, and
    null ids as an empty one; documents are told apart by id and text, so repeated rows get equal results and documents that
    share an id don't mix. Texts of any length are read whole. An empty table, or an empty benchmark, gives no match. Columns
    that are called like the results, or with a leading underscore, are replaced.
    """
    docs = docs.drop("n_words", "hits", "hit_items", "near_items")
    texts = cut(_texts(items, item_id, item_text), "items")
    tokens = docs.select(F.col(doc_id).cast("string").alias("_id"), F.xxhash64(text).alias("_h"), F.posexplode(words_of(F.col(text))).alias("_pos", "term"))
    frequency = _frequency(tokens, texts)
    anchors = cut(_anchors(frequency, texts, window), "anchors")
    rarest = cut(_rarest(frequency, texts, NEAR_LEAST) if slop is not None else anchors.select("term", "tid").limit(0), "rarest")
    postings = _postings(tokens, anchors.select("term").unionByName(rarest.select("term")), frequency)
    met = sized_join(postings, cut(_salted(anchors, frequency), "salted"), ["term", "_salt"], "inner", "term")
    diagonals = met.groupBy("_id", "_h", "tid", (F.col("_pos") - F.col("p")).alias("d")).agg(F.collect_set("p").alias("ps"), F.max("alone").alias("alone")).filter((F.size("ps") > 1) | F.col("alone"))
    kinds = F.struct("tid", "d", F.lit(False).alias("near"))
    near = sized_join(postings, cut(_salted(rarest, frequency), "salted"), ["term", "_salt"], "inner", "term").select("_id", "_h", F.struct("tid", F.col("_pos").alias("d"), F.lit(True).alias("near")).alias("c"))
    found = cut(diagonals.select("_id", "_h", kinds.alias("c")).unionByName(near), "diagonals")
    # A document's candidates name their item by number; the items' words are looked up where they are compared.
    found = found.groupBy("_id", "_h", "c.tid", "c.near").agg(F.collect_list("c.d").alias("ds"))
    found = sized_join(found, texts, "tid", "inner", "iw", "ids").groupBy("_id", "_h").agg(F.collect_list(F.struct("near", "ds", "iw", "ids")).alias("_found"))
    found = cut(found.select(F.coalesce("_id", F.lit("")).alias("_id"), F.col("_id").isNull().alias("_no_id"), "_h", "_found"), "candidates")
    joined = sized_join(_keyed(docs, doc_id, text), found, ["_id", "_no_id", "_h"], "left", "_id", "_found").drop("_id", "_no_id", "_h")
    words = F.col("_words")

    def hits(c: Column, d: Column) -> Column:
        """The positions of a diagonal that phrase matches cover."""
        size = F.size(c["iw"])
        length = F.least(size, F.lit(window))
        same = F.transform(c["iw"], lambda w, i: F.coalesce(F.get(words, i + d) == w, F.lit(False)))
        whole = lambda eq: F.filter(F.sequence(F.lit(0), size - length), lambda k: F.forall(F.slice(eq, k + 1, length), lambda x: x))
        return F.flatten(F.transform(F.transform(F.array(same), whole)[0], lambda k: F.sequence(k + d, k + d + length - 1)))

    def is_near(c: Column, p: Column) -> Column:
        """Whether a stretch that covers p has all the item's words; first, whether what such stretches cover has."""
        span, all_ = F.size(c["iw"]) + (slop or 0), F.array_distinct(c["iw"])
        first = F.greatest(p - span + 1, F.lit(0))
        around = F.slice(words, first + 1, p - first + span)
        some = F.exists(F.sequence(first, p), lambda o: F.size(F.array_except(all_, F.slice(words, o + 1, span))) == 0)
        return F.when(F.size(F.array_except(all_, around)) == 0, some).otherwise(F.lit(False))

    told = joined.withColumn("_words", words_of(F.col(text)))
    phrases = F.transform(F.filter("_found", lambda c: ~c["near"]), lambda c: F.struct(F.flatten(F.transform(c["ds"], lambda d: hits(c, d))).alias("hits"), c["ids"].alias("ids")))
    near_ones = F.filter(F.col("_found"), lambda c: c["near"] & F.exists(c["ds"], lambda p: is_near(c, p)))
    some = F.col("_found").isNotNull()
    told = told.withColumns({"n_words": F.size("_words").cast("long"), "_at": F.when(some, F.filter(phrases, lambda x: F.size(x["hits"]) > 0)), "_near": F.when(some, near_ones)})
    flat = lambda field, kind: F.coalesce(F.array_sort(F.array_distinct(F.flatten(F.col(field)))), F.array().cast(kind))
    return told.withColumns({"hits": flat("_at.hits", "array<int>"), "hit_items": flat("_at.ids", "array<string>"), "near_items": flat("_near.ids", "array<string>")}).drop("_words", "_found", "_at", "_near")


def match_phrases(docs: DataFrame, items: DataFrame, **more) -> DataFrame:
    """``match`` without proximity matches."""
    return match(docs, items, slop=None, **more).drop("near_items")


def digest(matched: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document: words, hit words, items, the hash of their ids, and whether there is a hit; and, where proximity was
    asked, the items that stand nearby in whole."""
    near = [F.size("near_items").cast("long").alias("n_near_items"), F.array_join("near_items", ",").alias("near_items")] if "near_items" in matched.columns else []
    return matched.select(id_col, "n_words", F.size("hits").cast("long").alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"), F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"), *near)
