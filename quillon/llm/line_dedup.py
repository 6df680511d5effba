"""Boilerplate line removal by site-relative frequency, in DataFrame functions only.

A line is boilerplate on a site when the share of the site's pages that contain it exceeds ``ratio_pct`` percent (and at
least ``min_pages`` pages contain it). One line can exceed the ratio on a site only if the site's pages hold enough lines,
so a site has at most ``100 / ratio_pct`` times its mean number of lines per page of them, whatever its number of pages.

Scale: lines are hashed and counted with map-side partial sums (a hot site is spread over its lines' keys); the surviving
line set is measured and broadcast, or joined over salted keys when it is too large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.url_filter import host_and_path
from quillon.plans.lineage import BROADCAST_BYTES, cut, measured_bytes

#: Anything but ASCII white space.
WORD_CHAR = r"[^\x20\x09-\x0D]"
SALTS = 32
#: The share of a site's pages beyond which a line is boilerplate, in per cent: well above what lines come to by chance (README).
RATIO_PCT = 7


def _site(site: str) -> Column:
    return F.coalesce(F.concat(F.lit("s"), F.col(site).cast("string")), F.lit("n"))


def boilerplate_lines(docs: DataFrame, text: str, site: str, ratio_pct: int, min_pages: int) -> DataFrame:
    """``(_site, _lines)``: the hashes of the lines that exceed the ratio on each site."""
    lines = F.filter(F.split(F.col(text), "\n"), lambda x: x.rlike(WORD_CHAR))
    per_page = docs.select(_site(site).alias("_site"), F.explode(F.array_distinct(F.transform(lines, lambda x: F.xxhash64(x)))).alias("_line"))
    counts = per_page.groupBy("_site", "_line").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_pages)
    totals = docs.select(_site(site).alias("_site")).groupBy("_site").agg(F.count(F.lit(1)).alias("_pages"))
    over = counts.join(totals, "_site").filter(F.col("_n") * 100 > F.col("_pages") * ratio_pct)
    return over.groupBy("_site").agg(F.collect_set("_line").alias("_lines"))


def line_dedup(docs: DataFrame, text: str = "text", site: str = "source", ratio_pct: int = RATIO_PCT, min_pages: int = 5) -> DataFrame:
    """``docs`` with its boilerplate lines deleted from ``text``; adds ``n_lines`` and ``n_dropped`` (long).

    Null text stays null with no lines; blank lines are never boilerplate; a page counts once for a line that it repeats,
    but loses every repetition; pages without a site form one site of their own; repeated rows count as pages each; a line
    exactly at the ratio stays. Texts of any length are read whole. An empty table gives an empty one. Columns that are called
    ``n_lines`` or ``n_dropped`` already are replaced.
    """
    found = cut(boilerplate_lines(docs, text, site, ratio_pct, min_pages), "boilerplate")
    docs = docs.drop("n_lines", "n_dropped").withColumn("_site", _site(site))
    if measured_bytes(found, "_lines") <= BROADCAST_BYTES:
        joined = docs.join(F.broadcast(found), "_site", "left")
    else:
        salted = found.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = docs.withColumn("_salt", F.pmod(F.xxhash64(text), F.lit(SALTS)).cast("int")).withColumn("_salt", F.coalesce("_salt", F.lit(0))).join(salted, ["_site", "_salt"], "left").drop("_salt")
    kept = F.filter(F.split(F.col(text), "\n"), lambda x: ~F.array_contains(F.col("_lines"), F.xxhash64(x)))
    before = F.coalesce(F.size(F.split(F.col(text), "\n")), F.lit(0)).cast("long")
    out = joined.withColumn("_kept", F.when(F.col("_lines").isNotNull(), kept)).withColumn("n_lines", F.when(F.col(text).isNull(), F.lit(0).cast("long")).otherwise(before))
    out = out.withColumn("n_dropped", F.when(F.col("_kept").isNotNull(), F.col("n_lines") - F.size("_kept")).otherwise(F.lit(0)).cast("long"))
    # A page may lose all its lines: the join of none is the empty text.
    return out.withColumn(text, F.when(F.col("_kept").isNotNull(), F.array_join("_kept", "\n")).otherwise(F.col(text))).drop("_kept", "_lines", "_site")


def dedup_by_host(pages: DataFrame, url: str = "url", text: str = "text", **more) -> DataFrame:
    """``line_dedup`` of web pages' texts, the site being the host of the URL (lower case; null and URLs without one are one site)."""
    host, _ = host_and_path(F.col(url))
    return line_dedup(pages.withColumn("_host", host), text, "_host", **more).drop("_host")
