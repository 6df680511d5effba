"""The queries of this subpackage, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm import decontam, html_extract, jaccard_join, langid, license_scan, line_dedup, mixing, oracles, pii, quality, url_filter


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(_table(spark, sf_dir, "pages"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return decontam.digest(decontam.match(docs.select("doc_id", "text"), items))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    net = langid.train(docs.filter(~langid.held_out()))
    told = langid.identify(docs, net).withColumn("held_out", langid.held_out())
    return told.select("doc_id", "held_out", "lang_pred", "score")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.license_scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "license_id", "dice", "n_license_lines")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", "source", "n_lines", "n_dropped", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_kept_chars"), F.sha2("text", 256).alias("text_sha256"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(_table(spark, sf_dir, "documents").select("doc_id", "text")))


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Which rule rejects first depends on measured costs; whether any does, not.
    return quality.quality_cascade(_table(spark, sf_dir, "documents")).drop("rejected_by")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_url_filter, op2_decontaminate, op3_language_id, op4_license_scan, op5_line_dedup, op6_jaccard_join, op7_pii, op8_html_extract, op9_mix, op10_quality)}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
