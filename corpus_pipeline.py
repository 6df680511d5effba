"""A training corpus from ``documents``: language ID, line dedup, near duplicates, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet in the shared folder and reads
it again as the next one's documents, so that a lost executor costs one stage at most.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm import decontam, jaccard_join, langid, line_dedup, mixing
from quillon.plans import lineage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def own_columns(*results: str, adds: tuple[str, ...] = ()) -> Callable[[Stage], Stage]:
    """A stage that returns its documents' columns, whatever they are called, and those that it ``adds``, which replace some
    of the same name. Columns with names of the operator's results are set aside under others meanwhile."""

    def of(stage: Stage) -> Stage:
        @functools.wraps(stage)
        def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            own = [c for c in docs.columns if c.lower() not in adds]
            aside = {c: f"own_{k}_" for k, c in enumerate(own) if c.lower() in results or not c.isidentifier() or c.startswith("_")}
            out = stage(spark, docs.select(*[F.col(f"`{c}`") for c in own]).withColumnsRenamed(aside), sf_dir)
            return out.select(*[F.col(aside.get(c, c)).alias(c) for c in own], *adds)

        return run

    return of


@own_columns("lang_pred", "score")
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents without a language: null and empty texts, and those without a letter.

    Repeated rows are judged alike; the score decides nothing, so ties can't matter; without a labelled text nothing has a
    language. An empty table stays empty.
    """
    net = langid.train(docs.filter(~langid.held_out()))
    told = langid.identify(docs, net, keep=tuple(docs.columns))
    return told.filter(F.col("lang_pred") != langid.UNKNOWN)


@own_columns("n_lines", "n_dropped")
def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes boilerplate lines, and the documents that had nothing else; sets ``n_chars`` anew, where there is one.

    Null and empty texts have no lines and stay as they are; repeated rows count as pages each, and lose the same lines; a
    null source is a site of its own. An empty table stays empty.
    """
    out = line_dedup.line_dedup(docs).filter((F.col("n_dropped") == 0) | F.col("text").rlike(line_dedup.WORD_CHAR))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


@own_columns()
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: that of the smallest id, once if its row repeats.

    Null and empty texts are copies of nothing, not even of each other, and stay; so do rows without an id.
    """
    return jaccard_join.drop_near_duplicates(docs)


@own_columns("n_words", "hits", "hit_items")
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold ten consecutive words of a benchmark item, or all words of a shorter one.

    Null and empty texts, and any text if the benchmark is empty, hold nothing and stay; repeated rows are judged alike.
    """
    found = decontam.match_phrases(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.filter(F.size("hits") == 0)


@own_columns("source_size", "target", adds=("size", "copies", "taken"))
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with ``size``, ``copies`` and ``taken``, which replace columns of these names.

    Null and empty texts have size 0: they go with their source's full passes. Ties go by seeded hash, then id; repeated rows
    are interchangeable. An empty table stays empty.
    """
    return mixing.mix(docs, keep=tuple(docs.columns)).filter("copies > 0")


STAGES = [("language_id", language_id), ("line_dedup", dedup_lines), ("jaccard_join", near_duplicates), ("decontamination", decontaminate), ("mixing", mix_sources)]

#: SQL can't express the first stage; the tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, table = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        before = lineage.written()
        docs = lineage.cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
        # The stage's result is a table now: what the stage wrote on its way, and its input, have no reader left.
        *way, result = lineage.written()[len(before) :]
        lineage.clear(spark, table + way)
        table = [result]
    return docs
