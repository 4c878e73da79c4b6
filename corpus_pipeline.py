"""The corpus pipeline: documents in, token ids out, each stage one operator of ``oreworks.llm``.

A stage takes the rows its predecessor kept, written as Parquet and read again, and returns the
columns of documents; the last one returns token ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from oreworks import scratch
from oreworks.llm import mixing, pieces, quality, simhash, texts, toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; learned from the labelled ones among them."""
    texts.small_batches(spark)
    model = toxicity.fit(docs, _labels(spark, sf_dir))
    return docs.select(*COLUMNS).where(model.score(F.col("text")) < 0.5)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more; learned from the labelled ones among them."""
    texts.small_batches(spark)
    model = quality.fit(docs, _labels(spark, sf_dir))
    return docs.select(*COLUMNS).where(model.score(F.col("text")) >= 0.3)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the smallest doc_id."""
    texts.small_batches(spark)
    return simhash.keep_one(docs.select(*COLUMNS))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy of a document that the mix takes."""
    texts.small_batches(spark)
    return mixing.repeated(docs.select(*COLUMNS))


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, tokens (piece ids), n_tokens, and whether decoding gives the text back."""
    texts.small_batches(spark)
    coded = docs.select("doc_id", "source", "text", pieces.encode(F.col("text")).alias("tokens"))
    blank = F.regexp_replace(F.coalesce("text", F.lit("")), pieces.MARK, " ")
    same = pieces.decode(F.col("tokens")) == blank
    return coded.select("doc_id", "source", "tokens", F.size("tokens").alias("n_tokens"), same.alias("restored"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("quality", quality_stage),
    ("dedup", dedup_stage),
    ("mixing", mixing_stage),
    ("tokens", tokens_stage),
]

# Classifiers, fingerprints and draws have no SQL; tests hold what the stages keep against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in their order. What a stage was given is removed when what it keeps is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = scratch.new_path(spark, f"pipeline-{name}")
        docs = scratch.stage(stage(spark, docs, sf_dir), path)
        if before:
            scratch.discard(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
