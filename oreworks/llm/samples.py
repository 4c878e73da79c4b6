"""Bounded samples of labelled documents to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; 0 marks what is held out of every fit."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def held_out(doc_id: Column) -> Column:
    """Whether a document is held out. A null id has no remainder and is held out."""
    return F.coalesce(remainder(doc_id) == 0, F.lit(True))


def labelled(documents: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """``text`` and ``label`` (int 0 or 1) of at most ``limit`` labelled documents outside the held-out fold.

    Which ones is settled by a hash of the id, so reruns agree. A document labelled more
    than once counts once, as 1 if any label says so. The broadcast side has at most
    ``limit`` rows of two numbers.
    """
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )
    return documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label")
