"""The registered queries of this package, with the parameters of production."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from oreworks import scratch
from oreworks.llm import alignment, licenses, minhash, mixing, neighbours, periods, pieces, quality, recurrent, samples, simhash, texts, toxicity, urls, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    texts.small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = quality.fit(documents, table(spark, sf_dir, "labels"))
    scored = quality.score(documents, model)
    return scored.select("doc_id", samples.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    taken = F.col("copies") * F.col("size") + F.col("part")
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "copies", "part")


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", licenses.scan(F.col("text")).alias("found")).select("doc_id", "found.*")


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.fingerprints(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, tokens, n_tokens, decoded_sha256 (of the decoded text), and whether that is the text."""
    documents = table(spark, sf_dir, "documents")
    coded = documents.select("doc_id", "text", pieces.encode(F.col("text")).alias("tokens"))
    decoded = coded.select("doc_id", "text", "tokens", pieces.decode(F.col("tokens")).alias("decoded"))
    blank = F.regexp_replace(F.coalesce("text", F.lit("")), pieces.MARK, " ")
    return decoded.select(
        "doc_id", "tokens", F.size("tokens").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"), (F.col("decoded") == blank).alias("restored")
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, table(spark, sf_dir, "labels"))
    scored = toxicity.score(documents, model)
    return scored.select("doc_id", samples.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write(table(spark, sf_dir, "pages"), scratch.new_path(spark, "warc"))
    found = warc.read(files, payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def op11_recurrent(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return recurrent.fit(documents).score(documents)


def _sha256(strings: pa.Array) -> pa.Array:
    return pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in strings], pa.string())


def _with_planted_runs(rows: pa.RecordBatch) -> pa.Array:
    """The words of every tenth text, by its id, repeat from some place on."""
    given = rows.column("text")
    made = {}
    for i, doc_id in enumerate(rows.column("doc_id").to_pylist()):
        h = -1 if doc_id is None else zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and h >= 0:
            words, _ = texts.white_words(*texts.utf8(given.slice(i, 1)))
            n, g = len(words), h // 10
            if n:
                a = g % n
                place = np.arange(n)
                place[a:] = a + (place[a:] - a) % (1 + (n - a) // (3 + g % 8))
                made[i] = b" ".join(words.take(pa.array(place)).to_pylist()).decode()
    if not made:
        return given
    planted = pa.array([made.get(i) for i in range(len(given))], given.type)
    return pc.if_else(planted.is_valid(), planted, given)


def op12_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    ratio = lambda x, y: x["length"] * y["period"] - y["length"] * x["period"]
    # Runs come by start, then period, so the first of equal ones stays.
    best = F.reduce(F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))), F.get("runs", F.lit(0)), lambda x, y: F.when(ratio(y, x) > 0, y).otherwise(x))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return periods.scan(documents, prepare=_with_planted_runs, kept=_sha256).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best.alias("best"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.col("collapsed").alias("collapsed_sha256"),
    ).select(
        "doc_id",
        "n_runs",
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    def digests(groups: pa.Array) -> pa.Array:
        return pc.if_else(pc.equal(groups, ""), "", _sha256(groups))

    aligned = alignment.align(table(spark, sf_dir, "documents"), kept=digests)
    return aligned.withColumnRenamed("groups", "groups_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality, op2_neighbours, op3_urls, op4_mixing, op5_licenses,
        op6_minhash, op7_simhash, op8_pieces, op9_toxicity, op10_warc,
        op11_recurrent, op12_periods, op13_alignment,
    )
}

# What has no entry has no SQL: fits, signatures, seeded draws and automata are tested against brute force.
ORACLES: dict[str, str] = {
    "op10_warc": """
        WITH payloads AS (
            SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
        ), bits AS (
            SELECT *, list_transform(range(0, 32), lambda i: CAST((CAST(concat('0x', substr(hex, CAST(i // 4 * 5 + 1 AS INTEGER), 5)) AS BIGINT)
                >> CAST(15 - i % 4 * 5 AS INTEGER)) & 31 AS INTEGER)) AS fives,
                min(page_id) OVER (PARTITION BY payload) AS first
            FROM payloads
        )
        SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
            array_to_string(list_transform(fives, lambda v: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', v + 1, 1)), '') AS payload_digest,
            CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to, true AS intact
        FROM bits
    """,
}
