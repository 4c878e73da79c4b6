"""Keys that no earlier batch of a table may hold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from oreworks.operators import rules
from oreworks.operators.checks import CheckResult
from oreworks.sinks import derived, tables


def hashes_of(table: str, columns: Sequence[str]) -> str:
    """The table that keeps the hashes of a key, batch by batch."""
    return f"{table}_keys_{'_'.join(columns)}"


def known_hashes(spark: SparkSession, table: str, columns: Sequence[str], fmt: str = "parquet", but: Sequence[str] = ()) -> DataFrame:
    """``h``, 8 bytes for each row of every batch, and its batch. Batches whose hashes are not kept yet are read for them."""
    hashed = lambda df: df.select(rules.key_hash(columns).alias("h"))
    return derived.in_step(spark, table, hashes_of(table, columns), hashed, fmt, but)


def check_new_keys(batch: DataFrame, table: str, columns: Sequence[str], name: str, rows: int | None = None, fmt: str = "parquet") -> CheckResult:
    """Rows of ``batch``, which is to become the batch ``name`` of ``table``, whose key another batch holds. NULL is a key like any other.

    Reads the hashes that are kept of all batches, against those of the new one, which are broadcast if they are few
    (``rows`` says so). Where hashes meet, and only there, the keys themselves are read from the batches concerned.
    """
    spark = batch.sparkSession
    keys = batch.select(*columns, rules.key_hash(columns).alias("h"))
    new = keys.select("h")
    if rows is not None and rows <= rules.BROADCAST_HASHES:
        new = F.broadcast(new)
    known = known_hashes(spark, table, columns, fmt, [name])
    met = known.join(new, "h", "left_semi").groupBy(tables.INGEST_BATCH).count().collect()
    repeated = 0
    if met:
        # A row per batch is on the driver, as in the list of the table's partitions.
        held = spark.table(tables.named(table)).where(F.col(tables.INGEST_BATCH).isin([row[tables.INGEST_BATCH] for row in met]))
        held = held.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(columns)], rules.key_hash(columns).alias("held_h"))
        same = [F.col(c).eqNullSafe(F.col(f"k{i}")) for i, c in enumerate(columns)]
        repeated = keys.join(held, [F.col("h") == F.col("held_h"), *same], "left_semi").count()
    return CheckResult("pk_new_" + "_".join(columns), not repeated, f"repeated={repeated}")
