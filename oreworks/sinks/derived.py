"""Rows derived from every batch of a table of batches, kept in step with it.

Partial sums and hashes of keys are such rows. They are written once for each batch, in a partition named after the batch and the
version of its files, so that a batch that is written again is derived again, and one that is gone takes its rows along.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from oreworks.sinks import tables

VERSION = "batch_version"
_FILE = re.compile(rf"/{tables.INGEST_BATCH}=([^/]+)/([^/]+)/(?:{tables.READABLE}=true/)?[^/]+$")
_PARTITION = re.compile(rf"{tables.INGEST_BATCH}=([^/]*)/{VERSION}=([^/]*)$")


def batches(spark: SparkSession, table: str) -> dict[str, str]:
    """The batches of a table, and which version of each it holds: the folder its files are in. Read from
    the list of files that any scan of the table is planned from, without a job."""
    found = {}
    for path in spark.table(tables.named(table)).inputFiles():
        match = _FILE.search(path)
        if not match:
            raise ValueError(f"{path} is in no batch of {table}")
        # The list is of paths as URIs, in which the folder's own escapes are escaped.
        found[unquote(unquote(match[1]))] = match[2]
    return found


def in_step(
    spark: SparkSession, source: str, name: str, derive: Callable[[DataFrame], DataFrame], fmt: str = "parquet", but: Iterable[str] = ()
) -> DataFrame:
    """The rows of ``derive`` over each batch of ``source`` but some, with the batch they are of, kept in the table ``name``. Only batches
    whose rows are not there are read. Derived rows are complete or absent: a run that dies leaves nothing to mend."""
    current = {batch: version for batch, version in batches(spark, source).items() if batch not in set(but)}
    rows = spark.table(tables.named(source))
    marks = {tables.INGEST_BATCH: F.lit(""), VERSION: F.lit("")}
    schema = derive(rows.drop(tables.INGEST_BATCH)).withColumns(marks).schema
    tables.create_partitioned(spark, name, schema, marks, fmt)
    held = dict(
        tuple(map(unquote, _PARTITION.search(row.partition).groups())) for row in spark.sql(f"SHOW PARTITIONS {tables.named(name)}").collect()
    )
    for batch, version in sorted(current.items()):
        if held.get(batch) != version:
            one = rows.where(F.col(tables.INGEST_BATCH) == batch).drop(tables.INGEST_BATCH)
            tables.add_partition(derive(one), name, {tables.INGEST_BATCH: batch, VERSION: version})
    stale = []
    for batch, version in held.items():
        if batch not in but and current.get(batch) != version:
            stale.append({tables.INGEST_BATCH: batch, VERSION: version})
    tables.drop_partitions(spark, name, stale)
    found = spark.table(tables.named(name)).drop(VERSION)
    return found.where(~F.col(tables.INGEST_BATCH).isin(*but)) if but else found
