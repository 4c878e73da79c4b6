"""Catalog sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def table(spark: SparkSession, name: str) -> DataFrame:
    """The table as it is now: a session remembers a table's files, and would miss
    what another application has added since."""
    spark.catalog.refreshTable(name)
    return spark.table(name)


def table_schema(spark: SparkSession, name: str) -> StructType:
    """The schema alone; starts no Spark job."""
    return spark.table(name).schema
