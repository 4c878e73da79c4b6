"""The test tables in the shapes the jobs expect, and folders to write into."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from oreworks import scratch
from oreworks.sources import files

# Timestamps without zone to the microsecond; the default keeps milliseconds.
MICROS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
AS_OF = dt.datetime(2024, 1, 31)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return files.parquet(spark, f"{sf_dir}/{name}.parquet")


def production(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_suppkey").alias("plant_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_shipdate").alias("prod_dt"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("account_id"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("event_time"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events")


def untyped_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of which the erroneous ones have lost their type."""
    return events(spark, sf_dir).withColumn("event_type", F.nullif("event_type", F.lit("error")))


def graded_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, with its label where it has one."""
    documents = load(spark, sf_dir, "documents").select("doc_id", "lang")
    return documents.join(load(spark, sf_dir, "labels"), "doc_id", "left")


def as_json(df: DataFrame) -> str:
    path = scratch.new_path(df.sparkSession, "json")
    df.write.options(**MICROS).json(path)
    return path


def as_csv(df: DataFrame) -> str:
    path = scratch.new_path(df.sparkSession, "csv")
    df.write.options(header=True, **MICROS).csv(path)
    return path


def as_text(lines: DataFrame) -> str:
    path = scratch.new_path(lines.sparkSession, "text")
    lines.write.text(path)
    return path


def new_schema(spark: SparkSession) -> str:
    """A catalog schema of its own, with its tables in the shared folder."""
    name = f"oreworks_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{scratch.new_path(spark, 'schema')}'")
    return name
