"""File sources.

Schema inference reads the whole input once before the query does. Give a
schema for anything large.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

Schema = StructType | str | None
UNREADABLE = "_corrupt_record"


def csv(spark: SparkSession, path: str, schema: Schema = None, **options) -> DataFrame:
    """CSV with a header line. A given schema must name the header's columns in
    the header's order; files that differ are refused, not read by position."""
    reader = spark.read.option("header", True)
    if schema is None:
        reader = reader.option("inferSchema", True)
    else:
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.options(**options).csv(path)


def json(spark: SparkSession, path: str, schema: Schema = None, **options) -> DataFrame:
    """JSON lines. A line that does not parse becomes a row of NULLs, with its
    text in ``_corrupt_record`` where the schema has that column."""
    reader = spark.read.option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**options).json(path)


def with_unreadable(read: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``read`` (csv or json) with the text of lines that do not parse in a last column,
    ``_corrupt_record``, whether or not the schema is given and any line is unreadable."""

    def reading(spark: SparkSession, path: str, schema: Schema = None, **options) -> DataFrame:
        if schema is None:
            schema = read(spark, path, None, **options).schema
        fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        kept = [field for field in fields if field.name != UNREADABLE]
        return read(spark, path, StructType([*kept, StructField(UNREADABLE, StringType())]), **options)

    return reading


def parquet(spark: SparkSession, path: str, schema: Schema = None, **options) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.options(**options).parquet(path)
