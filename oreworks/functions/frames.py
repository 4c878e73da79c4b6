"""Small frames of values that are known when the plan is made, and names in plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def constant_rows(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """Rows as literals in the plan: one partition, and nothing to ship from Python."""
    schema = StructType.fromDDL(ddl)
    if not rows:
        return spark.createDataFrame([], schema)
    structs = [
        F.struct(*[F.lit(value).cast(f.dataType).alias(f.name) for value, f in zip(row, schema, strict=True)])
        for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


def quoted(name: str) -> str:
    """A column name taken literally, dots and backticks included."""
    return "`" + name.replace("`", "``") + "`"
