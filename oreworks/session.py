"""Session setup."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Times are compared as instants everywhere, so UTC is the display zone too. Adaptive
# execution is on by default; it narrows shuffles but does not widen them, so the
# cluster's spark.sql.shuffle.partitions should fit its largest input.
DEFAULTS = {"spark.sql.session.timeZone": "UTC"}

ICEBERG = {
    "spark.sql.extensions": "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions",
    "spark.sql.catalog.spark_catalog": "org.apache.iceberg.spark.SparkSessionCatalog",
    "spark.sql.catalog.spark_catalog.type": "hive",
}


def get_spark(app_name: str, conf: dict[str, str] | None = None, iceberg: bool = False) -> SparkSession:
    """A session with the defaults above; ``conf`` wins over them.

    ``iceberg=True`` adds the Iceberg catalog and Hive support and needs the
    Iceberg runtime on the class path.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **(ICEBERG if iceberg else {}), **(conf or {})}.items():
        builder = builder.config(key, value)
    return (builder.enableHiveSupport() if iceberg else builder).getOrCreate()
