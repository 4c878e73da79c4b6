"""Intermediate tables in the folder all executors share.

The folder is the one named by ``spark.checkpoint.dir``. Only a local master may
go without it, since a temporary folder of one machine is lost with it.
"""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


@functools.lru_cache(maxsize=None)
def _local_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="oreworks-")


def shared_folder(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder(spark.conf.get("spark.app.id"))


def new_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used, under the shared folder."""
    return f"{shared_folder(spark)}/oreworks/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once and read it back, so that later passes neither repeat its
    work nor depend on executors that may be gone, and read only what they need."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
