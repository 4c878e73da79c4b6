"""Table sinks: append to a table, or replace its rows.

Both match columns by name and keep the table's own schema. An append casts only
where nothing can be lost; a replacement casts only where the policy allows the type
to differ, and fails on values that do not fit.
"""

from __future__ import annotations

import logging
import re
import threading
import uuid
from collections.abc import Callable, Iterable, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from oreworks.functions.frames import quoted
from oreworks.operators.drift import ADDED, RETYPED, STRICT, Change, EvolutionPolicy, SchemaDrift, SchemaError
from oreworks.scratch import discard, new_path, stage

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
# Formats whose overwrite deletes the old files first, and those among them whose
# files can be read without the table's options.
FILE_FORMATS = {"parquet", "orc", "csv", "json", "text", "avro", "hive"}
SELF_CONTAINED = {"parquet", "orc"}
# The partition column of tables that a stream fills.
INGEST_BATCH = "ingest_batch"
# The table property that names the files before the latest replacement.
KEPT = "oreworks.replaced_location"
_publishing = threading.Lock()
logger = logging.getLogger(__name__)


def named(table: str) -> str:
    """A table's name in SQL, each part taken literally unless it is quoted already."""
    return table if "`" in table else ".".join(map(quoted, table.split(".")))


class ConcurrentReplace(RuntimeError):
    """Somebody else replaced the table since the draft was begun."""


def refused_changes(df: DataFrame, table: str, policy: EvolutionPolicy, safe_casts: bool) -> list[Change]:
    """Schema changes that stand in the way of writing ``df`` to ``table``. With
    ``safe_casts``, types are left to the write, which casts where nothing is lost."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(named(table)):
        return []
    violations = policy.by_column().violations(SchemaDrift(df.schema, spark.table(named(table)).schema))
    return [v for v in violations if not (safe_casts and v.kind == RETYPED)]


def append(df: DataFrame, table: str, fmt: str = "parquet", policy: EvolutionPolicy = STRICT) -> None:
    """Add the rows of ``df``, creating the table if there is none. Appending the
    same input again adds it again."""
    if not df.sparkSession.catalog.tableExists(named(table)):
        create(df, table, fmt)
        return
    rows = _conform(df, table, policy, safe_casts=True)
    _insert(rows, table, _describe(df.sparkSession, table), overwrite=False)


def replace(df: DataFrame, table: str, fmt: str = "parquet", policy: EvolutionPolicy = STRICT) -> None:
    """Replace all rows by those of ``df``, in every partition.

    Spark's own overwrite of a table of files deletes the old ones before it computes
    the new ones. Where a ``Draft`` is possible, the new files are complete before the
    table is pointed at them, so readers find the old rows or the new, and a write
    that fails changes nothing. The old files stay until the next replacement, for
    readers that are half way (``purge`` removes them sooner). Of two replacements at
    the same time the later one to finish raises ``ConcurrentReplace`` and leaves nothing.
    For other tables of files the new rows are staged before Spark's overwrite, which is
    then a mere copy. Table formats with snapshots need no such care.
    """
    spark = df.sparkSession
    written = draft(df, table, fmt, policy)
    if written:
        written.publish()
    elif not spark.catalog.tableExists(named(table)):
        create(df, table, fmt)
    else:
        rows = _conform(df, table, policy, safe_casts=False)
        target = _describe(spark, table)
        if target.provider in FILE_FORMATS:
            with _staged(rows, table, target) as complete:
                _insert(complete, table, target, overwrite=True)
        else:
            _insert(rows, table, target, overwrite=True)


# The aggregates to take of rows while they are written.
Metrics = Callable[[DataFrame], Mapping[str, Column]]


def _observed(rows: DataFrame, metrics: Metrics | None, write: Callable[[DataFrame], None]) -> dict[str, object]:
    """Write the rows and take aggregates of them on the way. The rows are observed right below the write, whose tasks
    count once each however often they are tried."""
    wanted = dict(metrics(rows)) if metrics else {}
    if not wanted:
        write(rows)
        return {}
    observation = Observation()
    write(rows.observe(observation, *[value.alias(f"m{i}") for i, value in enumerate(wanted.values())]))
    found = observation.get
    return {name: found[f"m{i}"] for i, name in enumerate(wanted) if f"m{i}" in found}


@dataclass(frozen=True)
class Draft:
    """New rows of a table, written beside it: to be checked as they are, and then
    published by pointing the table at them, or discarded."""

    rows: DataFrame
    table: str
    provider: str
    location: str
    replaces: Target | None
    added: tuple[Change, ...]
    measured: Mapping[str, object] = field(default_factory=dict)

    def publish(self) -> None:
        """Point the table at the new files. The old ones are kept until the next time; those that
        were kept until now go. On any failure before that, the new files go instead.

        The catalog has no compare-and-set. Within an application a lock stands in for it; two
        applications that publish in the same instant can still leave one unused copy."""
        spark = self.rows.sparkSession
        created = False
        try:
            with _publishing:
                if self.replaces is None:
                    spark.catalog.createTable(named(self.table), source=self.provider, schema=self.rows.schema)
                    created = True
                old = _describe(spark, self.table)
                if self.replaces and old.location != self.replaces.location:
                    raise ConcurrentReplace(f"{self.table} was replaced while its new rows were written")
                _add_columns(spark, self.table, self.added)
                spark.sql(f"ALTER TABLE {named(self.table)} SET LOCATION '{_escaped(self.location)}'")
        except BaseException:
            if created:
                spark.sql(f"DROP TABLE IF EXISTS {named(self.table)}")
            self.discard()
            raise
        # The new rows are the table's from here on: what is left to do may fail without the run failing.
        with _upkeep(self.table, old.location):
            spark.catalog.refreshTable(named(self.table))
            if created:
                discard(spark, old.location)
            else:
                purge(spark, self.table)
                spark.sql(f"ALTER TABLE {named(self.table)} SET TBLPROPERTIES ('{KEPT}' = '{_escaped(old.location)}')")

    def discard(self) -> None:
        discard(self.rows.sparkSession, self.location)


@contextmanager
def _upkeep(table: str, former: str | None):
    """Work after publishing: a failure is logged, with the files it may have left."""
    try:
        yield
    except Exception:
        logger.exception("%s is published; its upkeep failed, and its former files may stay at %s", table, former)


def purge(spark: SparkSession, table: str) -> None:
    """Remove the files of before the latest replacement, as after the last reader or before DROP TABLE."""
    found = spark.sql(f"SHOW TBLPROPERTIES {named(table)}").where(F.col("key") == KEPT).collect()
    if found:
        spark.sql(f"ALTER TABLE {named(table)} UNSET TBLPROPERTIES IF EXISTS ('{KEPT}')")
        discard(spark, found[0]["value"])


def draft(
    df: DataFrame, table: str, fmt: str = "parquet", policy: EvolutionPolicy = STRICT, metrics: Metrics | None = None
) -> Draft | None:
    """Write ``df`` beside the table it is to replace, and take ``metrics`` of the rows on the way. None, with nothing written, for
    tables that cannot be pointed at other files: those that are not managed Parquet
    or ORC, have partitions or buckets, or promise what files written beside them would
    not keep: lengths of strings (char, varchar) and options such as the compression."""
    spark = df.sparkSession
    if spark.catalog.tableExists(named(table)):
        target = _describe(spark, table)
        if not target.can_move:
            return None
        _refuse(refused_changes(df, table, policy, safe_casts=False))
        current, provider, root = spark.table(named(table)).schema, target.provider, target.location
    else:
        if fmt not in SELF_CONTAINED or table.count(".") != 1:
            return None
        schema, _, name = table.partition(".")
        _create_schema(spark, table)
        target, current, provider = None, StructType(), fmt
        root = f"{spark.catalog.getDatabase(schema).locationUri.rstrip('/')}/{name}"
    added = _additions(df, current) if target else ()
    fields = list(current) + [f for f in df.schema if not target or f.name in {c.column for c in added}]
    root = re.sub(r"\.rows-[0-9a-f]{32}$", "", root.rstrip("/"))
    location = f"{root}.rows-{uuid.uuid4().hex}"
    rows = _select(df, fields, cast=True)
    try:
        measured = _observed(rows, metrics, lambda df: df.write.format(provider).save(location))
    except BaseException:
        discard(spark, location)
        raise
    stored = StructType([StructField(f.name, f.dataType) for f in fields])
    return Draft(spark.read.schema(stored).format(provider).load(location), table, provider, location, target, added, measured)


def create(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    """A new table with the rows of ``df``, and its catalog schema if that is new too."""
    _create_schema(df.sparkSession, table)
    df.write.format(fmt).saveAsTable(named(table))


def _create_schema(spark: SparkSession, table: str) -> None:
    if "." in table:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {named(table.rpartition('.')[0])}")


def create_partitioned(
    spark: SparkSession, table: str, schema: StructType, partitions: Iterable[str], fmt: str = "parquet"
) -> None:
    """An empty table for ``add_partition``, unless there is a table already."""
    _create_schema(spark, table)
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
    by = ", ".join(map(quoted, partitions))
    spark.sql(f"CREATE TABLE IF NOT EXISTS {named(table)} ({columns}) USING {fmt} PARTITIONED BY ({by})")


def takes_partitions(spark: SparkSession, table: str, partitions: Iterable[str]) -> bool:
    target = _describe(spark, table)
    return target.provider in SELF_CONTAINED and target.partitions == tuple(partitions)


def takes_batches(spark: SparkSession, table: str) -> bool:
    return takes_partitions(spark, table, [INGEST_BATCH])


def ready_for_batches(df: DataFrame, table: str, fmt: str = "parquet", policy: EvolutionPolicy = STRICT) -> None:
    """A table for batches with the columns of ``df``: a new one, or the one there is, evolved as the policy allows."""
    spark = df.sparkSession
    stored = df.withColumn(INGEST_BATCH, F.lit(""))
    create_partitioned(spark, table, stored.schema, [INGEST_BATCH], fmt)
    if not takes_batches(spark, table):
        raise ValueError(f"{table} is no Parquet or ORC table partitioned by {INGEST_BATCH}")
    _refuse(refused_changes(stored, table, policy, safe_casts=False))
    _add_columns(spark, table, _additions(stored, spark.table(named(table)).schema))


# How the files of a batch are told apart that is kept with its unreadable lines.
READABLE = "readable"


def quarantine_of(table: str) -> str:
    """The table beside a table of batches that holds the lines that could not be read, with their text."""
    return f"{table}_quarantine"


@dataclass(frozen=True)
class Partition:
    """Rows of one partition, written where they will stay: to be checked as they are, and then
    published by adding the partition to the table, or discarded. Rows set ``apart`` go to a table of their own, first."""

    rows: DataFrame
    table: str
    values: Mapping[str, str]
    location: str
    measured: Mapping[str, object] = field(default_factory=dict)
    apart: Partition | None = None

    def publish(self) -> None:
        if self.apart:
            self.apart.publish()
        spark = self.rows.sparkSession
        spec = ", ".join(f"{quoted(name)} = '{_escaped(value)}'" for name, value in self.values.items())
        try:
            before = _partition_location(spark, self.table, spec)
            if before is None:
                spark.sql(f"ALTER TABLE {named(self.table)} ADD PARTITION ({spec}) LOCATION '{_escaped(self.location)}'")
            else:
                spark.sql(f"ALTER TABLE {named(self.table)} PARTITION ({spec}) SET LOCATION '{_escaped(self.location)}'")
        except BaseException:
            self.discard()
            raise
        # Readers that planned before may still be at the former files, which go with the table.
        with _upkeep(self.table, before):
            spark.catalog.refreshTable(named(self.table))

    def discard(self) -> None:
        discard(self.rows.sparkSession, self.location)
        if self.apart:
            self.apart.discard()


def draft_batch_apart(df: DataFrame, table: str, values: Mapping[str, str], text: str, metrics: Metrics | None = None) -> Partition:
    """Write ``df`` once, as two partitions: rows whose column ``text`` is NULL for the table, the others with that
    text for its quarantine. ``metrics`` are of all rows; the returned rows are those for the table."""
    spark = df.sparkSession
    fields = [f for f in spark.table(named(table)).schema if f.name not in values]
    target = _describe(spark, table)
    path = f"{target.location}/{'/'.join(f'{name}={quote(value, safe="")}' for name, value in values.items())}/{uuid.uuid4().hex}"
    rows = _select(df, [*fields, df.schema[text]], cast=True).withColumn(READABLE, F.col(quoted(text)).isNull())
    kept, other = (f"{path}/{READABLE}={str(flag).lower()}" for flag in (True, False))
    try:
        measured = _observed(rows, metrics, lambda rows: rows.write.partitionBy(READABLE).format(target.provider).save(path))
        # A folder of its own even without rows, which the catalog is to point at.
        rows.drop(READABLE).limit(0).write.mode("append").format(target.provider).save(kept)
    except BaseException:
        discard(spark, path)
        raise
    stored = StructType([StructField(f.name, f.dataType) for f in fields])
    with_text = StructType([*stored, StructField(text, df.schema[text].dataType)])
    bad = spark.read.schema(with_text).format(target.provider)
    found = rows.sparkSession.read.format(target.provider).schema(StructType([*with_text, StructField(READABLE, BooleanType())])).load(path)
    apart = None if found.where(~F.col(READABLE)).isEmpty() else Partition(bad.load(other), quarantine_of(table), values, other)
    return Partition(spark.read.schema(stored).format(target.provider).load(kept), table, values, kept, measured, apart)


def draft_partition(
    df: DataFrame, table: str, values: Mapping[str, str], marks: Iterable[str] = (), metrics: Metrics | None = None
) -> Partition:
    """Write ``df`` to a new folder under the partition's own. Of the columns ``marks``, which the
    table does not have, the files tell only where they are not NULL (there they are empty strings)."""
    spark = df.sparkSession
    marks = [name for name in marks if name in df.columns]
    for name in marks:
        df = df.withColumn(name, F.when(F.col(quoted(name)).isNotNull(), F.lit("")))
    fields = [f for f in spark.table(named(table)).schema if f.name not in values] + [df.schema[name] for name in marks]
    folders = "/".join(f"{name}={quote(value, safe='')}" for name, value in values.items())
    target = _describe(spark, table)
    path = f"{target.location}/{folders}/{uuid.uuid4().hex}"
    try:
        measured = _observed(_select(df, fields, cast=True), metrics, lambda df: df.write.format(target.provider).save(path))
    except BaseException:
        discard(spark, path)
        raise
    stored = StructType([StructField(f.name, f.dataType) for f in fields])
    return Partition(spark.read.schema(stored).format(target.provider).load(path), table, values, path, measured)


def add_partition(df: DataFrame, table: str, values: Mapping[str, str]) -> None:
    """Add ``df`` as one partition, or replace that partition.

    The files become part of the table when they are complete. So applications can add
    partitions at the same time, which plain appends to one table of files cannot, a
    repeated write leaves one copy, and one that dies half way leaves the partition as it was.
    """
    draft_partition(df, table, values).publish()


def drop_partitions(spark: SparkSession, table: str, partitions: Iterable[Mapping[str, str]]) -> None:
    """Take partitions out of a table, with their files, in one catalog change. One that is not there is no fault."""
    specs = [", ".join(f"{quoted(name)} = '{_escaped(value)}'" for name, value in values.items()) for values in partitions]
    if specs:
        spark.sql(f"ALTER TABLE {named(table)} DROP IF EXISTS {', '.join(f'PARTITION ({spec})' for spec in specs)}")
        spark.catalog.refreshTable(named(table))


def _partition_location(spark: SparkSession, table: str, spec: str) -> str | None:
    """Where the files of a partition are; None if there is no such partition."""
    if spark.sql(f"SHOW PARTITIONS {named(table)} PARTITION ({spec})").isEmpty():
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {named(table)} PARTITION ({spec})").collect()
    # The partition's own location comes before the table's.
    return next(row.data_type for row in described if row.col_name == "Location")


@dataclass(frozen=True)
class Target:
    provider: str
    location: str
    partitions: tuple[str, ...]
    bucketed: bool
    managed: bool
    limited: bool  # in the length of strings, by char or varchar
    options: bool  # of its own, such as the compression of its files

    @property
    def can_move(self) -> bool:
        """Nobody but the catalog needs to know where the files are."""
        particular = self.partitions or self.bucketed or self.limited or self.options
        return self.managed and self.provider in SELF_CONTAINED and not particular


def _describe(spark: SparkSession, table: str) -> Target:
    sections: dict[str, dict[str, str]] = {}
    current = sections.setdefault("", {})
    for row in spark.sql(f"DESCRIBE TABLE EXTENDED {named(table)}").collect():
        if row.col_name.startswith("# ") and row.col_name != "# col_name":
            current = sections.setdefault(row.col_name[2:], {})
        elif row.col_name and row.col_name != "# col_name":
            current[row.col_name] = row.data_type
    details = sections.get("Detailed Table Information", {})
    return Target(
        provider=details.get("Provider", "").lower(),
        location=details.get("Location", ""),
        partitions=tuple(sections.get("Partition Information", {})),
        bucketed="Num Buckets" in details,
        managed=details.get("Type") == "MANAGED",
        limited=any(re.search(r"\b(var)?char\(", kind) for kind in sections[""].values()),
        options=details.get("Storage Properties", "[]") not in {"[]", "[serialization.format=1]"},
    )


def _refuse(changes: list[Change]) -> None:
    if changes:
        raise SchemaError("\n".join(map(str, changes)))


def _additions(df: DataFrame, target: StructType) -> tuple[Change, ...]:
    return tuple(c for c in SchemaDrift(df.schema, target).changes() if c.kind == ADDED)


def _add_columns(spark: SparkSession, table: str, added: tuple[Change, ...]) -> None:
    if added:
        columns = ", ".join(f"{quoted(c.column)} {c.source_type}" for c in added)
        spark.sql(f"ALTER TABLE {named(table)} ADD COLUMNS ({columns})")


def _select(df: DataFrame, fields: Iterable[StructField], cast: bool) -> DataFrame:
    """The fields in their order; NULL for those ``df`` does not have."""
    given = set(df.columns)
    columns = []
    for field in fields:
        column = F.col(quoted(field.name)) if field.name in given else F.lit(None)
        if cast or field.name not in given:
            column = column.cast(field.dataType).alias(field.name)
        columns.append(column)
    return df.select(*columns)


def _conform(df: DataFrame, table: str, policy: EvolutionPolicy, safe_casts: bool) -> DataFrame:
    """``df`` with the table's columns in the table's order. Columns the policy lets
    through are added to the table first; older rows read NULL there."""
    spark = df.sparkSession
    _refuse(refused_changes(df, table, policy, safe_casts))
    _add_columns(spark, table, _additions(df, spark.table(named(table)).schema))
    return _select(df, spark.table(named(table)).schema, cast=False)


def _insert(rows: DataFrame, table: str, target: Target, overwrite: bool) -> None:
    spark = rows.sparkSession
    if target.partitions:
        # A few files per partition instead of one per task; AQE splits a large one.
        rows = rows.hint("rebalance", *target.partitions)
    with _whole_table(spark):
        rows.write.insertInto(named(table), overwrite=overwrite)
    spark.catalog.refreshTable(named(table))


@contextmanager
def _staged(rows: DataFrame, table: str, target: Target):
    """The rows as written once, so that no value can fail any more. Where the table limits the length
    of strings they go through a table like it, as only the write to such a table checks them."""
    spark = rows.sparkSession
    if not target.limited:
        path = new_path(spark, table)
        try:
            yield stage(rows, path)
        finally:
            discard(spark, path)
        return
    like = f"{table}_rows_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {named(like)} LIKE {named(table)}")
    try:
        _insert(rows, like, target, overwrite=False)
        yield spark.table(named(like))
    finally:
        spark.sql(f"DROP TABLE {named(like)}")


def _escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


@contextmanager
def _whole_table(spark: SparkSession):
    """Under dynamic mode an overwrite would spare partitions it has no rows for."""
    before = spark.conf.get(OVERWRITE_MODE)
    if before.lower() == "static":
        yield
        return
    spark.conf.set(OVERWRITE_MODE, "static")
    try:
        yield
    finally:
        spark.conf.set(OVERWRITE_MODE, before)
