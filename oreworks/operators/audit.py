"""The audit table: every check result of every run, and what it says about a layer."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from oreworks.functions.frames import constant_rows
from oreworks.operators.checks import CheckResult
from oreworks.sinks import tables
from oreworks.sources import catalog

# What a partition of the log is for.
RUN = ["domain", "layer", "run_id"]
# How the run ids end under which jobs log results before they publish.
INTENT = ".checks"
RESULT_SCHEMA = "check_name string, passed boolean, details string"


def audit_rows(
    results: DataFrame,
    domain: str,
    layer: str,
    run_timestamp: dt.datetime | None = None,
    run_id: str | None = None,
) -> DataFrame:
    """Results as audit rows. All rows of a call share one timestamp and run id."""
    moment = run_timestamp or dt.datetime.now(dt.timezone.utc)
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=dt.timezone.utc)
    return results.select(
        F.lit(domain).alias("domain"),
        F.lit(layer).alias("layer"),
        "check_name",
        "passed",
        "details",
        F.lit(moment).alias("run_timestamp"),
        F.lit(run_id or uuid.uuid4().hex).alias("run_id"),
    )


def result_rows(spark: SparkSession, results: Sequence[CheckResult]) -> DataFrame:
    return constant_rows(spark, [(r.check_name, r.passed, r.details) for r in results], RESULT_SCHEMA)


def persist_quality_results(
    spark: SparkSession,
    results: Sequence[CheckResult] | DataFrame,
    table_name: str,
    domain: str,
    layer: str,
    run_timestamp: dt.datetime | None = None,
    run_id: str | None = None,
    fmt: str = "parquet",
) -> None:
    """Add results to the audit table; an empty list adds nothing.

    A table of files is created with a partition per domain, layer and run, so that
    applications can log at the same time, a gate reads its own layer only, and a run
    that is recorded again is there once. Any other table is appended to.
    """
    if not isinstance(results, DataFrame):
        if not results:
            return
        results = result_rows(spark, results)
    run = {"domain": domain, "layer": layer, "run_id": run_id or uuid.uuid4().hex}
    rows = audit_rows(results, domain, layer, run_timestamp, run["run_id"])
    if fmt in tables.SELF_CONTAINED:
        tables.create_partitioned(spark, table_name, rows.schema, run, fmt)
        if tables.takes_partitions(spark, table_name, run):
            tables.add_partition(rows, table_name, run)
            return
    tables.append(rows, table_name, fmt)


def commits_of(audit_table: str) -> str:
    """The table beside an audit table that says which checked runs were published."""
    return f"{audit_table}_commits"


def record_commit(
    spark: SparkSession, audit_table: str, domain: str, layer: str, table: str, run_timestamp: dt.datetime, run_id: str, fmt: str = "parquet"
) -> None:
    """The second step of a run: its rows are in ``table``. The first step is its results under the same ``run_id``, which
    ends in ``INTENT``."""
    row = constant_rows(spark, [(table,)], "table_name string").select("table_name", F.lit(run_timestamp).alias("run_timestamp"))
    run, commits = {"domain": domain, "layer": layer, "run_id": run_id}, commits_of(audit_table)
    row = row.select("*", *[F.lit(value).alias(name) for name, value in run.items()])
    if fmt in tables.SELF_CONTAINED:
        tables.create_partitioned(spark, commits, row.schema, run, fmt)
        if tables.takes_partitions(spark, commits, run):
            tables.add_partition(row, commits, run)
            return
    tables.append(row, commits, fmt)


def latest_runs(audit: DataFrame, commits: DataFrame | None = None) -> DataFrame:
    """Per domain and layer, when its latest run was and whether all of it passed.

    With ``commits``, results whose run id ends in ``INTENT`` only say that their rows were about to be published: they count
    as passed if that id is among the commits. A driver that dies in between so leaves the gate closed.

    Two grouped aggregates, each combined within tasks first, so a layer that owns
    most of the log is no heavier than others. Runs of the same microsecond count
    as one: the gate is open only if all of them passed.
    """
    passed = F.coalesce("passed", F.lit(False))
    if commits is not None:
        done = commits.select(*RUN, F.lit(True).alias("committed")).distinct()
        audit = audit.join(done, RUN, "left")
        passed = passed & (~F.endswith("run_id", F.lit(INTENT)) | F.coalesce("committed", F.lit(False)))
    runs = audit.groupBy("domain", "layer", "run_timestamp").agg(F.every(passed).alias("passed"))
    return runs.groupBy("domain", "layer").agg(
        F.max("run_timestamp").alias("run_timestamp"),
        F.max_by("passed", "run_timestamp").alias("gate_open"),
    )


def gates(spark: SparkSession, table: str, domain: str | None = None, layer: str | None = None) -> DataFrame:
    """``latest_runs`` of an audit table and its commits, of one domain and layer or of all."""
    wanted = {"domain": domain, "layer": layer}

    def of(name: str) -> DataFrame:
        log = catalog.table(spark, tables.named(name))
        for column, value in wanted.items():
            log = log if value is None else log.filter(F.col(column) == value)
        return log

    commits = commits_of(table)
    nothing = constant_rows(spark, [], "domain string, layer string, run_id string")
    return latest_runs(of(table), of(commits) if spark.catalog.tableExists(tables.named(commits)) else nothing)


def _commits(spark: SparkSession, audit_table: str) -> DataFrame:
    name = tables.named(commits_of(audit_table))
    if not spark.catalog.tableExists(name):
        return constant_rows(spark, [], "domain string, layer string, run_id string, committed boolean")
    return catalog.table(spark, name).select(*RUN, F.lit(True).alias("committed")).distinct()


def gate_is_open(spark: SparkSession, table: str, domain: str, layer: str) -> bool:
    """Did the latest run of this layer pass, and are its rows in place? No run is not a pass."""
    if not spark.catalog.tableExists(tables.named(table)):
        return False
    return any(row.gate_open for row in gates(spark, table, domain, layer).collect())


# Upkeep of the log

DAY = "day"


def archive_of(audit_table: str) -> str:
    """The table beside an audit table that holds its earlier runs, a partition per day."""
    return f"{audit_table}_archive"


def archive_runs(spark: SparkSession, audit_table: str, before: dt.datetime, fmt: str = "parquet") -> int:
    """Move runs that began before a moment into the archive, all but the latest of each domain and layer, whose gate so
    stays what it is. Returns how many partitions the log has lost.

    A day is written anew with what it held, as one partition; then the log and the commits lose their partitions in one catalog
    change each. If this stops in between, runs are in both, which ``history`` reads once and the next time mends.
    """
    if not tables.takes_partitions(spark, audit_table, RUN):
        raise ValueError(f"{audit_table} has no partition for each run")
    if before.tzinfo is None:
        before = before.replace(tzinfo=dt.timezone.utc)
    log, commits = catalog.table(spark, tables.named(audit_table)), _commits(spark, audit_table)
    latest = log.groupBy("domain", "layer").agg(F.max("run_timestamp").alias("latest"))
    old = log.join(latest, ["domain", "layer"]).where((F.col("run_timestamp") < F.lit(before)) & (F.col("run_timestamp") < F.col("latest")))
    committed = F.when(F.endswith("run_id", F.lit(INTENT)), F.coalesce("committed", F.lit(False))).alias("committed")
    # Days of UTC, whatever the session's zone.
    day = F.date_format(F.timestamp_seconds(F.floor(F.unix_micros("run_timestamp") / 86_400_000_000) * 86_400 + 43_200), "yyyy-MM-dd")
    old = old.join(commits, RUN, "left").select(*log.columns, committed, day.alias(DAY))
    # A row for each partition that goes, as the catalog lists them.
    gone = old.select(*RUN, DAY).distinct().collect()
    if not gone:
        return 0
    archive = archive_of(audit_table)
    tables.create_partitioned(spark, archive, old.schema, [DAY], fmt)
    for day_ in sorted({row[DAY] for row in gone}):
        new = old.where(F.col(DAY) == day_).drop(DAY)
        held = catalog.table(spark, tables.named(archive)).where(F.col(DAY) == day_).drop(DAY)
        tables.add_partition(held.join(new.select(*RUN).distinct(), RUN, "left_anti").unionByName(new), archive, {DAY: day_})
    runs = [{name: row[name] for name in RUN} for row in gone]
    tables.drop_partitions(spark, audit_table, runs)
    if spark.catalog.tableExists(tables.named(commits_of(audit_table))):
        tables.drop_partitions(spark, commits_of(audit_table), runs)
    return len(gone)


def history(spark: SparkSession, audit_table: str) -> DataFrame:
    """All runs, archived ones too, with whether those that were about to publish did (NULL for other rows)."""
    log = catalog.table(spark, tables.named(audit_table))
    committed = F.when(F.endswith("run_id", F.lit(INTENT)), F.coalesce("committed", F.lit(False))).alias("committed")
    live = log.join(_commits(spark, audit_table), RUN, "left").select(*log.columns, committed)
    if not spark.catalog.tableExists(tables.named(archive_of(audit_table))):
        return live
    archived = catalog.table(spark, tables.named(archive_of(audit_table))).drop(DAY)
    return live.unionByName(archived.join(log.select(*RUN).distinct(), RUN, "left_anti"))
