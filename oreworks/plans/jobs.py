"""Jobs: read, transform, check, write; and the run of a domain's layers."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from oreworks import scratch
from oreworks.functions.transforms import Transform, same
from oreworks.operators.audit import INTENT, gate_is_open, persist_quality_results, record_commit
from oreworks.operators.checks import CheckResult, collect, evaluate, plain_measures, raise_if_failed
from oreworks.operators.drift import STRICT, Change, EvolutionPolicy
from oreworks.operators.keys import check_new_keys, known_hashes
from oreworks.operators.rules import ROWS, CorruptRecords, Rule
from oreworks.sinks import tables

LAYERS = ("bronze", "silver", "gold")
DRIFT_CHECK = "schema_drift"
WRITE_CHECK = "written"


class GateClosed(RuntimeError):
    """The layer below did not pass its latest run, or had none."""


@dataclass(frozen=True)
class Job:
    """One table of one layer.

    ``staged`` is for tables that cannot be drafted, as those appended to: it writes
    the rows once to the shared folder, and checks and publishes from there. It pays
    where computing them again costs more than writing and reading them: parsed text,
    grouped results. Otherwise the checks read the rule's own columns from the source
    and the write reads it again.

    ``batches`` is for tables that are appended to: the table is partitioned by
    ``ingest_batch``, as a stream's. Each run writes its rows once, as a partition that is
    checked and then added, so the source is read once, what was checked is what
    is stored, and runs can append at the same time.

    With ``quarantine``, lines of text that cannot be read are not rows of the table: the batch is written in one go as what
    can be read, which the rules are about, and what cannot, which a table beside it holds with its text.

    ``new_keys`` are keys of which a batch may hold none that another batch of the table holds.
    """

    domain: str
    layer: str
    name: str
    read: Callable[[SparkSession], DataFrame]
    transform: Transform = same
    rules: tuple[Rule, ...] = ()
    policy: EvolutionPolicy = STRICT
    staged: bool = False
    schema: str | None = None
    fmt: str = "parquet"
    aside: tuple[str, ...] = ()  # columns that rules may ask for and the table does not hold
    batches: bool = False
    new_keys: tuple[tuple[str, ...], ...] = ()
    quarantine: bool = False

    def __post_init__(self):
        if self.layer not in LAYERS:
            raise ValueError(f"layer {self.layer!r} is none of {LAYERS}")
        if self.batches and not self.appends:
            raise ValueError(f"{self.layer} is replaced and has no batches")
        if self.new_keys and not self.batches:
            raise ValueError("keys are compared between batches")
        if self.quarantine and not (self.batches and self.aside):
            raise ValueError("quarantine is for batches of text")

    @property
    def table(self) -> str:
        return f"{self.schema or self.domain}.{self.layer}_{self.name}"

    @property
    def appends(self) -> bool:
        """Bronze keeps what it was given; silver and gold are derived anew."""
        return self.layer == "bronze"

    def frame(self, spark: SparkSession) -> DataFrame:
        return self.read(spark).transform(self.transform)

    def write(self, df: DataFrame) -> None:
        if self.batches:
            self.draft_batch(df, uuid.uuid4().hex).publish()
            return
        sink = tables.append if self.appends else tables.replace
        sink(df.drop(*self.aside), self.table, self.fmt, self.policy)

    def draft_batch(self, df: DataFrame, batch: str, metrics: tables.Metrics | None = None) -> tables.Partition:
        tables.ready_for_batches(df.drop(*self.aside), self.table, self.fmt, self.policy)
        if self.quarantine and self.aside[0] in df.columns:
            tables.ready_for_batches(df, tables.quarantine_of(self.table), self.fmt, self.policy)
            return tables.draft_batch_apart(df, self.table, {tables.INGEST_BATCH: batch}, self.aside[0], metrics)
        return tables.draft_partition(df, self.table, {tables.INGEST_BATCH: batch}, self.aside, metrics)

    def refused_changes(self, df: DataFrame) -> list[Change]:
        rows = df.drop(*self.aside)
        if self.batches:
            rows = rows.withColumn(tables.INGEST_BATCH, F.lit(""))
        return tables.refused_changes(rows, self.table, self.policy, safe_casts=self.appends and not self.batches)

    def run(self, spark: SparkSession) -> None:
        """Read, transform and write, with no rules and no audit."""
        self.write(self.frame(spark))


@dataclass(frozen=True)
class Run:
    """What the audit rows of one run have in common."""

    audit_table: str
    timestamp: dt.datetime
    id: str
    fmt: str = "parquet"

    @classmethod
    def now(cls, audit_table: str, fmt: str = "parquet") -> Run:
        return cls(audit_table, dt.datetime.now(dt.timezone.utc), uuid.uuid4().hex, fmt)

    def record(self, spark: SparkSession, job: Job, results: list[CheckResult], part: str = INTENT) -> None:
        part_id = f"{self.id}.{job.name}{part}"
        persist_quality_results(
            spark, results, self.audit_table, job.domain, job.layer, self.timestamp, part_id, self.fmt
        )

    def commit(self, spark: SparkSession, job: Job) -> None:
        """The rows of which ``record`` told that they passed are published."""
        part_id = f"{self.id}.{job.name}{INTENT}"
        record_commit(spark, self.audit_table, job.domain, job.layer, job.table, self.timestamp, part_id, self.fmt)

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.audit_table).filter(F.col("run_id").startswith(self.id))


def run_checked(spark: SparkSession, job: Job, run: Run) -> None:
    """Run one job. Its table changes only if the schema may change as it does and
    all rules hold; either way the results are in the audit table first, and a commit follows when the
    rows are in place: until then the gate stays closed, so a driver that dies in between opens none. Any failure
    after the start of the run is logged too, as the gate must not open on rows that are not there.

    A table that is replaced is drafted where it can be, and so is a batch: the rows are computed
    and written once, plain measurements are taken while they are written, keys are read from the written files, and publishing
    them moves no data.
    """
    draft = staging = None
    recorded = False
    try:
        df = job.frame(spark)
        refused = job.refused_changes(df)
        results = [CheckResult(DRIFT_CHECK, not refused, "; ".join(map(str, refused)))]
        rules = [] if refused else rules_for(df, job)
        stored = as_stored(rules)
        counted = {ROWS: F.count("*")} if job.new_keys else {}
        # Of a batch with a quarantine only the lines are counted on the way: other rules are about what can be read.
        on_the_way = [rule for rule in stored if isinstance(rule, CorruptRecords) or not job.quarantine]
        metrics = lambda rows: counted | plain_measures(rows, on_the_way)
        if job.batches and not refused:
            draft = job.draft_batch(df, run.id, metrics)
        elif rules and not job.appends:
            draft = tables.draft(df, job.table, job.fmt, job.policy, metrics)
        if draft:
            df = draft.rows
        elif rules and job.staged:
            staging = scratch.new_path(spark, job.table)
            df = scratch.stage(df, staging)
        if draft or staging:
            rules = stored
        if rules:
            known = dict(draft.measured) if draft else {}
            if job.quarantine:
                known.pop(ROWS, None)  # of all lines
            results += collect(evaluate(df, rules, known=known))
        for columns in job.new_keys if draft else ():
            results.append(check_new_keys(df, job.table, columns, run.id, draft.measured.get(ROWS), job.fmt))
        run.record(spark, job, results)
        recorded = not all(result.passed for result in results)
        raise_if_failed(results)
        # From here on the draft may be what the table points at; publishing removes it if it is not.
        written, draft = draft, None
        written.publish() if written else job.write(df)
        for columns in job.new_keys:
            known_hashes(spark, job.table, columns, job.fmt)  # now, so that the next batch is held against hashes alone
        run.commit(spark, job)
    except Exception as failure:
        # Rows that could not be read, computed, checked or written: the gate must not stay open on the last run.
        if not recorded:
            run.record(spark, job, [CheckResult(WRITE_CHECK, False, type(failure).__name__)], ".write")
        raise
    finally:
        if draft:
            draft.discard()
        if staging:
            scratch.discard(spark, staging)


def rules_for(df: DataFrame, job: Job) -> list[Rule]:
    """The job's rules. Where unreadable lines were set aside and no rule limits
    them, they are counted for the audit."""
    counted = CorruptRecords(tolerated=None)
    limited = any(isinstance(rule, CorruptRecords) for rule in job.rules)
    return [*job.rules, counted] if counted.column in df.columns and not limited else list(job.rules)


def as_stored(rules: Iterable[Rule]) -> list[Rule]:
    """The rules for rows that have been parsed and written."""
    return [replace(rule, stored=True) if isinstance(rule, CorruptRecords) else rule for rule in rules]


def run_domain(
    spark: SparkSession,
    jobs: Iterable[Job],
    audit_table: str,
    layers: Iterable[str] = LAYERS,
    require_gate: bool = False,
    fmt: str = "parquet",
) -> DataFrame:
    """Run jobs in layer order within one application and return the audit rows of
    this run. The first failure stops it, before any layer above is touched.

    With ``require_gate``, a job above bronze starts only if the latest audited run
    of the layer below passed: for layers run as separate applications.
    """
    wanted = tuple(layers)
    run = Run.now(audit_table, fmt)
    for job in sorted(jobs, key=lambda j: LAYERS.index(j.layer)):
        if job.layer not in wanted:
            continue
        below = LAYERS[max(LAYERS.index(job.layer) - 1, 0)]
        if require_gate and below != job.layer and not gate_is_open(spark, audit_table, job.domain, below):
            raise GateClosed(f"{job.table}: the latest {below} run of {job.domain} did not pass")
        run_checked(spark, job, run)
    return run.rows(spark)
