"""Every registered query: ``(spark, sf_dir) -> DataFrame`` over the whole tables."""

from __future__ import annotations

import dataclasses
import datetime as dt
import functools
from collections.abc import Callable
from pathlib import Path

from pyspark.errors import SparkRuntimeException
from pyspark.sql import DataFrame, SparkSession, functions as F

from oreworks.functions import transforms as t
from oreworks.functions.frames import constant_rows
from oreworks.operators import audit, checks, drift
from oreworks.operators.checks import Validator
from oreworks.operators.rules import CorruptRecords, Fresh, NotNull, RowCount, UniqueKey
from oreworks.plans import config, domains
from oreworks.plans.jobs import Job, run_domain
from oreworks.sinks import tables
from oreworks.sources import catalog, files
from registered.inputs import (
    AS_OF,
    MICROS,
    as_csv,
    as_json,
    as_text,
    events,
    graded_documents,
    load,
    new_schema,
    production,
    transactions,
    untyped_events,
)

FINANCE_RULES = Path(domains.__file__).with_name("rules") / "finance_silver.yaml"
EVENT_RULES = FINANCE_RULES.with_name("sbe_silver.yaml")
FIRST_DAY = dt.datetime(1995, 1, 1)
RUN_AT = dt.datetime(2024, 2, 1, 6, 30, tzinfo=dt.timezone.utc)


# Sources


def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders")


def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = load(spark, sf_dir, "lineitem")
    return files.csv(spark, as_csv(source), source.schema, **MICROS)


def scan_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.csv(spark, as_csv(load(spark, sf_dir, "part")))


def scan_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = events(spark, sf_dir)
    return files.json(spark, as_json(source), source.schema, **MICROS)


def scan_json_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.json(spark, as_json(load(spark, sf_dir, "conversations")))


def scan_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"{new_schema(spark)}.bronze_suppliers"
    tables.append(load(spark, sf_dir, "supplier"), table)
    return catalog.table(spark, table)


def catalog_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schema of a catalog table, without its rows."""
    table = f"{new_schema(spark)}.bronze_parts"
    tables.append(load(spark, sf_dir, "part"), table)
    rows = [(f.name, f.dataType.simpleString()) for f in catalog.table_schema(spark, table)]
    return constant_rows(spark, rows, "column_name string, data_type string")


# Sinks


def append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"{new_schema(spark)}.bronze_orders"
    orders = load(spark, sf_dir, "orders")
    tables.append(orders, table)
    # By name: the order of the columns does not matter.
    tables.append(orders.select(*reversed(orders.columns)), table)
    return spark.table(table)


def append_evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"{new_schema(spark)}.bronze_parts"
    parts = load(spark, sf_dir, "part")
    tables.append(parts.drop("p_brand"), table)
    tables.append(parts, table, policy=drift.EvolutionPolicy(allowed_additions=["p_brand"]))
    return spark.table(table)


def replace_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"{new_schema(spark)}.silver_customers"
    customers = load(spark, sf_dir, "customer")
    tables.replace(customers, table)
    tables.replace(customers.transform(t.keep_positive("c_acctbal")), table)
    return spark.table(table)


def replace_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A frame that lost a column and retyped another is refused, and the table stays."""
    table = f"{new_schema(spark)}.silver_parts"
    parts = load(spark, sf_dir, "part")
    tables.replace(parts, table)
    try:
        tables.replace(parts.drop("p_brand").withColumn("p_size", F.col("p_size").cast("string")), table)
    except drift.SchemaError as refusal:
        reasons = str(refusal).splitlines()
    return spark.table(table).withColumn("reasons", F.lit(len(reasons)))


# Projections, filters, aggregates


def select_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").transform(t.pick("l_extendedprice"))


def keep_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").transform(t.keep_positive("c_acctbal"))


def keep_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graded_documents(spark, sf_dir).transform(t.keep_not_null("quality"))


def keep_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graded_documents(spark, sf_dir).transform(t.keep_null("quality"))


def grouped_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a group of NULL keys, and groups whose values are all NULL."""
    return graded_documents(spark, sf_dir).transform(t.total("toxic", by="quality", alias="toxic_documents"))


def grouped_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return untyped_events(spark, sf_dir).transform(t.row_counts(by="event_type", alias="event_count"))


def exact_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts and rates, which differ in size, in one sum per return flag."""
    numbers = load(spark, sf_dir, "lineitem").select("l_returnflag", F.explode(F.array("l_extendedprice", "l_tax", "l_discount")).alias("number"))
    return numbers.transform(t.exact_total("number", by="l_returnflag", alias="total"))


def global_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, nulls, distinct values with NULL as one of them, and the latest instant."""
    source = untyped_events(spark, sf_dir)
    rules = [RowCount(), NotNull("event_type"), UniqueKey(("event_type",)), Fresh("ts", 1)]
    measured, value = checks.measure(source, rules)
    rows, present, latest, distinct = value.values()
    return measured.select(
        rows.alias("row_total"),
        (rows - present).alias("nulls"),
        latest.alias("latest_micros"),
        distinct.alias("distinct_values"),
    )


# Jobs, as plain plans


def manufacturing_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return production(spark, sf_dir).transform(domains.production_ingest)


def manufacturing_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manufacturing_bronze(spark, sf_dir).transform(domains.production_kept)


def manufacturing_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manufacturing_silver(spark, sf_dir).transform(domains.production_output)


def finance_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir).transform(t.same)


def finance_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finance_bronze(spark, sf_dir).transform(domains.transactions_kept)


def finance_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finance_silver(spark, sf_dir).transform(domains.transactions_spend)


def sbe_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return untyped_events(spark, sf_dir).transform(t.same)


def sbe_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sbe_bronze(spark, sf_dir).transform(domains.events_kept)


def sbe_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sbe_silver(spark, sf_dir).transform(domains.events_counted)


# Jobs, layer by layer through catalog tables, checked and audited


def _run_manufacturing(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    schema = new_schema(spark)
    path = as_csv(production(spark, sf_dir))
    raw_schema = "order_id bigint, plant_id bigint, quantity double, prod_dt timestamp_ntz"
    rules = {
        "bronze": (RowCount(1), NotNull("production_date")),
        "silver": (NotNull("plant_id"),),
        "gold": (UniqueKey(("plant_id",)),),
    }
    jobs = domains.manufacturing(domains.manufacturing.raw_files(path, raw_schema, **MICROS), rules, schema)
    return schema, run_domain(spark, jobs, f"{schema}.audit")


def _run_finance(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    schema = new_schema(spark)
    rules = {
        "bronze": (RowCount(1),),
        # As of a day before the newest order, which is fresh.
        "silver": config.rules_from(config.load_quality_config(str(FINANCE_RULES)), FIRST_DAY),
        "gold": (UniqueKey(("account_id",)), NotNull("total_spend")),
    }
    return schema, run_domain(spark, domains.finance(lambda s: transactions(s, sf_dir), rules, schema), f"{schema}.audit")


def _run_sbe(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    schema = new_schema(spark)
    path = as_json(untyped_events(spark, sf_dir))
    rules = {
        "bronze": (RowCount(1), UniqueKey(("event_id",))),
        "silver": (NotNull("event_type"),),
        "gold": (RowCount(1, 1000),),
    }
    return schema, run_domain(spark, domains.sbe(path, rules, schema), f"{schema}.audit")


def manufacturing_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema, _ = _run_manufacturing(spark, sf_dir)
    return spark.table(f"{schema}.gold_output_metrics")


def finance_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema, _ = _run_finance(spark, sf_dir)
    return spark.table(f"{schema}.gold_account_metrics")


def sbe_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema, _ = _run_sbe(spark, sf_dir)
    return spark.table(f"{schema}.gold_event_metrics")


def _without_time(audit_log: DataFrame) -> DataFrame:
    return audit_log.select("domain", "layer", "check_name", "passed", "details")


def manufacturing_run_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_time(_run_manufacturing(spark, sf_dir)[1])


def finance_run_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_time(_run_finance(spark, sf_dir)[1])


def sbe_run_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_time(_run_sbe(spark, sf_dir)[1])


def finance_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze after two runs, each of which added a batch: every transaction, and in how many batches it is."""
    schema = new_schema(spark)
    rules = {"bronze": (RowCount(1), UniqueKey(("transaction_id",)))}
    jobs = domains.finance(lambda s: transactions(s, sf_dir), rules, schema, batches=True)
    for _ in range(2):
        run_domain(spark, jobs, f"{schema}.audit", ["bronze"])
    bronze = spark.table(jobs[0].table)
    kept = [c for c in bronze.columns if c != "ingest_batch"]
    return bronze.groupBy(*kept).agg(F.count("*").alias("copies"), F.count_distinct("ingest_batch").alias("batches"))


def _damaged_lines(spark: SparkSession, sf_dir: str) -> str:
    """Events as JSON lines: those of errors are cut off, those of signups have text for a number."""
    source = events(spark, sf_dir)
    value = F.when(F.col("event_type") == "signup", "much").otherwise(F.col("value").cast("string"))
    line = F.to_json(F.struct(*[value.alias(c) if c == "value" else F.col(c) for c in source.columns]), MICROS)
    number = F.regexp_replace("line", r'"value":"([^"m]*)"', '"value":$1')
    cut = F.expr("substring(line, 1, length(line) - 5)")
    lines = source.withColumn("line", line).withColumn("line", number)
    return as_text(lines.select(F.when(F.col("event_type") == "error", cut).otherwise(F.col("line")).alias("value")))


def sbe_two_days_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A clean day, then a day with unreadable lines: they are counted, and no drift."""
    schema, source = new_schema(spark), events(spark, sf_dir)
    rules = {"bronze": (RowCount(1),), "silver": (RowCount(1), NotNull("event_type")), "gold": (UniqueKey(("event_type",)),)}
    for path in (as_json(source), _damaged_lines(spark, sf_dir)):
        raw = domains.sbe.raw_files(path, source.schema, **MICROS)
        run_domain(spark, domains.sbe(raw, rules, schema), f"{schema}.audit")
    return _without_time(spark.table(f"{schema}.audit"))


def sbe_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A clean day, then one with unreadable lines: the ids that their kept texts begin with, and the run's count of rows in bronze."""
    schema, source = new_schema(spark), events(spark, sf_dir)
    for path in (as_json(source), _damaged_lines(spark, sf_dir)):
        raw = domains.sbe.raw_files(path, source.schema, **MICROS)
        jobs = domains.sbe(raw, {"bronze": (RowCount(1), NotNull("event_type"))}, schema, batches=True, quarantine=True)
        run_domain(spark, jobs, f"{schema}.audit", ["bronze"])
    lines = spark.table(tables.quarantine_of(jobs[0].table))
    event_id = F.regexp_extract(files.UNREADABLE, r'"event_id":(\d+)', 1).cast("long")
    return lines.select(event_id.alias("event_id"), F.lit(spark.table(jobs[0].table).count()).cast("long").alias("bronze_rows"))


def gate_after_failed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver was fine, then its rows cannot be computed: its gate closes, that of bronze stays open."""
    schema = new_schema(spark)
    audit_table = f"{schema}.audit"
    refuse = F.when(F.col("event_type") == "error", F.raise_error(F.lit("no type"))).otherwise(F.col("event_type"))
    bronze, silver, _ = domains.sbe(lambda s: events(s, sf_dir), {"silver": (RowCount(1),)}, schema)
    run_domain(spark, (bronze, silver), audit_table)
    failing = dataclasses.replace(silver, transform=lambda df: df.withColumn("event_type", refuse))
    try:
        run_domain(spark, (failing,), audit_table)
    except SparkRuntimeException:
        pass  # what the audit says of it is the result
    return audit.latest_runs(catalog.table(spark, audit_table)).select("domain", "layer", "gate_open")


class _Killed(BaseException):
    """The end of a driver, which nothing catches."""


class _Dying(Job):
    def write(self, df: DataFrame) -> None:
        raise _Killed


def gate_after_killed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every type of event is a domain. Where there is an odd number of them, the driver dies when silver's checks have
    been logged as passed and before its rows are published."""
    schema, source = new_schema(spark), events(spark, sf_dir)
    for event_type, number in source.groupBy("event_type").count().collect():
        only = F.col("event_type") == event_type
        bronze, silver, _ = domains.sbe(lambda s, only=only: source.where(only), schema=schema)
        names = {"domain": event_type, "name": f"{bronze.name}_{event_type}"}
        bronze = dataclasses.replace(bronze, **names)
        silver = dataclasses.replace(silver, read=lambda s, t=bronze.table: catalog.table(s, t), **names)
        run_domain(spark, (bronze, silver), f"{schema}.audit")
        if number % 2:
            dying = _Dying(**{f.name: getattr(silver, f.name) for f in dataclasses.fields(silver)})
            try:
                run_domain(spark, (dying,), f"{schema}.audit")
            except _Killed:
                pass  # what the audit says of it is the result
    return audit.gates(spark, f"{schema}.audit").select("domain", "layer", "gate_open")


def _two_feeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Transactions up to a day, and later ones."""
    rows, early = transactions(spark, sf_dir), F.col("event_time") < F.lit(FIRST_DAY)
    return rows.where(early), rows.where(~F.coalesce(early, F.lit(False)))


def finance_new_keys_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of early transactions, then one of all of them, which holds keys that are known."""
    schema = new_schema(spark)
    for feed in (_two_feeds(spark, sf_dir)[0], transactions(spark, sf_dir)):
        jobs = domains.finance(lambda s, feed=feed: feed, {"bronze": (RowCount(1),)}, schema, batches=True, new_keys=[("transaction_id",)])
        try:
            run_domain(spark, jobs, f"{schema}.audit", ["bronze"])
        except checks.QualityError:
            pass  # what the audit says of it is the result
    return _without_time(spark.table(f"{schema}.audit"))


def finance_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spend per account, from the partial sums of two batches."""
    schema = new_schema(spark)
    for feed in _two_feeds(spark, sf_dir):
        jobs = domains.finance(lambda s, feed=feed: feed, {"gold": (UniqueKey(("account_id",)),)}, schema, batches=True, incremental=True)
        run_domain(spark, jobs, f"{schema}.audit", ["bronze", "gold"])
    return spark.table(jobs[2].table)


def sbe_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per type, from the partial counts of two batches: those of some value, and the others."""
    schema, rows = new_schema(spark), untyped_events(spark, sf_dir)
    for feed in (rows.where("value < 50"), rows.where("value >= 50 OR value IS NULL")):
        jobs = domains.sbe(lambda s, feed=feed: feed, {"gold": (RowCount(1),)}, schema, batches=True, incremental=True)
        run_domain(spark, jobs, f"{schema}.audit", ["bronze", "gold"])
    return spark.table(jobs[2].table)


# Data quality


def check_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.evaluate(load(spark, sf_dir, "lineitem"), [RowCount(1), RowCount(1_000_000_000)])


def check_row_count_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [RowCount(25, 25), RowCount(26, 99), RowCount(0, 24)]
    return checks.evaluate(load(spark, sf_dir, "nation"), rules)


def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.evaluate(graded_documents(spark, sf_dir), [NotNull("doc_id"), NotNull("quality"), NotNull("toxic")])


def check_primary_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.evaluate(load(spark, sf_dir, "orders"), [UniqueKey(("o_orderkey",))])


def check_primary_key_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.evaluate(load(spark, sf_dir, "lineitem"), [UniqueKey(("l_orderkey", "l_linenumber"))])


def check_primary_key_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL is one key: a column of nothing but distinct values and many NULLs fails."""
    rules = [UniqueKey(("quality",)), UniqueKey(("doc_id", "quality"))]
    return checks.evaluate(graded_documents(spark, sf_dir), rules)


def check_primary_key_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.evaluate(load(spark, sf_dir, "documents"), [UniqueKey(("text",), digest=True)])


def check_primary_key_hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [UniqueKey(("text",), hashed=True), UniqueKey(("lang", "source"), hashed=True), UniqueKey(("doc_id", "text"), hashed=True)]
    return checks.evaluate(load(spark, sf_dir, "documents"), rules)


def check_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.evaluate(events(spark, sf_dir), [Fresh("ts", limit, AS_OF) for limit in (2, 3, 60)])


def check_corrupt_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines cut off, and a value of the wrong type in a column no other rule reads."""
    read = files.with_unreadable(files.json)
    lines = read(spark, _damaged_lines(spark, sf_dir), events(spark, sf_dir).schema, **MICROS)
    return checks.evaluate(lines, [RowCount(1), NotNull("event_type"), CorruptRecords()])


def check_corrupt_records_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as CSV, where those returned have text for a tax."""
    source = load(spark, sf_dir, "lineitem")
    tax = F.when(F.col("l_returnflag") == "R", "none").otherwise(F.col("l_tax").cast("string"))
    read = files.with_unreadable(files.csv)
    lines = read(spark, as_csv(source.withColumn("l_tax", tax)), source.schema, **MICROS)
    return checks.evaluate(lines, [RowCount(1), NotNull("l_quantity"), CorruptRecords()])


def _lineitem_rules() -> list:
    return [
        RowCount(10),
        NotNull("l_quantity"),
        NotNull("l_shipdate"),
        UniqueKey(("l_orderkey", "l_linenumber")),
        UniqueKey(("l_partkey", "l_suppkey")),
        Fresh("l_shipdate", 60, AS_OF),
    ]


def check_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.evaluate(load(spark, sf_dir, "lineitem"), _lineitem_rules())


def check_suite_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.evaluate(load(spark, sf_dir, "lineitem"), _lineitem_rules(), one_pass=True)


def suite_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.overall(check_suite(spark, sf_dir))


def failed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.with_line(checks.failures(check_suite(spark, sf_dir))).select("line")


def failure_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a failing validator raises, line by line."""
    message = ""
    try:
        Validator(load(spark, sf_dir, "lineitem")).add(*_lineitem_rules()).raise_if_failed()
    except checks.QualityError as failure:
        message = str(failure)
    return constant_rows(spark, list(enumerate(message.splitlines())), "place int, line string")


def _complaints(spark: SparkSession, expected: dict[str, Callable[[], None]]) -> DataFrame:
    """What each expectation raises; null where it holds."""
    rows = []
    for name, expectation in expected.items():
        try:
            expectation()
            rows.append((name, None))
        except checks.QualityError as failure:
            rows.append((name, str(failure)))
    return constant_rows(spark, rows, "column_name string, complaint string")


def expect_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    expect = checks.Expectations(graded_documents(spark, sf_dir)).expect_column_values_to_not_be_null
    return _complaints(spark, {c: functools.partial(expect, c) for c in ("doc_id", "quality")})


def expect_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    expect = checks.Expectations(load(spark, sf_dir, "orders")).expect_column_values_to_be_unique
    return _complaints(spark, {c: functools.partial(expect, c) for c in ("o_orderkey", "o_custkey")})


def rules_from_yaml(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = config.rules_from(config.load_quality_config(str(FINANCE_RULES)), AS_OF)
    return checks.evaluate(transactions(spark, sf_dir), rules)


def rules_from_yaml_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and freshness given as lists, for events."""
    rules = config.rules_from(config.load_quality_config(str(EVENT_RULES)), AS_OF)
    return checks.evaluate(events(spark, sf_dir), rules)


# Audit


def audit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = audit.audit_rows(check_suite(spark, sf_dir), "manufacturing", "silver", RUN_AT, "run-1")
    return rows.withColumn("run_timestamp", F.unix_micros("run_timestamp"))


def audit_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"{new_schema(spark)}.audit"
    results = checks.collect(check_primary_key_composite(spark, sf_dir))
    for day in range(2):
        at = RUN_AT + dt.timedelta(days=day)
        audit.persist_quality_results(spark, results, table, "manufacturing", "bronze", at, f"run-{day}")
    return spark.table(table).withColumn("run_timestamp", F.unix_micros("run_timestamp"))


def _event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as an audit log: each is a check of some layer in the run of its day."""
    return events(spark, sf_dir).select(
        F.col("event_type").alias("domain"),
        F.concat(F.lit("layer_"), F.expr("user_id % 40")).alias("layer"),
        F.lit("value_in_range").alias("check_name"),
        (F.col("value") < 75).alias("passed"),
        F.col("ts").cast("date").cast("timestamp_ntz").alias("run_timestamp"),
    )


def audit_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.latest_runs(_event_log(spark, sf_dir))


# Schema drift


def _drift(spark: SparkSession, sf_dir: str) -> drift.SchemaDrift:
    """Line items as another system wrote them: one column renamed, types inferred."""
    target = load(spark, sf_dir, "lineitem")
    path = as_json(target.transform(t.rename("l_tax", "l_levy")))
    return drift.SchemaDrift(files.json(spark, path).schema, target.schema)


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.change_rows(spark, _drift(spark, sf_dir).changes())


def schema_drift_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same line items within orders: every change is found inside the array of structs."""
    target = load(spark, sf_dir, "lineitem")
    within = lambda df: df.select("l_orderkey", F.array(F.struct(*df.columns)).alias("lines"))
    path = as_json(target.transform(t.rename("l_tax", "l_levy")).transform(within))
    found = drift.SchemaDrift(files.json(spark, path).schema, target.transform(within).schema)
    return drift.change_rows(spark, found.nested())


def schema_has_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of an inferred and of a declared schema over the same lines."""
    source = events(spark, sf_dir)
    path = as_json(source)
    read = {"inferred": files.json(spark, path), "declared": files.json(spark, path, source.schema, **MICROS)}
    rows = [(form, drift.SchemaDrift(df.schema, source.schema).has_drift()) for form, df in read.items()]
    return constant_rows(spark, rows, "form string, has_drift boolean")


def evolution_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    policy = drift.EvolutionPolicy(["l_levy"], {"l_linenumber": ["bigint", "int"]})
    return drift.change_rows(spark, policy.violations(_drift(spark, sf_dir)))


QUERIES = {
    f.__name__: f
    for f in (
        scan_parquet,
        scan_csv,
        scan_csv_inferred,
        scan_json,
        scan_json_inferred,
        scan_catalog,
        catalog_schema,
        append_twice,
        append_evolved,
        replace_twice,
        replace_guarded,
        select_column,
        keep_positive,
        keep_not_null,
        keep_null,
        grouped_sum,
        grouped_count,
        exact_sums,
        global_measures,
        manufacturing_bronze,
        manufacturing_silver,
        manufacturing_gold,
        finance_bronze,
        finance_silver,
        finance_gold,
        sbe_bronze,
        sbe_silver,
        sbe_gold,
        manufacturing_run,
        finance_run,
        sbe_run,
        manufacturing_run_audit,
        finance_run_audit,
        sbe_run_audit,
        finance_batches,
        sbe_two_days_audit,
        sbe_quarantine,
        gate_after_failed_run,
        gate_after_killed_run,
        finance_new_keys_audit,
        finance_incremental,
        sbe_incremental,
        check_row_count,
        check_row_count_between,
        check_not_null,
        check_primary_key,
        check_primary_key_composite,
        check_primary_key_with_nulls,
        check_primary_key_text,
        check_primary_key_hashed,
        check_freshness,
        check_corrupt_records,
        check_corrupt_records_csv,
        check_suite,
        check_suite_one_pass,
        suite_verdict,
        failed_lines,
        failure_message,
        expect_not_null,
        expect_unique,
        rules_from_yaml,
        rules_from_yaml_lists,
        audit_rows,
        audit_append,
        audit_gate,
        schema_drift,
        schema_drift_nested,
        schema_has_drift,
        evolution_violations,
    )
}
