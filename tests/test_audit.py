import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from oreworks import CheckResult, Validator, audit_rows, gate_is_open, latest_runs, persist_quality_results

GOOD, BAD = CheckResult("row_count", True, "rows=1"), CheckResult("not_null_x", False, "nulls=1")
DAY = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


@pytest.fixture
def table(schema):
    return f"{schema}.audit"


def persist(spark, table, results, layer, days):
    persist_quality_results(spark, results, table, "finance", layer, DAY + dt.timedelta(days=days), f"run-{days}")


def test_rows_carry_the_run(spark, table):
    df = spark.createDataFrame([(None,)], "x int")
    validator = Validator(df).check_row_count(1).check_not_null("x")
    persist_quality_results(spark, validator.get_results(), table, "finance", "silver")
    persist_quality_results(spark, validator.results(), table, "finance", "silver")
    log = spark.table(table)
    assert log.columns == ["check_name", "passed", "details", "run_timestamp", "domain", "layer", "run_id"]
    assert dict(log.dtypes)["run_timestamp"] == "timestamp"
    assert log.groupBy("run_id", "run_timestamp").count().collect()[0]["count"] == 2
    assert log.select("run_id").distinct().count() == 2
    assert {(r.check_name, r.passed) for r in log.collect()} == {("row_count", True), ("not_null_x", False)}


def test_naive_timestamp_is_utc(spark):
    df = spark.createDataFrame([("a", True, "")], "check_name string, passed boolean, details string")
    found = audit_rows(df, "d", "l", dt.datetime(2024, 1, 1)).select(F.unix_micros("run_timestamp")).first()[0]
    assert found == int(DAY.timestamp()) * 1_000_000


def test_nothing_to_persist(spark, table):
    persist_quality_results(spark, [], table, "finance", "silver")
    persist_quality_results(spark, [GOOD], table, "finance", "silver")
    assert spark.table(table).count() == 1


def test_gate_follows_the_latest_run(spark, table):
    assert not gate_is_open(spark, table, "finance", "silver")
    persist(spark, table, [GOOD, BAD], "silver", 0)
    persist(spark, table, [GOOD, GOOD], "silver", 1)
    persist(spark, table, [GOOD], "gold", 0)
    persist(spark, table, [BAD, GOOD], "gold", 1)
    assert gate_is_open(spark, table, "finance", "silver")
    assert not gate_is_open(spark, table, "finance", "gold")
    assert not gate_is_open(spark, table, "finance", "bronze")
    assert not gate_is_open(spark, table, "sbe", "silver")
    found = {r.layer: (r.run_timestamp, r.gate_open) for r in latest_runs(spark.table(table)).collect()}
    assert {layer: gate for layer, (_, gate) in found.items()} == {"silver": True, "gold": False}
    assert len({at for at, _ in found.values()}) == 1


def test_runs_of_the_same_instant_must_all_pass(spark, table):
    for run, results in (("a", [GOOD]), ("b", [BAD]), ("c", [GOOD])):
        persist_quality_results(spark, results, table, "finance", "silver", DAY, run)
    assert not gate_is_open(spark, table, "finance", "silver")


def test_applications_log_at_the_same_time(spark, table):
    def log(n):
        persist_quality_results(spark, [GOOD, BAD], table, f"domain {n % 3}", "silver", DAY, f"run/{n}")

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(log, range(12)))
    found = spark.table(table).groupBy("domain").count().collect()
    assert {r["domain"]: r["count"] for r in found} == {"domain 0": 8, "domain 1": 8, "domain 2": 8}


def test_a_run_recorded_again_is_there_once(spark, table):
    for results in ([GOOD], [GOOD, BAD]):
        persist_quality_results(spark, results, table, "finance's", "silver", DAY, "run=1")
    assert sorted(r.check_name for r in spark.table(table).collect()) == ["not_null_x", "row_count"]
    assert {(r.domain, r.run_id) for r in spark.table(table).collect()} == {("finance's", "run=1")}


def test_another_table_is_appended_to(spark, table):
    columns = "domain string, layer string, check_name string, passed boolean, details string, "
    spark.createDataFrame([], columns + "run_timestamp timestamp, run_id string").write.saveAsTable(table)
    for day in range(2):
        persist(spark, table, [GOOD], "silver", day)
    assert spark.table(table).count() == 2


def test_the_gate_reads_its_own_layer_only(spark, table):
    for layer in ("bronze", "silver"):
        persist(spark, table, [GOOD], layer, 0)
    log = spark.table(table).filter("domain = 'finance' AND layer = 'silver'")
    assert "PartitionFilters: [isnotnull(domain" in latest_runs(log)._jdf.queryExecution().executedPlan().toString()
    assert len(log.inputFiles()) >= 1 and log.count() == 1
