"""Runs that end half way: what is published, what the gate says, and what was read."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from oreworks import CheckResult, NotNull, RowCount, UniqueKey, gate_is_open, persist_quality_results
from oreworks.operators import audit, checks, rules
from oreworks.plans import jobs
from oreworks.plans.jobs import Job, run_domain
from oreworks.sinks import tables


class Killed(BaseException):
    """Like a driver that is gone: nothing catches it."""


def job(schema, rows, layer="silver", **kept):
    return Job("d", layer, "t", lambda s: s.range(rows), rules=(RowCount(1),), schema=schema, **kept)


@pytest.mark.parametrize(("layer", "kept"), [("silver", {}), ("gold", {"fmt": "csv"}), ("bronze", {"batches": True}), ("bronze", {})])
@pytest.mark.parametrize("after", [False, True])
def test_a_driver_that_dies_around_publishing_leaves_the_gate_closed(spark, schema, monkeypatch, layer, kept, after):
    log = f"{schema}.audit"
    run_domain(spark, [job(schema, 3, layer, **kept)], log)
    assert gate_is_open(spark, log, "d", layer)

    def dying(publish):
        def publish_and_die(*given, **more):
            if after:
                publish(*given, **more)
            raise Killed

        return publish_and_die

    def gone(*_):
        raise Killed

    with monkeypatch.context() as broken:
        for owner, name in ((tables.Draft, "publish"), (tables.Partition, "publish"), (Job, "write")):
            if owner is tables.Partition:
                real = tables.Partition.publish
                # The audit's own partitions are published as ever.
                broken.setattr(owner, name, lambda self: dying(real)(self) if "audit" not in self.table else real(self))
            else:
                broken.setattr(owner, name, dying(getattr(owner, name)))
        with pytest.raises(Killed):
            run_domain(spark, [job(schema, 4, layer, **kept)], log)
    results = spark.table(log).groupBy("run_timestamp").agg(F.every("passed").alias("passed")).collect()
    assert [r.passed for r in results] == [True, True]  # all checks passed, and still
    assert not gate_is_open(spark, log, "d", layer)
    run_domain(spark, [job(schema, 5, layer, **kept)], log)
    assert gate_is_open(spark, log, "d", layer)


def test_a_commit_counts_in_tables_that_are_appended_to(spark, schema):
    log, at = f"{schema}.audit", audit.dt.datetime(2024, 1, 1, tzinfo=audit.dt.timezone.utc)
    columns = "domain string, layer string, check_name string, passed boolean, details string, run_timestamp timestamp, run_id string"
    spark.createDataFrame([], columns).write.saveAsTable(log)
    persist_quality_results(spark, [CheckResult("row_count", True)], log, "d", "silver", at, f"r.t{audit.INTENT}")
    assert not gate_is_open(spark, log, "d", "silver")
    spark.createDataFrame([], "table_name string, run_timestamp timestamp, domain string, layer string, run_id string").write.saveAsTable(f"{log}_commits")
    for _ in range(2):
        audit.record_commit(spark, log, "d", "silver", "s.t", at, f"r.t{audit.INTENT}")
    assert gate_is_open(spark, log, "d", "silver")
    # Of another layer it says nothing.
    persist_quality_results(spark, [CheckResult("row_count", True)], log, "d", "gold", at, f"r.t{audit.INTENT}")
    assert not gate_is_open(spark, log, "d", "gold")


def test_one_of_two_jobs_of_a_run_is_not_enough(spark, schema, monkeypatch):
    log = f"{schema}.audit"
    two = [job(schema, 3), dataclasses.replace(job(schema, 3), name="u")]
    publish = tables.Draft.publish

    def die_at_second(self):
        if self.table.endswith("_u"):
            raise Killed
        publish(self)

    monkeypatch.setattr(tables.Draft, "publish", die_at_second)
    with pytest.raises(Killed):
        run_domain(spark, two, log)
    assert not gate_is_open(spark, log, "d", "silver")


def test_upkeep_that_fails_after_publishing_fails_no_run(spark, schema, monkeypatch, caplog):
    log = f"{schema}.audit"
    run_domain(spark, [job(schema, 3)], log)
    monkeypatch.setattr(tables, "purge", lambda *_: 1 / 0)
    run_domain(spark, [job(schema, 7)], log)
    assert spark.table(job(schema, 0).table).count() == 7
    assert gate_is_open(spark, log, "d", "silver")
    assert "is published; its upkeep failed" in caplog.text and ".rows-" in caplog.text


def test_a_batch_written_again_leaves_readers_their_files(spark, schema):
    table = f"{schema}.t"
    tables.ready_for_batches(spark.range(3), table)
    tables.add_partition(spark.range(3), table, {"ingest_batch": "a"})
    reader = spark.table(table)
    assert len(reader.inputFiles()) > 0  # planned
    old = spark.read.parquet(*reader.inputFiles())
    tables.add_partition(spark.range(5), table, {"ingest_batch": "a"})
    assert old.count() == 3 and spark.table(table).count() == 5


def test_plain_rules_are_measured_while_rows_are_written(spark, schema, monkeypatch):
    """After the write only the columns of the key are read."""
    scans = []

    def seen(df, found, one_pass=False, known=None):
        result = checks.evaluate(df, found, one_pass, known)
        scans.append([line for line in result._jdf.queryExecution().executedPlan().toString().splitlines() if "ReadSchema" in line])
        return result

    monkeypatch.setattr(jobs, "evaluate", seen)
    read = lambda s: s.range(1000).selectExpr("id", "id % 7 AS x", "'text' AS note", "if(id < 5, null, id) AS gap")
    wanted = (RowCount(1), NotNull("x"), NotNull("note"), UniqueKey(("id",)))
    for layer, batches in (("silver", False), ("bronze", True)):
        one = Job("d", layer, "t", read, rules=wanted, schema=schema, batches=batches)
        log = run_domain(spark, [one], f"{schema}.audit")
        assert {(r.check_name, r.details) for r in log.collect() if r.check_name != "schema_drift"} == {
            ("row_count", "rows=1000, min_required=1"),
            ("not_null_x", "nulls=0"),
            ("not_null_note", "nulls=0"),
            ("pk_unique_id", "total=1000, distinct=1000"),
        }
        (lines,) = scans
        assert len(lines) == 1 and "ReadSchema: struct<id:bigint>" in lines[0]
        scans.clear()
        # Without a key nothing is read at all, and failures are found all the same.
        bad = dataclasses.replace(one, rules=(RowCount(1), NotNull("gap")))
        with pytest.raises(checks.QualityError, match="nulls=5"):
            run_domain(spark, [bad], f"{schema}.audit")
        assert scans == [[]]
        scans.clear()


def test_no_rows_are_measured_as_none(spark, schema):
    for rows in (lambda s: s.range(0), lambda s: s.createDataFrame([], "id long"), lambda s: s.range(9).where("id > 10")):
        with pytest.raises(checks.QualityError, match=r"rows=0, min_required=1"):
            run_domain(spark, [Job("d", "silver", "t", rows, rules=(RowCount(1), NotNull("id")), schema=schema)], f"{schema}.audit")


@pytest.mark.parametrize("collide", [False, True])
def test_hashed_keys_are_exact(spark, monkeypatch, collide):
    if collide:
        monkeypatch.setattr(rules, "key_hash", lambda columns: F.pmod(F.length(F.coalesce(F.col(columns[0]), F.lit(""))), F.lit(2)).cast("long"))
    rows = [("a", 1), ("a", 2), ("bb", 1), (None, 1), (None, 1), ("ccc", None), ("ccc", None), ("d", 1), ("", None)]
    df = spark.createDataFrame(rows, "x string, y int")
    for columns in (("x",), ("x", "y")):
        plain, hashed = (checks.collect(checks.evaluate(df, [UniqueKey(columns, hashed=h)]))[0] for h in (False, True))
        assert (plain.passed, plain.details) == (hashed.passed, hashed.details) and not plain.passed
    unique = spark.range(500).selectExpr("concat('k', id) AS x")
    (found,) = checks.collect(checks.evaluate(unique, [UniqueKey(("x",), hashed=True)]))
    assert (found.passed, found.details) == (True, "total=500, distinct=500")
    assert checks.collect(checks.evaluate(unique.limit(0), [UniqueKey(("x",), hashed=True)]))[0].passed
    monkeypatch.setattr(rules, "BROADCAST_HASHES", 0)
    (found,) = checks.collect(checks.evaluate(df, [UniqueKey(("x",), hashed=True)]))
    assert found.details == "total=9, distinct=6"


def test_names_are_taken_literally(spark, schema):
    """The session catalog takes letters, digits and _ only, but those in any order."""
    table, parts = f"{schema}.2024_select", f"{schema}.1e3"
    for rows in (2, 3):
        tables.replace(spark.range(rows), table)
    tables.append(spark.range(1), table)
    tables.create_partitioned(spark, parts, spark.range(1).withColumn("k", F.lit("")).schema, ["k"])
    tables.add_partition(spark.range(4), parts, {"k": "x"})
    assert spark.sql(f"SELECT * FROM {tables.named(table)}").count() == 4
    assert spark.table(tables.named(parts)).count() == 4
    log = f"{schema}.2024_log"
    run_domain(spark, [dataclasses.replace(job(schema, 3), name="1d")], log)
    assert gate_is_open(spark, log, "d", "silver")
