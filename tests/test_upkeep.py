"""The log over many runs, and lines kept apart."""

import datetime as dt

import pytest

from oreworks import CheckResult, CorruptRecords, NotNull, RowCount, gate_is_open, persist_quality_results
from oreworks.operators import audit, checks
from oreworks.plans.domains import sbe
from oreworks.plans.jobs import run_domain
from oreworks.sinks import derived, tables

DAY = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
GOOD = CheckResult("row_count", True, "rows=1")


def partitions(spark, table):
    return spark.sql(f"SHOW PARTITIONS {table}").count()


def test_a_log_of_many_runs_keeps_few_partitions_and_the_same_gates(spark, schema):
    log = f"{schema}.audit"
    failed = CheckResult("not_null_x", False, "nulls=1")
    for n in range(24):
        at, layer = DAY + dt.timedelta(hours=6 * n), ("bronze", "silver")[n % 2]
        run = f"run{n}.t{audit.INTENT}"
        # Two rows that are alike stay two.
        persist_quality_results(spark, [GOOD] * 2 + [failed] * (n % 5 == 0), log, "d's", layer, at, run)
        if n % 3:
            audit.record_commit(spark, log, "d's", layer, "s.t", at, run)
    persist_quality_results(spark, [failed], log, "other", "gold", DAY, "only")

    def told():
        rows = audit.history(spark, log).groupBy(*audit.RUN, "run_timestamp", "check_name", "passed", "details", "committed").count().collect()
        gates = {(r.domain, r.layer): (r.run_timestamp, r.gate_open) for r in audit.gates(spark, log).collect()}
        return sorted(map(repr, rows)), gates

    before = told()
    assert audit.archive_runs(spark, log, DAY + dt.timedelta(days=4)) == 16
    assert told() == before
    assert partitions(spark, log) == 9 and partitions(spark, audit.archive_of(log)) == 4
    # Again, and later: days gain what is new and keep what they held.
    assert audit.archive_runs(spark, log, DAY + dt.timedelta(days=4)) == 0
    assert audit.archive_runs(spark, log, DAY + dt.timedelta(days=400)) == 6
    assert told() == before
    assert partitions(spark, log) == 3 and partitions(spark, audit.archive_of(log)) == 6
    assert partitions(spark, audit.commits_of(log)) <= 3


def test_an_archiving_that_stops_half_way_loses_and_doubles_nothing(spark, schema, monkeypatch):
    log = f"{schema}.audit"
    for n in range(4):
        persist_quality_results(spark, [CheckResult("row_count", True)], log, "d", "silver", DAY + dt.timedelta(hours=n), f"run{n}")
    with monkeypatch.context() as broken:
        broken.setattr(audit.tables, "drop_partitions", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            audit.archive_runs(spark, log, DAY + dt.timedelta(days=1))
    assert audit.history(spark, log).count() == 4
    assert audit.archive_runs(spark, log, DAY + dt.timedelta(days=1)) == 3
    assert audit.history(spark, log).count() == 4
    assert partitions(spark, log) == 1 and gate_is_open(spark, log, "d", "silver")


def test_a_log_without_partitions_is_refused(spark, schema):
    spark.range(1).write.saveAsTable(f"{schema}.audit")
    with pytest.raises(ValueError, match="no partition for each run"):
        audit.archive_runs(spark, f"{schema}.audit", DAY)


LINES = '{"event_type":"x","value":1}\n{"event_type":"y","value":"much"}\n{bad\n{"event_type":null,"value":2}\n'


def feed(schema, tmp_path, text, rules=(RowCount(1),), **kept):
    (tmp_path / "in").mkdir(exist_ok=True)
    (tmp_path / "in" / "a.json").write_text(text)
    raw = sbe.raw_files(str(tmp_path / "in"), "event_type string, value int")
    return sbe(raw, {"bronze": rules}, schema, batches=True, quarantine=True, **kept)


def test_unreadable_lines_are_kept_apart_with_their_text(spark, schema, tmp_path):
    jobs = feed(schema, tmp_path, LINES, (RowCount(2, 2), CorruptRecords(2)))
    log = run_domain(spark, jobs, f"{schema}.audit")
    assert {r.check_name: r.details for r in log.where("layer = 'bronze'").collect()} == {
        "schema_drift": "",
        "row_count": "rows=2, min_required=2, max_allowed=2",
        "corrupt_records": "corrupt=2",
    }
    assert sorted(map(repr, spark.table(jobs[0].table).select("event_type", "value").collect())) == ["Row(event_type='x', value=1)", "Row(event_type=None, value=2)"]
    apart = spark.table(tables.quarantine_of(jobs[0].table))
    assert sorted(r._corrupt_record for r in apart.collect()) == ['{"event_type":"y","value":"much"}', "{bad"]
    assert [r.event_count for r in spark.table(jobs[2].table).collect()] == [1]
    assert {r.ingest_batch for r in apart.collect()} == set(derived.batches(spark, jobs[0].table))


def test_days_of_nothing_but_good_or_bad_lines(spark, schema, tmp_path):
    log = f"{schema}.audit"
    jobs = feed(schema, tmp_path, '{"event_type":"x","value":1}\n')
    run_domain(spark, jobs, log, ["bronze"])
    assert spark.table(tables.quarantine_of(jobs[0].table)).count() == 0
    jobs = feed(schema, tmp_path, "{bad\n", (CorruptRecords(9),), incremental=True)
    run_domain(spark, jobs, log, ["bronze", "gold"])
    assert spark.table(jobs[0].table).count() == 1 and spark.table(tables.quarantine_of(jobs[0].table)).count() == 1
    assert [tuple(r) for r in spark.table(jobs[2].table).collect()] == [("x", 1)]


def test_a_refused_batch_leaves_nothing_apart(spark, schema, tmp_path):
    jobs = feed(schema, tmp_path, LINES, (NotNull("event_type"), CorruptRecords(0)))
    with pytest.raises(checks.QualityError) as raised:
        run_domain(spark, jobs, f"{schema}.audit", ["bronze"])
    assert "corrupt=2" in str(raised.value) and "nulls=1" in str(raised.value)
    assert spark.table(jobs[0].table).count() == 0
    assert spark.table(tables.quarantine_of(jobs[0].table)).count() == 0


def test_quarantine_is_for_batches_of_text(spark, schema):
    with pytest.raises(ValueError, match="batches of text"):
        sbe(lambda s: s.range(1), schema=schema, quarantine=True)
