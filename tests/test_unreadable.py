"""Lines that do not parse: counted on every path, and never drift."""

import math

import pytest

from oreworks import CorruptRecords, NotNull, RowCount, evaluate
from oreworks.functions import transforms as t
from oreworks.plans.domains import manufacturing, sbe
from oreworks.plans.jobs import run_domain
from oreworks.sources import files

LINES = '{"event_type": "a", "value": 1.5}\n{"event_type": "b", "value": "much"}\n{"event_type": "c", "value": 2}\n'


@pytest.mark.parametrize("others", [[], [RowCount(1)], [NotNull("event_type")], [NotNull("event_type"), NotNull("value")]])
def test_the_count_does_not_depend_on_other_rules(spark, tmp_path, others):
    (tmp_path / "a.json").write_text(LINES)
    df = files.with_unreadable(files.json)(spark, str(tmp_path), "event_type string, value double")
    found = {r.check_name: r for r in evaluate(df, [*others, CorruptRecords()]).collect()}
    assert found["corrupt_records"].details == "corrupt=1" and not found["corrupt_records"].passed


def counted(spark, jobs, audit):
    log = run_domain(spark, jobs, audit)
    return [(r.layer, r.passed, r.details) for r in log.filter("check_name = 'corrupt_records'").collect()]


@pytest.mark.parametrize("days", [("clean", "dirty"), ("dirty", "clean")])
@pytest.mark.parametrize("declared", [None, "event_type string, value double"])
def test_a_dirty_day_is_no_drift(spark, schema, tmp_path, days, declared):
    lines = {"clean": '{"event_type": "a", "value": 1.5}\n', "dirty": '{"event_type": "a", "value": 2.5}\n{bad\n'}
    for day in days:
        (tmp_path / day).mkdir()
        (tmp_path / day / "a.json").write_text(lines[day])
        jobs = sbe(sbe.raw_files(str(tmp_path / day), declared), None, schema)
        assert counted(spark, jobs, f"{schema}.audit") == [("bronze", True, f"corrupt={int(day == 'dirty')}")]
    assert spark.table(f"{schema}.bronze_events").columns == ["event_type", "value"]
    assert [tuple(r) for r in spark.table(f"{schema}.gold_event_metrics").collect()] == [("a", 2)]


def test_csv_of_the_wrong_type_is_counted(spark, schema, tmp_path):
    (tmp_path / "a.csv").write_text("plant_id,quantity,prod_dt\np1,5,2024-01-05\np2,abc,2024-01-06\n")
    raw = manufacturing.raw_files(str(tmp_path), "plant_id string, quantity int, prod_dt date")
    assert counted(spark, manufacturing(raw, None, schema), f"{schema}.audit") == [("bronze", True, "corrupt=1")]


def test_sums_of_doubles_do_not_depend_on_their_order(spark):
    rows = [("x", 0.1), ("x", 0.1), ("x", 0.1), ("y", float("nan")), ("y", 1.0), ("z", None), ("w", 1e300), ("w", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(3)
    found = {r.k: r.s for r in df.transform(t.exact_total("v", "k", "s")).collect()}
    assert found["x"] == 0.3 and math.isnan(found["y"]) and found["z"] is None and found["w"] == 1e300
    whole = spark.createDataFrame([("x", 1)], "k string, v int").transform(t.exact_total("v", "k", "s"))
    assert whole.dtypes[1] == ("s", "bigint")
