import datetime as dt

import pytest

from oreworks import CheckResult, CorruptRecords, Expectations, Fresh, Freshness, NotNull, QualityError
from oreworks import RowCount, UniqueKey, Validator, evaluate
from oreworks.operators import checks
from oreworks.sources import files

UTC = dt.timezone.utc


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def outcome(df, *rules, one_pass=False):
    return [(r.passed, r.details) for r in checks.collect(evaluate(df, rules, one_pass))]


@pytest.mark.parametrize("one_pass", [False, True])
@pytest.mark.parametrize(
    "rows, schema, columns, expected",
    [
        ([("a",), (None,)], "k string", ("k",), (True, "total=2, distinct=2")),
        ([("a",), (None,), (None,)], "k string", ("k",), (False, "total=3, distinct=2")),
        ([("a", None), ("b", None)], "k string, l string", ("k", "l"), (True, "total=2, distinct=2")),
        ([("a", None), ("a", None)], "k string, l string", ("k", "l"), (False, "total=2, distinct=1")),
        ([(None, None), ("a", "b")], "k string, l string", ("k", "l"), (True, "total=2, distinct=2")),
        ([(0.0,), (-0.0,)], "k double", ("k",), (False, "total=2, distinct=1")),
        ([(float("nan"),), (float("nan"),)], "k double", ("k",), (False, "total=2, distinct=1")),
        ([], "k string", ("k",), (True, "total=0, distinct=0")),
    ],
)
def test_key(spark, rows, schema, columns, expected, one_pass):
    assert outcome(frame(spark, rows, schema), UniqueKey(columns), one_pass=one_pass) == [expected]


def test_key_by_digest_counts_as_without(spark):
    rows = [("a", "b", 1), ("ab", "", 1), (None, "", 1), ("", None, 1), ("a", "b", 1)]
    df = frame(spark, rows, "k string, l string, n int")
    plain, digest = outcome(df, UniqueKey(("k", "l", "n")), UniqueKey(("k", "l", "n"), digest=True))
    assert plain == digest == (False, "total=5, distinct=4")


def test_row_count(spark):
    empty = frame(spark, [], "a int")
    two = frame(spark, [(1,), (None,)], "a int")
    assert outcome(empty, RowCount()) == [(False, "rows=0, min_required=1")]
    least = outcome(two, RowCount(2), RowCount(3))
    assert least == [(True, "rows=2, min_required=2"), (False, "rows=2, min_required=3")]
    between = outcome(two, RowCount(2, 2), RowCount(0, 1))
    assert between == [
        (True, "rows=2, min_required=2, max_allowed=2"),
        (False, "rows=2, min_required=0, max_allowed=1"),
    ]


def test_not_null(spark):
    df = frame(spark, [(1, float("nan")), (None, None)], "a int, b double")
    assert outcome(df, NotNull("a"), NotNull("b")) == [(False, "nulls=1"), (False, "nulls=1")]
    assert outcome(frame(spark, [], "a int"), NotNull("a")) == [(True, "nulls=0")]


def test_column_with_a_dot_in_its_name(spark):
    df = frame(spark, [(1,), (None,), (None,)], "`a.b` int")
    assert outcome(df, NotNull("`a.b`"), UniqueKey(("`a.b`",))) == [(False, "nulls=2"), (False, "total=3, distinct=2")]


def test_nested_column(spark):
    df = spark.sql("SELECT named_struct('x', 1) AS s UNION ALL SELECT named_struct('x', CAST(NULL AS INT))")
    assert outcome(df, NotNull("s.x"), UniqueKey(("s.x",))) == [(False, "nulls=1"), (True, "total=2, distinct=2")]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata", "America/New_York"])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_freshness_does_not_depend_on_the_session_zone(spark, zone, kind):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        text = {"timestamp": "TIMESTAMP '2024-03-10 00:00:00Z'", "timestamp_ntz": "TIMESTAMP_NTZ '2024-03-10 00:00:00'"}
        df = spark.sql(f"SELECT {text.get(kind, 'DATE ' + repr('2024-03-10'))} AS ts")
        at = dt.datetime(2024, 3, 10, 0, 10)
        details = "delay_minutes=10.000000, max_delay_minutes="
        expected = [(True, details + "10"), (False, details + "9")]
        assert outcome(df, Fresh("ts", 10, at), Fresh("ts", 9, at)) == expected
        assert outcome(df, Fresh("ts", 10, at.replace(tzinfo=UTC)), Fresh("ts", 9, at)) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_freshness_edges(spark):
    at = dt.datetime(2024, 1, 1)
    assert outcome(frame(spark, [], "ts timestamp"), Fresh("ts", 5, at)) == [(False, "no rows")]
    assert outcome(frame(spark, [(None,)], "ts timestamp"), Fresh("ts", 5, at)) == [(False, "no values")]
    future = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 00:05:00' AS ts")
    assert outcome(future, Fresh("ts", 0, at)) == [(True, "delay_minutes=-5.000000, max_delay_minutes=0")]
    with pytest.raises(TypeError, match="ts is string"):
        evaluate(frame(spark, [("x",)], "ts string"), [Fresh("ts", 1)])


def test_freshness_against_the_clock(spark):
    now = spark.sql("SELECT current_timestamp() AS ts")
    old = spark.sql("SELECT current_timestamp() - INTERVAL 3 MINUTES AS ts")
    assert outcome(now, Fresh("ts", 1))[0][0] and not outcome(old, Fresh("ts", 2))[0][0]
    Freshness(now, "ts").check_freshness_minutes(1)
    with pytest.raises(QualityError, match="Freshness SLA breached: delay_minutes=3"):
        Freshness(old, "ts").check_freshness_minutes(2)


def test_results_keep_call_order_and_repeats(spark):
    df = frame(spark, [(1, "x"), (2, None)], "id int, name string")
    validator = Validator(df).check_not_null("name").check_row_count(1).check_not_null("name").check_primary_key("id")
    names = [r.check_name for r in validator.get_results()]
    assert names == ["not_null_name", "row_count", "not_null_name", "pk_unique_id"]
    assert [str(r) for r in validator.get_results()] == [
        "not_null_name: FAIL (nulls=1)",
        "row_count: PASS (rows=2, min_required=1)",
        "not_null_name: FAIL (nulls=1)",
        "pk_unique_id: PASS (total=2, distinct=2)",
    ]
    lines = checks.with_line(validator.results()).orderBy("ordinal").collect()
    assert [r.line for r in lines] == [str(r) for r in validator.get_results()]


def test_verdict_and_raise(spark):
    df = frame(spark, [(1, None)], "id int, name string")
    nothing = Validator(df)
    assert nothing.validate() and nothing.get_results() == []
    nothing.raise_if_failed()
    assert checks.overall(nothing.results()).first().passed
    validator = Validator(df).check_row_count(2).check_not_null("name").check_primary_key("id")
    assert not validator.validate()
    assert not checks.overall(validator.results()).first().passed
    with pytest.raises(ValueError) as raised:
        validator.raise_if_failed()
    assert str(raised.value) == (
        "Data Quality Checks Failed:\nrow_count: FAIL (rows=1, min_required=2)\nnot_null_name: FAIL (nulls=1)"
    )
    assert validator.add(RowCount(1)).get_results()[-1] == CheckResult("row_count", True, "rows=1, min_required=1")


def test_expectations(spark):
    df = frame(spark, [(1, None), (1, "x")], "id int, name string")
    expect = Expectations(df)
    expect.expect_column_values_to_not_be_null("id")
    expect.expect_column_values_to_be_unique("name")
    expect.expect_table_row_count_to_be_between(2, 2)
    with pytest.raises(ValueError, match="name has nulls"):
        expect.expect_column_values_to_not_be_null("name")
    with pytest.raises(ValueError, match="id not unique"):
        expect.expect_column_values_to_be_unique("id")
    with pytest.raises(ValueError, match="rows=2"):
        expect.expect_table_row_count_to_be_between(3, 9)


def test_corrupt_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"event_type":"x"}\n{bad\n{"event_type":null}\n')
    df = files.json(spark, str(tmp_path))
    assert df.count() == 3
    assert df.filter("event_type is not null").count() == 1
    assert outcome(df, NotNull("event_type"), CorruptRecords(), CorruptRecords(1), CorruptRecords(None)) == [
        (False, "nulls=2"),
        (False, "corrupt=1"),
        (True, "corrupt=1"),
        (True, "corrupt=1"),
    ]


def hot_key(spark):
    """A third of all rows share one key; the rest are all different."""
    return spark.sql(
        "SELECT CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS k, CAST(id % 7 AS STRING) AS s FROM range(0, 60000, 1, 8)"
    )


@pytest.mark.parametrize("one_pass", [False, True])
def test_hot_key_is_counted_whole(spark, one_pass):
    found = outcome(hot_key(spark), UniqueKey(("k",)), UniqueKey(("s",)), UniqueKey(("k", "s")), one_pass=one_pass)
    pairs = {(-1 if i % 3 == 0 else i, i % 7) for i in range(60000)}
    assert found == [
        (False, "total=60000, distinct=40001"),
        (False, "total=60000, distinct=7"),
        (False, f"total=60000, distinct={len(pairs)}"),
    ]
