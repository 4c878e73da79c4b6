import math

import pytest

from oreworks.functions import transforms as t


def test_keep_positive_drops_null_and_keeps_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (-1.0,), (0.0,)], "x double")
    kept = [r.x for r in df.transform(t.keep_positive("x")).collect()]
    assert len(kept) == 2 and 1.0 in kept and any(math.isnan(x) for x in kept)


def test_null_filters_split_the_rows(spark):
    df = spark.createDataFrame([("a",), (None,), ("",)], "x string")
    assert {r.x for r in df.transform(t.keep_not_null("x")).collect()} == {"a", ""}
    assert [r.x for r in df.transform(t.keep_null("x")).collect()] == [None]


def test_total_keeps_null_keys_and_null_sums(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), (None, 3), (None, None)], "k string, v int")
    found = {r.k: r.s for r in df.transform(t.total("v", "k", "s")).collect()}
    assert found == {"a": 1, "b": None, None: 3}


def test_total_of_decimals_is_exact_and_overflow_raises(spark):
    df = spark.range(0, 1000).selectExpr("1 AS k", "CAST(0.1 AS DECIMAL(18,2)) AS v")
    assert str(df.transform(t.total("v", "k", "s")).first().s) == "100.00"
    big = spark.sql("SELECT 1 AS k, 9223372036854775807 AS v UNION ALL SELECT 1, 1")
    with pytest.raises(Exception, match="overflow|OVERFLOW"):
        big.transform(t.total("v", "k", "s")).collect()


def test_row_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert {r.k: r.n for r in df.transform(t.row_counts("k", "n")).collect()} == {"a": 2, None: 1}


def test_rename_refuses_a_missing_column(spark):
    df = spark.createDataFrame([(1,)], "prod_dt int")
    assert df.transform(t.rename("prod_dt", "production_date")).columns == ["production_date"]
    with pytest.raises(ValueError, match="no column 'other'"):
        df.transform(t.rename("other", "x"))


def test_pick_same_and_then(spark):
    df = spark.createDataFrame([(1, 2.345)], "a int, b double")
    assert df.transform(t.pick("b")).columns == ["b"]
    assert df.transform(t.same).columns == ["a", "b"]
    both = df.transform(t.then(t.as_decimal("b"), t.pick("b")))
    assert both.dtypes == [("b", "decimal(18,2)")] and str(both.first().b) == "2.35"


def test_a_group_with_a_third_of_the_rows_is_whole_and_shuffled_as_partial_rows(spark):
    df = spark.sql("SELECT IF(id % 3 = 0, -1, id % 100) AS k, id AS v FROM range(0, 30000, 1, 8)")
    totals = {}
    for i in range(30000):
        key = -1 if i % 3 == 0 else i % 100
        totals.setdefault(key, []).append(i)
    assert {r.k: r.s for r in df.transform(t.total("v", "k", "s")).collect()} == {k: sum(v) for k, v in totals.items()}
    assert {r.k: r.n for r in df.transform(t.row_counts("k", "n")).collect()} == {k: len(v) for k, v in totals.items()}
    before_shuffle = df.repartition(8).transform(t.total("v", "k", "s"))._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum(v" in before_shuffle
