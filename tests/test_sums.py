"""Sums of doubles against fractions."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from oreworks.functions import transforms as t


def nearest(values):
    """The double nearest to the sum of the decimal numbers that the values are written as."""
    return float(sum(Fraction(repr(v)) for v in values))


def sums(spark, groups, parts=5, step=None):
    rows = [(k, v) for k, values in groups.items() for v in values]
    random.Random(len(rows)).shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v double").repartition(parts)
    return {r.k: r.s for r in df.transform(step or t.exact_total("v", "k", "s")).collect()}


def test_small_amounts_do_not_vanish(spark):
    df = spark.range(1_000_000).select(F.lit(1).alias("k"), F.lit(4e-7).alias("v"))
    assert df.transform(t.exact_total("v", "k", "s")).first().s == 0.4


def groups():
    draw = random.Random(7)
    return {
        "cents": [draw.randrange(1, 10**9) / 100 for _ in range(500)],
        "near": [draw.choice((1, -1)) * draw.random() * 10.0 ** draw.randint(-9, 12) for _ in range(400)],
        "wide": [draw.choice((1, -1)) * draw.random() * 10.0 ** draw.randint(-22, 23) for _ in range(400)],
        "negative": [-1e15, 0.1, 0.2, -7e-12],
        "edges": [0.001, 0.0009999999999999998, 9999999.999999998, 1e7, 1.0, 0.9999999999999999, -0.001, -1e7],
        "borders": [1e-24, 1e-12, 9.999999999999999e-13, 1e12, 999999999999.9999, 9.999999999999999e23, -1e-24],
        "cancel": [1e22, 1e-7, -1e22, 3e-20, 5e-23],
        "zero": [0.0, -0.0],
        "opposite": [12345.678, -12345.678],
        "one": [123.456],
        "rates": [0.05] * 60 + [0.07] * 3,
    }


@pytest.mark.parametrize("step", [t.exact_total, t.any_total])
def test_sums_of_mixed_sizes_equal_fractions(spark, step):
    found = sums(spark, groups(), step=step("v", "k", "s"))
    for key, values in groups().items():
        assert found[key] == nearest(values), key
    assert found == sums(spark, groups(), parts=1, step=step("v", "k", "s"))


def test_sums_of_any_sizes_equal_fractions(spark):
    draw = random.Random(8)
    extreme = {
        "mixed": [draw.choice((1, -1)) * draw.random() * 10.0 ** draw.randint(-320, 300) for _ in range(400)],
        "cancel": [1e22, 1e-7, -1e22, 3e-300, 5e-324],
        "largest": [1.7976931348623157e308, -1.7976931348623157e308, 2.5],
        "tiny": [5e-324] * 7,
    }
    found = sums(spark, extreme, step=t.any_total("v", "k", "s"))
    for key, values in extreme.items():
        assert found[key] == nearest(values), key
    # Without it sizes that no decimal holds are doubles, and the rest of their group stays exact.
    assert sums(spark, {"a": [1e30, 0.1, 0.2, -1e30], "b": [1e-30, 0.25]}) == {"a": 0.3, "b": 0.25}


def test_parts_merge_to_the_whole(spark):
    draw, step = random.Random(3), t.exact_total("v", "k", "s")
    rows = [(draw.choice("abc"), draw.choice((draw.random() * 1e9, draw.random(), draw.gauss(0, 1e-12), None))) for _ in range(900)]
    whole = spark.createDataFrame(rows, "k string, v double")
    parts = [spark.createDataFrame(rows[i::4], "k string, v double").transform(step.partial) for i in range(4)]
    merged = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).transform(step.merge)
    assert {tuple(r) for r in merged.collect()} == {tuple(r) for r in whole.transform(step).collect()}
    for kind in ("int", "decimal(12,2)"):
        ints = whole.select("k", F.col("v").cast("decimal(20,2)").cast(kind).alias("v"))
        both = ints.transform(step.partial).unionByName(ints.transform(step.partial)).transform(step.merge)
        assert both.schema["s"].dataType == ints.transform(step).schema["s"].dataType
        assert {r.k: r.s for r in both.collect()} == {r.k: 2 * r.s for r in ints.transform(step).collect()}
    counts = t.row_counts("k", "n")
    both = whole.transform(counts.partial).unionByName(whole.transform(counts.partial)).transform(counts.merge)
    assert {r.k: r.n for r in both.collect()} == {r.k: 2 * r.n for r in whole.transform(counts).collect()}


@pytest.mark.parametrize("step", [t.exact_total, t.any_total])
def test_values_that_are_no_numbers(spark, step):
    inf, nan = math.inf, math.nan
    found = sums(spark, step=step("v", "k", "s"), groups={"nan": [1.0, nan], "inf": [1.0, inf, 2.0], "minus": [-inf, 5.0], "both": [inf, -inf], "null": [None, None], "some": [None, 2.5], None: [1.5, 2.5]})
    assert math.isnan(found["nan"]) and math.isnan(found["both"])
    assert (found["inf"], found["minus"], found["null"], found["some"], found[None]) == (inf, -inf, None, 2.5, 4.0)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sums_do_not_hang_on_the_sessions_casts(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert sums(spark, {"a": [1e-20, 1e20, 0.25], "z": [0.0], "t": [4e-9]}) == {"a": nearest([1e-20, 1e20, 0.25]), "z": 0.0, "t": 4e-9}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_floats_are_what_they_are_written_as(spark):
    df = spark.createDataFrame([("a", 0.1), ("a", 0.2), ("a", 3e10)], "k string, v float")
    assert df.where("v < 1").transform(t.exact_total("v", "k", "s")).first().s == pytest.approx(0.3, abs=0)


def test_a_hot_group_is_combined_before_the_shuffle(spark):
    df = spark.range(0, 3000, 1, 8).select(F.lit("a").alias("k"), (F.col("id") / 7).alias("v"))
    plan = df.repartition(8).transform(t.exact_total("v", "k", "s"))._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum(CASE" in plan and plan.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan and "SortAggregate" not in plan and "collect" not in plan
