"""The shapes of the physical plans that decide whether a query holds at scale."""

import re

import pytest

from oreworks import evaluate
from oreworks.operators import checks
from oreworks.operators.rules import NotNull, RowCount, UniqueKey
from registered.inputs import load
from registered.queries import QUERIES, _lineitem_rules

PURE = [
    name
    for name in QUERIES
    if not name.startswith(("append", "replace", "audit_append")) and "run" not in name and not any(x in name for x in ("two_days", "incremental", "quarantine", "new_keys"))
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PURE)
def test_no_query_pairs_all_rows_or_sorts_groups_in_one_task(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Window", "ArrowEvalPython", "BatchEvalPython"):
        assert operator not in text
    assert "collect_list" not in text and "collect_set" not in text


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("finance_silver", "IsNotNull(o_totalprice), GreaterThan(o_totalprice,0.0)"),
        ("manufacturing_silver", "IsNotNull(l_quantity), GreaterThan(l_quantity,0.0)"),
        ("keep_positive", "IsNotNull(c_acctbal), GreaterThan(c_acctbal,0.0)"),
    ],
)
def test_filters_reach_the_scan(spark, sf_dir, name, pushed):
    assert f"PushedFilters: [{pushed}]" in plan(QUERIES[name](spark, sf_dir))


@pytest.mark.parametrize(
    "name, columns",
    [
        ("finance_gold", "o_custkey:bigint,o_totalprice:double"),
        ("manufacturing_gold", "l_suppkey:bigint,l_quantity:double"),
        ("sbe_gold", "event_type:string"),
        ("select_column", "l_extendedprice:double"),
        ("check_freshness", "ts:timestamp_ntz"),
    ],
)
def test_scans_read_only_what_is_asked(spark, sf_dir, name, columns):
    assert f"ReadSchema: struct<{columns}>" in plan(QUERIES[name](spark, sf_dir))


@pytest.mark.parametrize("name", ["finance_gold", "manufacturing_gold", "sbe_gold", "grouped_sum", "audit_gate"])
def test_groups_are_combined_before_the_shuffle(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "partial_" in text
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text


def test_plain_checks_shuffle_one_row_per_task(spark, sf_dir):
    text = plan(evaluate(load(spark, sf_dir, "lineitem"), [RowCount(), NotNull("l_quantity"), NotNull("l_tax")]))
    assert text.count("FileScan") == 1
    assert re.findall(r"Exchange (\w+)", text) == ["SinglePartition"]


def test_each_key_is_shuffled_alone(spark, sf_dir):
    text = plan(checks.measure(load(spark, sf_dir, "lineitem"), _lineitem_rules())[0])
    assert "Expand" not in text
    scans = re.findall(r"ReadSchema: (\S+)", text)
    assert scans == [
        "struct<l_quantity:double,l_shipdate:timestamp_ntz>",
        "struct<l_orderkey:bigint,l_linenumber:int>",
        "struct<l_partkey:bigint,l_suppkey:bigint>",
    ]
    keyed = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert len(keyed) == 2


def test_a_digest_key_shuffles_no_text(spark, sf_dir):
    text = plan(evaluate(load(spark, sf_dir, "documents"), [UniqueKey(("text",), digest=True)]))
    shuffled = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert shuffled and all("hashpartitioning(struct(k0, unhex(sha2(cast(text#" in line for line in shuffled)


def test_one_pass_scans_once(spark, sf_dir):
    text = plan(checks.measure(load(spark, sf_dir, "lineitem"), _lineitem_rules(), one_pass=True)[0])
    assert text.count("FileScan") == 1


def test_counts_come_from_statistics_where_the_source_keeps_them(spark, sf_dir):
    settings = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        df = load(spark, sf_dir, "lineitem")
        answer = evaluate(df, [RowCount(), NotNull("l_quantity"), NotNull("l_returnflag")])
        assert "PushedAggregation: [COUNT(*), COUNT(l_quantity), COUNT(l_returnflag)]" in plan(answer)
        assert [r.details for r in answer.collect()] == [f"rows={df.count()}, min_required=1", "nulls=0", "nulls=0"]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
