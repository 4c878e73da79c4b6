"""Checks on arbitrary small frames against the same questions asked of Python rows."""

from collections import Counter

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

from oreworks import NotNull, RowCount, SchemaDrift, UniqueKey, evaluate
from oreworks.functions import transforms as t
from oreworks.operators import checks, drift

DDL = "k string, v int"
ROWS = st.lists(st.tuples(st.sampled_from(["a", "b", "", None]), st.sampled_from([-1, 0, 1, 2, None])), max_size=8)
FEW = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@FEW
@given(rows=ROWS, one_pass=st.booleans())
def test_checks(spark, rows, one_pass):
    rules = [RowCount(3), NotNull("k"), NotNull("v"), UniqueKey(("k",)), UniqueKey(("k", "v"))]
    found = checks.collect(evaluate(spark.createDataFrame(rows, DDL), rules, one_pass))
    total = len(rows)
    nulls = [sum(row[i] is None for row in rows) for i in (0, 1)]
    distinct = [len({row[0] for row in rows}), len(set(rows))]
    assert [(r.passed, r.details) for r in found] == [
        (total >= 3, f"rows={total}, min_required=3"),
        (nulls[0] == 0, f"nulls={nulls[0]}"),
        (nulls[1] == 0, f"nulls={nulls[1]}"),
        (distinct[0] == total, f"total={total}, distinct={distinct[0]}"),
        (distinct[1] == total, f"total={total}, distinct={distinct[1]}"),
    ]


@FEW
@given(rows=ROWS)
def test_groups(spark, rows):
    df = spark.createDataFrame(rows, DDL)
    sums = {}
    for key, value in rows:
        sums.setdefault(key, []).append(value)
    present = {k: [v for v in values if v is not None] for k, values in sums.items()}
    expected = {k: sum(values) if values else None for k, values in present.items()}
    assert {r.k: r.s for r in df.transform(t.total("v", "k", "s")).collect()} == expected
    assert {r.k: r.n for r in df.transform(t.row_counts("k", "n")).collect()} == Counter(k for k, _ in rows)
    assert df.transform(t.keep_positive("v")).count() == sum(v is not None and v > 0 for _, v in rows)


TYPES = {"int": IntegerType(), "bigint": LongType(), "array<int>": ArrayType(IntegerType())}
COLUMNS = st.dictionaries(st.sampled_from("abcdA"), st.sampled_from(sorted(TYPES)), max_size=4)


@settings(max_examples=100, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(source=COLUMNS, target=COLUMNS)
def test_drift(spark, source, target):
    schemas = [StructType() for _ in range(2)]
    for schema, columns in zip(schemas, (source, target)):
        for name, kind in columns.items():
            schema.add(name, TYPES[kind])
    found = SchemaDrift(*schemas)
    assert found.detect() == {
        "added_columns": sorted(set(source) - set(target)),
        "removed_columns": sorted(set(target) - set(source)),
        "type_changes": {n: (source[n], target[n]) for n in sorted(source) if n in target and source[n] != target[n]},
    }
    assert found.has_drift() == (source != target)
    everything = drift.EvolutionPolicy(set(source), found.detect()["type_changes"])
    assert everything.violations(found) == []
    nothing = drift.EvolutionPolicy(allow_removals=False)
    assert len(nothing.violations(found)) == len(found.changes())
