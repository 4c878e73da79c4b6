import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from oreworks import EvolutionPolicy, SchemaError
from oreworks.sinks import tables
from oreworks.sources import catalog


def rows(spark, table):
    return sorted((tuple(r) for r in spark.table(table).collect()), key=repr)


def test_append_adds_by_name(spark, schema):
    name = f"{schema}.t"
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    tables.append(df, name)
    tables.append(df.select("b", "a"), name)
    assert rows(spark, name) == [(1, "x"), (1, "x")]
    assert catalog.table_schema(spark, name).simpleString() == "struct<a:int,b:string>"
    assert catalog.table(spark, name).count() == 2


def test_append_refuses_other_columns(spark, schema):
    name = f"{schema}.t"
    tables.append(spark.createDataFrame([(1, "x")], "a int, b string"), name)
    for ddl, row in (("a int", (1,)), ("a int, b string, c int", (1, "x", 2)), ("a int, B string", (1, "x"))):
        with pytest.raises(SchemaError):
            tables.append(spark.createDataFrame([row], ddl), name)
    assert rows(spark, name) == [(1, "x")]


def test_append_casts_safely_only(spark, schema):
    name = f"{schema}.t"
    tables.append(spark.createDataFrame([(1,)], "a bigint"), name)
    tables.append(spark.createDataFrame([(2,)], "a int"), name)
    assert rows(spark, name) == [(1,), (2,)]
    with pytest.raises(Exception, match="CANNOT_SAFELY_CAST"):
        tables.append(spark.createDataFrame([("x",)], "a string"), name)


def test_replace_leaves_one_copy(spark, schema):
    name = f"{schema}.t"
    for values in ([1, 2], [3]):
        tables.replace(spark.createDataFrame([(v,) for v in values], "a int"), name)
    assert rows(spark, name) == [(3,)]
    tables.replace(spark.createDataFrame([], "a int"), name)
    assert rows(spark, name) == []


def test_replace_with_drift_is_refused(spark, schema):
    name = f"{schema}.t"
    tables.replace(spark.createDataFrame([(1, "x")], "a int, b string"), name)
    for ddl, row in (("a int", (1,)), ("a bigint, b string", (1, "x")), ("a int, b string, c int", (1, "x", 2))):
        with pytest.raises(SchemaError):
            tables.replace(spark.createDataFrame([row], ddl), name)
    assert rows(spark, name) == [(1, "x")]


def test_allowed_changes_are_carried_out(spark, schema):
    name = f"{schema}.t"
    tables.replace(spark.createDataFrame([(1, "x")], "a bigint, b string"), name)
    policy = EvolutionPolicy(["c"], {"a": ["int", "bigint"]})
    tables.replace(spark.createDataFrame([(2, 0.5)], "a int, c double"), name, policy=policy)
    assert spark.table(name).dtypes == [("a", "bigint"), ("b", "string"), ("c", "double")]
    assert rows(spark, name) == [(2, None, 0.5)]


def test_replace_clears_every_partition_even_in_dynamic_mode(spark, schema):
    name = f"{schema}.t"
    spark.range(12).select("id", (F.col("id") % 3).alias("p")).write.partitionBy("p").saveAsTable(name)
    spark.conf.set(tables.OVERWRITE_MODE, "dynamic")
    try:
        tables.replace(spark.range(2).select(F.lit(1).cast("bigint").alias("p"), "id"), name)
        assert spark.conf.get(tables.OVERWRITE_MODE) == "dynamic"
    finally:
        spark.conf.unset(tables.OVERWRITE_MODE)
    assert rows(spark, name) == [(0, 1), (1, 1)]


def test_partitioned_table_gets_few_files(spark, schema):
    name = f"{schema}.t"
    spark.createDataFrame([], "id bigint, p bigint").write.partitionBy("p").saveAsTable(name)
    tables.append(spark.range(0, 1000, 1, 16).select("id", (F.col("id") % 4).alias("p")), name)
    assert spark.table(name).count() == 1000
    assert len(spark.table(name).inputFiles()) == 4


def location(spark, table):
    return tables._describe(spark, table).location


def test_a_failed_replace_changes_nothing(spark, schema):
    name = f"{schema}.t"
    tables.replace(spark.createDataFrame([(1, 2)], "a int, b int"), name)
    before = location(spark, name)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        tables.replace(spark.range(8).selectExpr("CAST(id AS INT) AS a", "CAST(1 / (id - 7) AS INT) AS b"), name)
    assert location(spark, name) == before
    assert rows(spark, name) == [(1, 2)]


def test_replace_of_a_table_by_what_was_read_from_it(spark, schema):
    name = f"{schema}.t"
    tables.replace(spark.range(5), name)
    tables.replace(spark.table(name).filter("id > 2"), name)
    assert rows(spark, name) == [(3,), (4,)]


def test_replace_keeps_the_files_before_for_running_readers(spark, schema):
    name = f"{schema}.t"
    for n in (3, 2):
        tables.replace(spark.range(n), name)
        tables.append(spark.range(1), name)
    planned = spark.table(name)
    before = location(spark, name)
    tables.replace(spark.range(1), name)
    assert planned.count() == 3  # of a plan made before
    assert rows(spark, name) == [(0,)]
    folder = Path(location(spark, name).removeprefix("file:"))
    assert re.fullmatch(r"t\.rows-[0-9a-f]{32}", folder.name)
    assert {p.name for p in folder.parent.iterdir()} == {folder.name, Path(before).name}
    tables.purge(spark, name)
    tables.purge(spark, name)
    assert [p.name for p in folder.parent.iterdir()] == [folder.name]
    spark.sql(f"DROP TABLE {name}")
    assert not folder.exists()


def test_replaces_at_the_same_time_leave_one_copy(spark, schema):
    name = f"{schema}.t"
    tables.replace(spark.range(3), name)
    drafts = [tables.draft(spark.range(n), name) for n in (4, 5, 6)]
    drafts[1].publish()
    for late in (drafts[0], drafts[2]):
        with pytest.raises(tables.ConcurrentReplace):
            late.publish()
    assert spark.table(name).count() == 5
    tables.purge(spark, name)
    folder = Path(location(spark, name).removeprefix("file:"))
    assert [p.name for p in folder.parent.iterdir()] == [folder.name]


def test_drafts_of_a_new_table_at_the_same_time(spark, schema):
    name = f"{schema}.t"
    first, late = (tables.draft(spark.range(n), name) for n in (4, 5))
    first.publish()
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        late.publish()
    assert spark.table(name).count() == 4
    folder = Path(location(spark, name).removeprefix("file:"))
    assert [p.name for p in folder.parent.iterdir()] == [folder.name]


def test_a_failed_publish_leaves_nothing(spark, schema, monkeypatch):
    name = f"{schema}.t"
    draft = tables.draft(spark.range(4), name)
    monkeypatch.setattr(tables, "_add_columns", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        draft.publish()
    assert not spark.catalog.tableExists(name)
    assert not Path(draft.location.removeprefix("file:")).exists()


def test_replace_keeps_string_lengths_and_options(spark, schema):
    name = f"{schema}.t"
    spark.sql(f"CREATE TABLE {name} (a varchar(2), b int) USING parquet OPTIONS (compression 'zstd')")
    tables.replace(spark.createDataFrame([("xy", 1)], "a string, b int"), name)
    assert rows(spark, name) == [("xy", 1)]
    assert all(".zstd." in f for f in spark.table(name).inputFiles())
    assert [t.name for t in spark.catalog.listTables(schema)] == ["t"]
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        tables.replace(spark.createDataFrame([("abcdef", 1)], "a string, b int"), name)
    assert rows(spark, name) == [("xy", 1)]
    assert [t.name for t in spark.catalog.listTables(schema)] == ["t"]


def test_a_partition_written_again_is_replaced_when_complete(spark, schema):
    name = f"{schema}.t"
    tables.create_partitioned(spark, name, spark.range(1).withColumn("p", F.lit("")).schema, ["p"])
    for n in (3, 2):
        tables.add_partition(spark.range(n), name, {"p": "x/'y"})
    assert rows(spark, name) == [(0, "x/'y"), (1, "x/'y")]
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        tables.add_partition(spark.range(8).selectExpr("CAST(1 / (id - 7) AS BIGINT) AS id"), name, {"p": "x/'y"})
    spark.catalog.refreshTable(name)
    assert rows(spark, name) == [(0, "x/'y"), (1, "x/'y")]


def test_bucketed_table_is_replaced_in_place(spark, schema):
    name = f"{schema}.t"
    spark.range(10).write.bucketBy(2, "id").saveAsTable(name)
    before = location(spark, name)
    tables.replace(spark.range(3), name)
    assert (rows(spark, name), location(spark, name)) == ([(0,), (1,), (2,)], before)


def test_a_failed_replace_of_a_partitioned_table_changes_nothing(spark, schema):
    name = f"{schema}.t"
    spark.range(4).selectExpr("id", "id % 2 AS p").write.partitionBy("p").saveAsTable(name)
    broken = spark.range(8).selectExpr("CAST(1 / (id - 7) AS BIGINT) AS id", "id % 2 AS p")
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        tables.replace(broken, name)
    assert rows(spark, name) == [(0, 0), (1, 1), (2, 0), (3, 1)]
    tables.replace(spark.table(name).filter("id > 1"), name)
    assert rows(spark, name) == [(2, 0), (3, 1)]


def test_a_table_is_read_as_it_is_now(spark, schema):
    name = f"{schema}.t"
    tables.append(spark.range(3), name)
    assert catalog.table(spark, name).count() == 3
    spark.range(2).write.mode("append").parquet(location(spark, name))
    assert catalog.table(spark, name).count() == 5


def test_external_table_is_replaced_in_place(spark, schema, tmp_path):
    name = f"{schema}.t"
    spark.range(10).write.option("path", str(tmp_path / "kept")).saveAsTable(name)
    tables.replace(spark.range(3), name)
    assert spark.read.parquet(str(tmp_path / "kept")).count() == spark.table(name).count() == 3


def test_orc_table(spark, schema):
    name = f"{schema}.t"
    tables.replace(spark.range(5), name, fmt="orc")
    tables.replace(spark.range(3), name, fmt="orc")
    assert tables._describe(spark, name).provider == "orc"
    assert rows(spark, name) == [(0,), (1,), (2,)]


def test_odd_column_names(spark, schema):
    name = f"{schema}.t"
    df = spark.createDataFrame([(1, 2, 3)], "`a.b` int, `c d` int, `e``f` int")
    tables.append(df, name)
    tables.append(df.select("`c d`", "`e``f`", "`a.b`"), name)
    more = df.selectExpr("*", "4 AS `g``h.i`")
    tables.replace(more, name, policy=EvolutionPolicy(["g`h.i"]))
    assert rows(spark, name) == [(1, 2, 3, 4)]


def test_a_schema_is_created_for_the_first_table(spark, schema):
    name = f"{schema}_new.t"
    tables.append(spark.range(3), name)
    assert spark.table(name).count() == 3
