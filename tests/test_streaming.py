import pytest
from pyspark.sql import functions as F

from oreworks import Job, RowCount, SchemaError, UniqueKey
from oreworks.functions import transforms as t
from oreworks.operators.audit import gate_is_open
from oreworks.operators.drift import STRICT, EvolutionPolicy
from oreworks.plans.domains import sbe
from oreworks.streaming import ingest

EVENTS = "event_id bigint, kind string"


@pytest.fixture
def feed(spark, tmp_path):
    def add(first, last):
        df = spark.range(first, last).select(F.col("id").alias("event_id"), F.lit("click").alias("kind"))
        df.coalesce(1).write.mode("append").json(str(tmp_path / "in"))

    return add


def run(spark, schema, tmp_path, rules=(), checkpoint="checkpoint", ddl=EVENTS, policy=STRICT, **options):
    job = Job("sbe", "bronze", "events", None, t.rename("kind", "event_type"), tuple(rules), policy, schema=schema)
    folders = str(tmp_path / "in"), ddl, str(tmp_path / checkpoint)
    ingest.ingest_new_files(spark, job, *folders, f"{schema}.audit", **options)
    return sorted(r.event_id for r in spark.table(job.table).collect())


def test_each_file_is_read_once(spark, schema, tmp_path, feed):
    feed(0, 5)
    assert run(spark, schema, tmp_path) == list(range(5))
    feed(5, 8)
    feed(8, 9)
    assert run(spark, schema, tmp_path, max_files=1) == list(range(9))
    assert run(spark, schema, tmp_path) == list(range(9))
    table = spark.table(f"{schema}.bronze_events")
    assert table.columns == ["event_id", "event_type", "ingest_batch"]
    assert table.select("ingest_batch").distinct().count() == 3


def test_a_batch_interrupted_after_its_write_is_not_doubled(spark, schema, tmp_path, feed, monkeypatch):
    feed(0, 5)
    write = ingest._write_batch

    def write_and_die(*arguments):
        write(*arguments)
        raise RuntimeError("lost")

    monkeypatch.setattr(ingest, "_write_batch", write_and_die)
    with pytest.raises(Exception, match="lost"):
        run(spark, schema, tmp_path)
    spark.catalog.refreshTable(f"{schema}.bronze_events")
    assert spark.table(f"{schema}.bronze_events").count() == 5
    monkeypatch.setattr(ingest, "_write_batch", write)
    assert run(spark, schema, tmp_path) == list(range(5))


def test_a_batch_that_breaks_a_rule_is_audited_and_kept_out(spark, schema, tmp_path, feed):
    rules = (RowCount(1), UniqueKey(("event_id",)))
    feed(0, 5)
    run(spark, schema, tmp_path, rules)
    feed(5, 7)
    feed(6, 8)
    with pytest.raises(Exception, match=r"pk_unique_event_id: FAIL \(total=4, distinct=3\)"):
        run(spark, schema, tmp_path, rules)
    spark.catalog.refreshTable(f"{schema}.bronze_events")
    assert spark.table(f"{schema}.bronze_events").count() == 5
    spark.catalog.refreshTable(f"{schema}.audit")
    failed = spark.table(f"{schema}.audit").filter(~F.col("passed")).collect()
    assert [(r.layer, r.check_name, r.details) for r in failed] == [
        ("bronze", "pk_unique_event_id", "total=4, distinct=3")
    ]


def test_another_schema_is_refused(spark, schema, tmp_path, feed):
    feed(0, 5)
    run(spark, schema, tmp_path)
    with pytest.raises(SchemaError, match="addition: more"):
        run(spark, schema, tmp_path, ddl=EVENTS + ", more int")


def test_the_policy_of_the_job_holds(spark, schema, tmp_path, feed):
    feed(0, 3)
    run(spark, schema, tmp_path)
    feed(3, 5)
    policy = EvolutionPolicy(("more",), {}, False)
    assert run(spark, schema, tmp_path, ddl=EVENTS + ", more int", policy=policy) == list(range(5))
    table = spark.table(f"{schema}.bronze_events")
    assert table.columns == ["event_id", "event_type", "more", "ingest_batch"]
    assert table.where("more IS NULL").count() == 5
    with pytest.raises(SchemaError, match="removal: more"):
        run(spark, schema, tmp_path, policy=policy)


def test_silver_does_not_hold_the_batch(spark, schema, tmp_path, feed):
    feed(0, 3)
    run(spark, schema, tmp_path)
    _, silver, _ = sbe("", schema=schema)
    silver.run(spark)
    assert spark.table(silver.table).columns == ["event_id", "event_type"]


def test_a_table_without_batches_is_refused(spark, schema, tmp_path, feed):
    feed(0, 5)
    spark.range(3).write.saveAsTable(f"{schema}.bronze_events")
    with pytest.raises(ValueError, match="partitioned by ingest_batch"):
        run(spark, schema, tmp_path)


def test_the_gate_follows_what_was_written(spark, schema, tmp_path, feed, monkeypatch):
    write = ingest.tables.draft_partition

    def lost(df, table, values, marks=(), metrics=None):
        if table == f"{schema}.bronze_events":
            raise OSError("lost")
        return write(df, table, values, marks, metrics)

    feed(0, 5)
    run(spark, schema, tmp_path)
    assert gate_is_open(spark, f"{schema}.audit", "sbe", "bronze")  # without any rules
    feed(5, 7)
    with monkeypatch.context() as broken:
        broken.setattr(ingest.tables, "draft_partition", lost)
        with pytest.raises(Exception, match="lost"):
            run(spark, schema, tmp_path, (RowCount(1),))
    assert not gate_is_open(spark, f"{schema}.audit", "sbe", "bronze")
    assert run(spark, schema, tmp_path, (RowCount(1),)) == list(range(7))
    assert gate_is_open(spark, f"{schema}.audit", "sbe", "bronze")
