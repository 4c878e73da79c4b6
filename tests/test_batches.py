"""What is kept by batch: hashes of keys, and partial results of gold."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from oreworks import RowCount, gate_is_open
from oreworks.functions import transforms as t
from oreworks.operators import checks, keys, rules
from oreworks.plans.domains import finance, sbe
from oreworks.plans.jobs import run_checked, run_domain
from oreworks.plans.jobs import Run
from oreworks.sinks import derived, tables


def payments(rows):
    return lambda spark: spark.createDataFrame(rows, "transaction_id int, account_id string, amount double")


def jobs(schema, rows, **kept):
    return finance(payments(rows), {"bronze": (RowCount(1),)}, schema, batches=True, **kept)


KEY = (("transaction_id",),)
FIRST = [(1, "a", 0.1), (2, "b", 2.5), (None, "b", -1.0)]


def results(spark, schema):
    rows = spark.table(f"{schema}.audit").where("check_name LIKE 'pk_new%'").select("passed", "details").collect()
    return sorted(tuple(r) for r in rows)


def test_a_batch_with_known_keys_fails(spark, schema):
    log = f"{schema}.audit"
    run_domain(spark, jobs(schema, FIRST, new_keys=KEY), log, ["bronze"])
    run_domain(spark, jobs(schema, [(3, "a", 0.2), (3, "a", 0.2)], new_keys=KEY), log, ["bronze"])
    with pytest.raises(checks.QualityError, match="pk_new_transaction_id: FAIL .repeated=3"):
        run_domain(spark, jobs(schema, [(2, "c", 1.0), (2, "d", 1.0), (None, "e", 1.0), (4, "f", 1.0)], new_keys=KEY), log, ["bronze"])
    assert results(spark, schema) == [(False, "repeated=3"), (True, "repeated=0"), (True, "repeated=0")]
    assert spark.table(f"{schema}.bronze_transactions").count() == 5
    assert not gate_is_open(spark, log, "finance", "bronze")
    run_domain(spark, jobs(schema, [(4, "f", 1.0)], new_keys=KEY), log, ["bronze"])
    assert gate_is_open(spark, log, "finance", "bronze")


def test_unlike_keys_of_one_hash_are_no_repeats(spark, schema, monkeypatch):
    monkeypatch.setattr(rules, "key_hash", lambda columns: F.lit(7).cast("long"))
    log = f"{schema}.audit"
    for rows in (FIRST, [(3, "a", 0.2)]):
        run_domain(spark, jobs(schema, rows, new_keys=KEY), log, ["bronze"])
    with pytest.raises(checks.QualityError, match="repeated=1"):
        run_domain(spark, jobs(schema, [(3, "x", 0.2), (9, "x", 0.2)], new_keys=KEY), log, ["bronze"])


@pytest.mark.parametrize("few", [True, False])
def test_a_new_batch_is_held_against_hashes_alone(spark, schema, monkeypatch, few):
    if not few:
        monkeypatch.setattr(rules, "BROADCAST_HASHES", 0)
    log, read = f"{schema}.audit", []
    run_domain(spark, jobs(schema, FIRST, new_keys=KEY), log, ["bronze"])
    table = tables.named
    monkeypatch.setattr(tables, "named", lambda name: read.append(name) or table(name))
    monkeypatch.setattr(keys.derived, "in_step", lambda spark, source, name, *more: spark.table(name))
    bronze = jobs(schema, [(5, "a", 0.2)], new_keys=KEY)[0]
    batch = bronze.frame(spark)
    read.clear()
    assert keys.check_new_keys(batch, bronze.table, KEY[0], "next", 1).passed
    assert bronze.table not in read  # neither its rows nor its keys
    assert not keys.check_new_keys(payments(FIRST[:1])(spark), bronze.table, KEY[0], "next", 1).passed
    assert bronze.table in read


def test_hashes_that_a_dead_run_left_out_are_made_up_for(spark, schema):
    log = f"{schema}.audit"
    bronze = jobs(schema, FIRST)[0]
    run_checked(spark, bronze, Run.now(log))  # without the key rule, so without its hashes
    with pytest.raises(checks.QualityError, match="repeated=1"):
        run_checked(spark, dataclasses.replace(jobs(schema, [(1, "z", 1.0)], new_keys=KEY)[0]), Run.now(log))
    assert spark.table(keys.hashes_of(bronze.table, KEY[0])).count() == 3


def test_keys_between_batches_need_batches(spark, schema):
    with pytest.raises(ValueError, match="between batches"):
        finance(payments(FIRST), schema=schema, new_keys=KEY)
    with pytest.raises(ValueError, match="by batches"):
        finance(payments(FIRST), schema=schema, incremental=True)


def gold(spark, schema):
    return {r.account_id: r.total_spend for r in spark.table(f"{schema}.gold_account_metrics").collect()}


def test_gold_of_partial_results_equals_gold_of_everything(spark, schema):
    log, second = f"{schema}.audit", [(4, "a", 0.2), (5, "c", 1e-9), (6, "a", 1e17), (7, None, 3.0)]
    for rows in (FIRST, second, second):
        run_domain(spark, jobs(schema, rows, incremental=True), log, ["bronze", "gold"])
        bronze = spark.table(f"{schema}.bronze_transactions")
        whole = bronze.transform(t.keep_positive("amount")).transform(t.exact_total("amount", "account_id", "s"))
        assert gold(spark, schema) == {r.account_id: r.s for r in whole.collect()}
    assert gate_is_open(spark, log, "finance", "gold")
    assert not spark.catalog.tableExists(f"{schema}.silver_transactions")


def test_only_new_batches_are_read_for_gold(spark, schema, monkeypatch):
    log, added = f"{schema}.audit", []
    add = tables.add_partition
    run_domain(spark, jobs(schema, FIRST, incremental=True), log, ["bronze", "gold"])
    monkeypatch.setattr(derived.tables, "add_partition", lambda df, table, values: added.append((table, df.inputFiles())) or add(df, table, values))
    run_domain(spark, jobs(schema, [(8, "q", 1.0)], incremental=True), log, ["bronze", "gold"])
    partials = [files for table, files in added if table.endswith("_partials")]
    newest = [b for b in derived.batches(spark, f"{schema}.bronze_transactions") if spark.table(f"{schema}.bronze_transactions").where(F.col("ingest_batch") == b).first().account_id == "q"]
    assert len(partials) == 1 and all(f"ingest_batch={newest[0]}/" in f for f in partials[0])
    added.clear()
    run_domain(spark, jobs(schema, [], incremental=True), log, ["gold"])  # nothing new
    assert not [table for table, _ in added if table.endswith("_partials")]


def test_a_batch_written_again_is_derived_again_and_a_dropped_one_goes(spark, schema):
    table, name = f"{schema}.t", f"{schema}.sums"
    tables.ready_for_batches(spark.range(3), table)
    step = t.row_counts("id", "n")
    odd = "b=/%41 '"
    for batch, rows in (("a", 3), (odd, 2)):
        tables.add_partition(spark.range(rows), table, {"ingest_batch": batch})

    def counts():
        found = derived.in_step(spark, table, name, step.partial).transform(step.merge)
        assert len(derived.batches(spark, table)) == spark.sql(f"SHOW PARTITIONS {name}").count()
        return {r.id: r.n for r in found.collect()}

    assert set(derived.batches(spark, table)) == {"a", odd}
    assert counts() == {0: 2, 1: 2, 2: 1}
    tables.add_partition(spark.range(5), table, {"ingest_batch": odd})
    assert counts() == {0: 2, 1: 2, 2: 2, 3: 1, 4: 1}
    tables.drop_partitions(spark, table, [{"ingest_batch": "a"}])
    assert counts() == {0: 1, 1: 1, 2: 1, 3: 1, 4: 1}
    tables.drop_partitions(spark, table, [{"ingest_batch": odd}])
    assert counts() == {}


def test_events_are_counted_by_batch(spark, schema):
    feed = lambda *types: lambda s: s.createDataFrame([(x,) for x in types], "event_type string")
    for types in (("a", "b", None), ("a",)):
        run_domain(spark, sbe(feed(*types), {"gold": (RowCount(1),)}, schema, batches=True, incremental=True), f"{schema}.audit", ["bronze", "gold"])
    assert {tuple(r) for r in spark.table(f"{schema}.gold_event_metrics").collect()} == {("a", 2), ("b", 1)}
