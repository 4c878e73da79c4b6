"""Bronze ingest of a folder that only gains files: each run takes the new ones.

The batch ingest reads the whole input and appends it, so a rerun adds it again.
This one remembers in its checkpoint what it has read. Every batch goes to a
partition of its own that a retry overwrites, so a batch that was interrupted after
its write is not there twice. A file replaced under its old name is not read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from oreworks.operators.checks import CheckResult, collect, evaluate, plain_measures, raise_if_failed
from oreworks.operators.keys import check_new_keys, known_hashes
from oreworks.operators.rules import ROWS, RowCount
from oreworks.plans.jobs import WRITE_CHECK, Job, Run, as_stored, rules_for
from oreworks.sinks import tables

BATCH = tables.INGEST_BATCH


def ingest_new_files(
    spark: SparkSession,
    job: Job,
    path: str,
    schema: str,
    checkpoint: str,
    audit_table: str,
    source_format: str = "json",
    max_files: int | None = None,
    **options,
) -> None:
    """Append the files new under ``path`` to the job's table, checked batch by batch.

    ``schema`` is required: a stream does not infer one. ``max_files`` bounds a batch.
    A batch that breaks a rule is audited and stops the run; the next run meets it
    again. The table has one column more, ``ingest_batch``, which the layer above does not read.
    The schema may change as the job's policy allows; added columns read NULL in earlier batches.
    """
    reader = spark.readStream.format(source_format).schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.load(path).transform(job.transform)
    tables.ready_for_batches(rows, job.table, job.fmt, job.policy)
    (
        rows.writeStream.foreachBatch(lambda batch, number: _write_batch(batch, number, job, audit_table))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    # Batches were written from the stream's own session.
    spark.catalog.refreshTable(job.table)


def _write_batch(batch: DataFrame, number: int, job: Job, audit_table: str) -> None:
    spark = batch.sparkSession
    # The same in every attempt at this batch, and in no other stream.
    name = f"{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}-{number}"
    rules = as_stored(rules_for(batch, job))
    if job.new_keys and not rules:
        rules = [RowCount(0)]  # what is held against hashes is counted
    run = Run.now(audit_table, job.fmt)
    draft, recorded = None, False
    try:
        draft = tables.draft_partition(batch, job.table, {BATCH: name}, metrics=lambda rows: plain_measures(rows, rules))
        if rules:
            results = collect(evaluate(draft.rows, rules, known=draft.measured))
            results += [check_new_keys(draft.rows, job.table, columns, name, draft.measured.get(ROWS), job.fmt) for columns in job.new_keys]
            run.record(spark, job, results)
            recorded = not all(result.passed for result in results)
            raise_if_failed(results)
        written, draft = draft, None
        written.publish()
        for columns in job.new_keys:
            known_hashes(spark, job.table, columns, job.fmt)
        if rules:
            run.commit(spark, job)
        else:  # else the gate of a stream without rules would never open
            run.record(spark, job, [CheckResult(WRITE_CHECK, True)], ".write")
    except Exception as failure:
        if not recorded:
            run.record(spark, job, [CheckResult(WRITE_CHECK, False, type(failure).__name__)], ".write")
        raise
    finally:
        if draft:
            draft.discard()
