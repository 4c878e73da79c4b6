"""The three domains: what is read, kept and summed up."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from oreworks.functions.transforms import Rollup, Transform, exact_total, keep_not_null, keep_positive, rename, row_counts, same, then
from oreworks.operators.drift import STRICT, EvolutionPolicy
from oreworks.operators.rules import Rule
from oreworks.plans.jobs import Job
from oreworks.sinks import derived, tables
from oreworks.sources import catalog, files

production_ingest: Transform = rename("prod_dt", "production_date")
production_kept: Transform = keep_positive("quantity")
production_output: Rollup = exact_total("quantity", by="plant_id", alias="total_output")

transactions_kept: Transform = keep_positive("amount")
transactions_spend: Rollup = exact_total("amount", by="account_id", alias="total_spend")

events_kept: Transform = keep_not_null("event_type")
events_counted: Rollup = row_counts(by="event_type", alias="event_count")


@dataclass(frozen=True)
class Domain:
    """What its three jobs have in common. Calling it gives the jobs."""

    name: str
    entity: str
    metrics: str
    read_files: Callable[..., DataFrame]
    ingest: Transform
    keep: Transform
    sum_up: Rollup
    text: bool = False  # raw files are parsed text, which a checked run parses once

    def raw_files(self, path: str, schema: str | None = None, **options) -> Callable[[SparkSession], DataFrame]:
        """Without a schema, CSV and JSON are read once more to infer one. Lines of text that do
        not parse are counted for the audit and, but for their readable values, not stored."""
        read = files.with_unreadable(self.read_files) if self.text else self.read_files
        return lambda spark: read(spark, path, schema, **options)

    def __call__(
        self,
        raw: str | Callable[[SparkSession], DataFrame],
        rules: Mapping[str, tuple[Rule, ...]] | None = None,
        schema: str | None = None,
        fmt: str = "parquet",
        policies: Mapping[str, EvolutionPolicy] | None = None,
        batches: bool = False,
        new_keys: Sequence[tuple[str, ...]] = (),
        incremental: bool = False,
        quarantine: bool = False,
    ) -> tuple[Job, Job, Job]:
        """``raw``: a path, or a function that gives the raw rows. ``schema``: the
        catalog schema of the tables. Rules and schema policies are given by layer. With
        ``batches`` a run adds a partition to bronze, written once (see ``Job``), which may hold none of the ``new_keys`` of another.

        With ``quarantine`` lines that do not parse are kept with their text beside bronze, and not in it.

        With ``incremental``, gold is put together from partial results that are kept for each batch of bronze, and
        only batches without one are read, kept and summed up as silver and gold would. It equals what it is
        without, and does not need silver's table."""
        schema = schema or self.name
        if incremental and not batches:
            raise ValueError("gold is kept by batches of bronze")

        def job(layer: str, name: str, read, transform: Transform, staged: bool) -> Job:
            return Job(
                domain=self.name,
                layer=layer,
                name=name,
                read=read,
                transform=transform,
                rules=tuple((rules or {}).get(layer, ())),
                policy=(policies or {}).get(layer, STRICT),
                staged=staged,
                batches=batches and layer == "bronze",
                quarantine=quarantine and layer == "bronze",
                new_keys=tuple(map(tuple, new_keys)) if layer == "bronze" else (),
                aside=(files.UNREADABLE,) if self.text and layer == "bronze" else (),
                schema=schema,
                fmt=fmt,
            )

        def stored(job: Job) -> Callable[[SparkSession], DataFrame]:
            def read(spark: SparkSession) -> DataFrame:
                rows = catalog.table(spark, job.table)
                # A stream's mark of its batches goes no further than its table.
                streamed = tables.takes_batches(spark, job.table)
                return rows.drop(tables.INGEST_BATCH) if streamed else rows

            return read

        bronze = job("bronze", self.entity, raw if callable(raw) else self.raw_files(raw), self.ingest, self.text)
        silver = job("silver", self.entity, stored(bronze), self.keep, False)
        if not incremental:
            return bronze, silver, job("gold", self.metrics, stored(silver), self.sum_up, True)

        def merged(spark: SparkSession) -> DataFrame:
            partial = then(self.keep, self.sum_up.partial)
            return derived.in_step(spark, bronze.table, f"{schema}.gold_{self.metrics}_partials", partial, fmt)

        return bronze, silver, job("gold", self.metrics, merged, self.sum_up.merge, True)


# Production records; output per plant.
manufacturing = Domain(
    "manufacturing",
    "production",
    "output_metrics",
    files.csv,
    production_ingest,
    production_kept,
    production_output,
    text=True,
)

# Transactions, of which positive amounts are spend; spend per account.
finance = Domain(
    "finance", "transactions", "account_metrics", files.parquet, same, transactions_kept, transactions_spend
)

# Sales and business events; events per type.
sbe = Domain("sbe", "events", "event_metrics", files.json, same, events_kept, events_counted, text=True)

DOMAINS = {domain.name: domain for domain in (manufacturing, finance, sbe)}
