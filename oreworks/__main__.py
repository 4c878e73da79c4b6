"""Run a domain from the command line: ``python -m oreworks finance --raw PATH``.

With spark-submit, give this file as the application and the package with --py-files.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from oreworks.operators.checks import QualityError
from oreworks.plans.config import load_quality_config, policy_from, rules_from
from oreworks.plans.domains import DOMAINS
from oreworks.plans.jobs import LAYERS, GateClosed, run_domain
from oreworks.session import get_spark


def arguments(given: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="oreworks", description="Run the layers of a domain, checked and audited.")
    parser.add_argument("domain", choices=DOMAINS)
    parser.add_argument("--raw", required=True, help="path of the raw files")
    parser.add_argument("--raw-schema", help="their schema as DDL; without it CSV and JSON are read twice")
    parser.add_argument("--schema", help="catalog schema of the tables (default: the domain)")
    parser.add_argument("--audit", default="platform.audit_data_quality", help="audit table")
    parser.add_argument("--layer", action="append", choices=LAYERS, help="only this layer; may be repeated")
    parser.add_argument(
        "--rules", action="append", default=[], metavar="LAYER=FILE", help="rules and schema policy of a layer, as YAML"
    )
    parser.add_argument("--require-gate", action="store_true", help="start only if the layer below last passed")
    parser.add_argument("--format", default="parquet", help="table format")
    parser.add_argument("--batches", action="store_true", help="bronze is partitioned by run, and its rows are written once")
    parser.add_argument("--new-key", action="append", default=[], metavar="COLUMN[,COLUMN]", help="no batch may hold a key of another (with --batches)")
    parser.add_argument("--incremental", action="store_true", help="gold from partial results kept by batch (with --batches)")
    parser.add_argument("--quarantine", action="store_true", help="lines that do not parse are kept beside bronze (with --batches)")
    parser.add_argument("--iceberg", action="store_true", help="set up the Iceberg catalog (needs its runtime)")
    return parser.parse_args(given)


def main(given: list[str] | None = None, spark: SparkSession | None = None) -> int:
    wanted = arguments(given)
    domain = DOMAINS[wanted.domain]
    rules, policies = {}, {}
    for pair in wanted.rules:
        layer, _, path = pair.partition("=")
        if layer not in LAYERS:
            raise SystemExit(f"--rules {pair}: no layer {layer!r}")
        config = load_quality_config(path)
        rules[layer] = rules_from(config)
        if "schema_evolution" in config:
            policies[layer] = policy_from(config)
    spark = spark or get_spark(f"oreworks-{wanted.domain}", iceberg=wanted.iceberg)
    new_keys = [tuple(key.split(",")) for key in wanted.new_key]
    raw = domain.raw_files(wanted.raw, wanted.raw_schema)
    jobs = domain(raw, rules, wanted.schema, wanted.format, policies, wanted.batches, new_keys, wanted.incremental, wanted.quarantine)
    try:
        log = run_domain(spark, jobs, wanted.audit, wanted.layer or LAYERS, wanted.require_gate, wanted.format)
    except (QualityError, GateClosed) as failure:
        print(failure, file=sys.stderr)
        return 1
    for row in log.orderBy("domain", "layer", "check_name").collect():
        print(f"{row.layer} {row.check_name}: {'PASS' if row.passed else 'FAIL'} ({row.details})")
    return 0


if __name__ == "__main__":
    sys.exit(main())
