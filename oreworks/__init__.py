"""Layered batch jobs with data-quality checks, on Spark."""

from oreworks.operators.audit import audit_rows, gate_is_open, latest_runs, persist_quality_results
from oreworks.operators.checks import CheckResult, Expectations, Freshness, QualityError, Validator, evaluate
from oreworks.operators.drift import EvolutionPolicy, SchemaDrift, SchemaError
from oreworks.operators.rules import CorruptRecords, Fresh, NotNull, RowCount, UniqueKey
from oreworks.plans.config import load_quality_config, policy_from, rules_from
from oreworks.plans.domains import finance, manufacturing, sbe
from oreworks.plans.jobs import Job, run_checked, run_domain
from oreworks.session import get_spark

__all__ = [
    "CheckResult",
    "CorruptRecords",
    "EvolutionPolicy",
    "Expectations",
    "Fresh",
    "Freshness",
    "Job",
    "NotNull",
    "QualityError",
    "RowCount",
    "SchemaDrift",
    "SchemaError",
    "UniqueKey",
    "Validator",
    "audit_rows",
    "evaluate",
    "finance",
    "gate_is_open",
    "get_spark",
    "latest_runs",
    "load_quality_config",
    "manufacturing",
    "persist_quality_results",
    "policy_from",
    "rules_from",
    "run_checked",
    "run_domain",
    "sbe",
]
