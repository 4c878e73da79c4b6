"""Evaluating rules, all of a set in one Spark job."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from oreworks.operators.rules import Fresh, NotNull, Rule, RowCount, UniqueKey

RESULT_SCHEMA = "ordinal int, check_name string, passed boolean, details string"


class QualityError(ValueError):
    """A data-quality rule failed."""


@dataclass(frozen=True)
class CheckResult:
    check_name: str
    passed: bool
    details: str = ""

    def __str__(self) -> str:
        return f"{self.check_name}: {'PASS' if self.passed else 'FAIL'} ({self.details})"

    __repr__ = __str__


def plain_measures(df: DataFrame, rules: Iterable[Rule]) -> dict[str, Column]:
    """The aggregates of all rules that need no key, by name."""
    return {name: aggregate for rule in rules for name, aggregate in rule.measures(df).items()}


def measure(
    df: DataFrame, rules: Sequence[Rule], one_pass: bool = False, known: Mapping[str, object] | None = None
) -> tuple[DataFrame, dict[str, Column]]:
    """Everything the rules need to know about ``df``: a frame of one row, and its
    columns by the names the rules gave them.

    All plain aggregates share one scan that shuffles a row per task. Each key is
    counted on a branch of its own that reads and shuffles only the key. Counting
    keys within the shared scan would shuffle every key together with all the
    other aggregates and, from the second key on, each row once per key.

    ``one_pass=True`` does that all the same, for a ``df`` that costs more to
    compute again than its keys cost to shuffle. What is ``known`` already, as from the write of these rows, is not measured again.
    """
    known = dict(known or {})
    for rule in rules:
        known.update(rule.settled(df))
    plain = {name: aggregate for name, aggregate in plain_measures(df, rules).items() if name not in known}
    keys = {name: F.count_distinct(key) for rule in rules for name, key in rule.keys(df).items()}
    column_of = {name: f"m{i}" for i, name in enumerate([*plain, *keys])}
    value = {name: F.col(column) for name, column in column_of.items()}
    value.update({name: F.lit(number).cast("bigint") for name, number in known.items()})
    measured = [aggregate.alias(column_of[name]) for name, aggregate in plain.items()]
    counted = [aggregate.alias(column_of[name]) for name, aggregate in keys.items()]
    if not measured and not counted:
        return df.sparkSession.range(0, 1, 1, 1), value
    if one_pass or not keys:
        return df.agg(*measured, *counted), value
    branches = ([df.agg(*measured)] if measured else []) + [df.agg(aggregate) for aggregate in counted]
    joined = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), branches)
    return joined.agg(*[F.max(column).alias(column) for column in column_of.values()]), value


def evaluate(df: DataFrame, rules: Iterable[Rule], one_pass: bool = False, known: Mapping[str, object] | None = None) -> DataFrame:
    """One row per rule, numbered in the order given."""
    rules = list(rules)
    if not rules:
        return df.sparkSession.createDataFrame([], RESULT_SCHEMA)
    measured, value = measure(df, rules, one_pass, known)
    rows = []
    for ordinal, rule in enumerate(rules):
        passed, details = rule.verdict(value)
        rows.append(
            F.struct(
                F.lit(ordinal).alias("ordinal"),
                F.lit(rule.name).alias("check_name"),
                F.coalesce(passed, F.lit(False)).alias("passed"),  # an unknown verdict is a failure
                details.alias("details"),
            )
        )
    return measured.select(F.inline(F.array(*rows)))


def overall(results: DataFrame) -> DataFrame:
    """One row: did everything pass? True for no results at all."""
    return results.agg(F.coalesce(F.every("passed"), F.lit(True)).alias("passed"))


def failures(results: DataFrame) -> DataFrame:
    return results.filter(~F.col("passed"))


def with_line(results: DataFrame) -> DataFrame:
    """Adds ``line``: each result as text."""
    status = F.when(F.col("passed"), "PASS").otherwise("FAIL")
    return results.withColumn("line", F.concat("check_name", F.lit(": "), status, F.lit(" ("), "details", F.lit(")")))


def collect(results: DataFrame) -> list[CheckResult]:
    """The results on the driver: as many rows as there are rules."""
    return [CheckResult(r.check_name, r.passed, r.details) for r in results.orderBy("ordinal").collect()]


def raise_if_failed(results: Iterable[CheckResult]) -> None:
    failed = [str(r) for r in results if not r.passed]
    if failed:
        raise QualityError("\n".join(["Data Quality Checks Failed:", *failed]))


class Validator:
    """Collects rules by chained calls; the first question about their outcome
    evaluates all of them at once."""

    def __init__(self, df: DataFrame, one_pass: bool = False):
        self.df = df
        self.one_pass = one_pass
        self.rules: list[Rule] = []
        self._known: list[CheckResult] | None = None

    def add(self, *rules: Rule) -> Validator:
        self.rules.extend(rules)
        self._known = None
        return self

    def check_row_count(self, min_rows: int = 1, max_rows: int | None = None) -> Validator:
        return self.add(RowCount(min_rows, max_rows))

    def check_not_null(self, column: str) -> Validator:
        return self.add(NotNull(column))

    def check_primary_key(self, *columns: str, digest: bool = False) -> Validator:
        return self.add(UniqueKey(columns, digest))

    def check_freshness_minutes(
        self, column: str, max_delay_minutes: float, as_of: dt.datetime | None = None
    ) -> Validator:
        return self.add(Fresh(column, max_delay_minutes, as_of))

    def results(self) -> DataFrame:
        return evaluate(self.df, self.rules, self.one_pass)

    def get_results(self) -> list[CheckResult]:
        if self._known is None:
            self._known = collect(self.results()) if self.rules else []
        return self._known

    def validate(self) -> bool:
        return all(r.passed for r in self.get_results())

    def raise_if_failed(self) -> None:
        raise_if_failed(self.get_results())


class Freshness:
    """Freshness of one timestamp column, raising at once on a breach."""

    def __init__(self, df: DataFrame, timestamp_column: str):
        self.df = df
        self.timestamp_column = timestamp_column

    def check_freshness_minutes(self, max_delay_minutes: float, as_of: dt.datetime | None = None) -> None:
        (found,) = collect(evaluate(self.df, [Fresh(self.timestamp_column, max_delay_minutes, as_of)]))
        if not found.passed:
            raise QualityError(f"Freshness SLA breached: {found.details}")


class Expectations:
    """Single checks that raise at once."""

    def __init__(self, df: DataFrame):
        self.df = df

    def _demand(self, rule: Rule, complaint: str) -> None:
        (found,) = collect(evaluate(self.df, [rule]))
        if not found.passed:
            raise QualityError(f"Expectation failed: {complaint} ({found.details})")

    def expect_column_values_to_not_be_null(self, column: str) -> None:
        self._demand(NotNull(column), f"{column} has nulls")

    def expect_column_values_to_be_unique(self, column: str) -> None:
        self._demand(UniqueKey((column,)), f"{column} not unique")

    def expect_table_row_count_to_be_between(self, min_rows: int, max_rows: int) -> None:
        self._demand(RowCount(min_rows, max_rows), "row count out of range")
