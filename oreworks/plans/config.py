"""Rules and schema policies from YAML.

Keys (fixed names): under ``quality_rules`` are ``min_rows``, ``max_rows``,
``not_null``, ``primary_key`` and ``freshness`` with ``column`` and
``max_delay_minutes``; under ``schema_evolution`` are ``allowed_additions``,
``allowed_type_changes`` and ``allow_removals``.

Further keys under ``quality_rules``: ``unique``, a list of keys, each with ``columns``
and, for keys that are whole texts, ``digest: true``; ``corrupt_records``, the most
unreadable lines of a text source. ``freshness`` may be a list, a column each.
"""

from __future__ import annotations

import datetime as dt
import json

from oreworks.operators.drift import EvolutionPolicy
from oreworks.operators.rules import CorruptRecords, Fresh, NotNull, Rule, RowCount, UniqueKey

try:
    import yaml
except ImportError:  # JSON is YAML too, and needs no further package
    yaml = None

SECTIONS = {"quality_rules", "schema_evolution"}
POLICY_KEYS = {"allowed_additions", "allowed_type_changes", "allow_removals", "nested"}
RULE_KEYS = {"min_rows", "max_rows", "not_null", "primary_key", "unique", "freshness", "corrupt_records"}
UNIQUE_KEYS = {"columns", "digest", "hashed"}
FRESHNESS_KEYS = {"column", "max_delay_minutes"}


def load_quality_config(path: str) -> dict:
    with open(path, encoding="utf-8") as source:
        return (yaml.safe_load(source) if yaml else json.load(source)) or {}


def _names(value, where: str) -> list[str]:
    """Column names, given as one or as a list."""
    names = [value] if isinstance(value, str) else value if isinstance(value, list | tuple) else [] if value is None else [value]
    if not all(isinstance(name, str) for name in names):
        raise ValueError(f"{where} takes column names, not {value!r}")
    return list(names)


def _number(value, where: str, whole: bool = True):
    if isinstance(value, bool) or not isinstance(value, int if whole else int | float):
        raise ValueError(f"{where} takes a number, not {value!r}")
    return value


def _mappings(value, where: str, known: set[str]) -> list[dict]:
    """Keys and values, given once or as a list of several."""
    given = [] if not value else value if isinstance(value, list) else [value]
    for one in given:
        if not isinstance(one, dict):
            raise ValueError(f"{where} takes keys and values, not {one!r}")
        _no_others(one, known, where)
    return given


def _section(config: dict, name: str, known: set[str]) -> dict:
    _no_others(config, SECTIONS, "the configuration")
    wanted = config.get(name) or {}
    if not isinstance(wanted, dict):
        raise ValueError(f"{name} takes keys and values, not {wanted!r}")
    _no_others(wanted, known, name)
    return wanted


def _no_others(given: dict, known: set[str], where: str) -> None:
    unknown = sorted(set(given) - known)
    if unknown:
        raise ValueError(f"unknown keys under {where}: {', '.join(unknown)}")


def rules_from(config: dict, as_of: dt.datetime | None = None) -> tuple[Rule, ...]:
    """The rules a config asks for. A key that is misspelt is refused, since a rule
    that silently does not run looks like one that passes."""
    wanted = _section(config, "quality_rules", RULE_KEYS)
    rules: list[Rule] = []
    if "min_rows" in wanted or "max_rows" in wanted:
        most = wanted.get("max_rows")
        least = _number(wanted.get("min_rows", 0), "min_rows")
        rules.append(RowCount(least, _number(most, "max_rows") if "max_rows" in wanted else None))
    rules += [NotNull(column) for column in _names(wanted.get("not_null"), "not_null")]
    if wanted.get("primary_key"):
        rules.append(UniqueKey(tuple(_names(wanted["primary_key"], "primary_key"))))
    for key in _mappings(wanted.get("unique"), "unique", UNIQUE_KEYS):
        columns, ways = _names(key.get("columns"), "unique"), [key.get(way, False) for way in ("digest", "hashed")]
        if not columns or not all(isinstance(way, bool) for way in ways):
            raise ValueError(f"unique takes columns and true or false for digest or hashed, not {key!r}")
        rules.append(UniqueKey(tuple(columns), *ways))
    for limit in _mappings(wanted.get("freshness"), "freshness", FRESHNESS_KEYS):
        if set(limit) != FRESHNESS_KEYS or not isinstance(limit["column"], str):
            raise ValueError(f"freshness takes a column and its max_delay_minutes, not {limit!r}")
        rules.append(Fresh(limit["column"], _number(limit["max_delay_minutes"], "max_delay_minutes", whole=False), as_of))
    if "corrupt_records" in wanted:
        rules.append(CorruptRecords(_number(wanted["corrupt_records"], "corrupt_records")))
    return tuple(rules)


def policy_from(config: dict) -> EvolutionPolicy:
    """The changes a config allows. What it does not name stays refused, removals too."""
    wanted = _section(config, "schema_evolution", POLICY_KEYS)
    removals, retyped = wanted.get("allow_removals", False), wanted.get("allowed_type_changes") or {}
    nested = wanted.get("nested", False)
    for name, given in (("allow_removals", removals), ("nested", nested)):
        if not isinstance(given, bool):
            raise ValueError(f"{name} takes true or false, not {given!r}")
    if not isinstance(retyped, dict):
        raise ValueError(f"allowed_type_changes takes columns and pairs of types, not {retyped!r}")
    changes = {column: tuple(_names(pair, "allowed_type_changes")) for column, pair in retyped.items()}
    if any(len(pair) != 2 for pair in changes.values()):
        raise ValueError("allowed_type_changes takes a pair of types per column")
    return EvolutionPolicy(tuple(_names(wanted.get("allowed_additions"), "allowed_additions")), changes, removals, nested)
