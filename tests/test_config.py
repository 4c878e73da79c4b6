import datetime as dt
import json
from pathlib import Path

import pytest

from oreworks import CorruptRecords, Fresh, NotNull, RowCount, UniqueKey, load_quality_config, policy_from, rules_from
from oreworks.operators.drift import Change, EvolutionPolicy
from oreworks.plans import config, domains
from registered.queries import FINANCE_RULES

AT = dt.datetime(2024, 1, 1)


def test_rules_from_yaml():
    assert rules_from(load_quality_config(str(FINANCE_RULES)), AT) == (
        RowCount(100),
        NotNull("transaction_id"),
        NotNull("account_id"),
        UniqueKey(("transaction_id",)),
        Fresh("event_time", 1560, AT),
    )


def test_lists_and_single_names():
    wanted = {"quality_rules": {"max_rows": 5, "not_null": "a", "primary_key": ["a", "b"]}}
    assert rules_from(wanted) == (RowCount(0, 5), NotNull("a"), UniqueKey(("a", "b")))


def test_several_keys_and_columns_and_unreadable_lines():
    wanted = {
        "primary_key": "a",
        "unique": [{"columns": ["b", "c"]}, {"columns": "text", "digest": True}],
        "freshness": [{"column": "t", "max_delay_minutes": 5}, {"column": "u", "max_delay_minutes": 1.5}],
        "corrupt_records": 3,
    }
    assert rules_from({"quality_rules": wanted}, AT) == (
        UniqueKey(("a",)),
        UniqueKey(("b", "c")),
        UniqueKey(("text",), digest=True),
        Fresh("t", 5, AT),
        Fresh("u", 1.5, AT),
        CorruptRecords(3),
    )


@pytest.mark.parametrize(
    "wanted",
    [
        {"unique": [{"columns": []}]},
        {"unique": "a"},
        {"unique": {"columns": "a", "digest": "yes"}},
        {"unique": {"column": "a"}},
        {"freshness": {"column": "a"}},
        {"freshness": {"column": 1, "max_delay_minutes": 1}},
        {"freshness": "a"},
        {"corrupt_records": None},
        {"corrupt_records": "3"},
    ],
)
def test_ill_formed_rules_are_refused(wanted):
    with pytest.raises(ValueError):
        rules_from({"quality_rules": wanted})


@pytest.mark.parametrize("path", sorted(Path(domains.__file__).with_name("rules").iterdir()), ids=lambda p: p.name)
def test_shipped_rules_load(path):
    assert rules_from(load_quality_config(str(path)), AT)


def test_no_rules():
    assert rules_from({}) == rules_from({"quality_rules": None}) == ()


@pytest.mark.parametrize(
    "wanted", [{"min_row": 1}, {"freshness": {"column": "a", "max_delay_minutes": 1, "zone": "UTC"}}]
)
def test_misspelt_keys_are_refused(wanted):
    with pytest.raises(ValueError, match="unknown keys"):
        rules_from({"quality_rules": wanted})


def test_policy_from_yaml(tmp_path):
    pytest.importorskip("yaml")
    path = tmp_path / "p.yaml"
    path.write_text(
        "schema_evolution:\n  allowed_additions: [d]\n  allowed_type_changes:\n    a: [int, bigint]\n"
        "  allow_removals: false\n"
    )
    policy = policy_from(load_quality_config(str(path)))
    assert (list(policy.allowed_additions), policy.allow_removals) == (["d"], False)
    assert tuple(policy.allowed_type_changes["a"]) == ("int", "bigint")
    assert not policy_from({}).allow_removals


def test_policy_allows_only_what_it_names():
    policy = policy_from({"schema_evolution": {"allowed_additions": "p_brand"}})
    assert policy == EvolutionPolicy(("p_brand",), {}, False)
    assert not policy.allows(Change("added", "brand", "string", None))
    assert not EvolutionPolicy("p_brand").allows(Change("added", "brand", "string", None))


@pytest.mark.parametrize(
    "config",
    [
        {"quality_rule": {"min_rows": 1}},
        {"min_rows": 1},
        {"schema_evolution": {"allow_removal": True}},
        {"schema_evolution": {"allow_removals": "no"}},
        {"schema_evolution": {"allowed_type_changes": {"a": ["int"]}}},
        {"quality_rules": {"min_rows": None}},
        {"quality_rules": {"max_rows": "5"}},
        {"quality_rules": {"not_null": [1]}},
    ],
)
def test_wrong_keys_and_values_are_refused(config):
    with pytest.raises(ValueError):
        rules_from(config)
        policy_from(config)


def test_json_without_yaml_package(tmp_path, monkeypatch):
    monkeypatch.setattr(config, "yaml", None)
    path = tmp_path / "rules.json"
    path.write_text(json.dumps({"quality_rules": {"min_rows": 3}}))
    assert rules_from(load_quality_config(str(path))) == (RowCount(3),)
