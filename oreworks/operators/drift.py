"""Schema drift: what changed between a source and its target, and whether it may.

This is work on two schemas, whose size does not grow with the rows.
"""

from __future__ import annotations

from collections.abc import Collection, Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from oreworks.functions.frames import constant_rows, quoted

CHANGE_SCHEMA = "change_kind string, column_name string, source_type string, target_type string"
ADDED, REMOVED, RETYPED = "added", "removed", "type_change"


class SchemaError(ValueError):
    """A schema change that is not allowed."""


@dataclass(frozen=True)
class Change:
    kind: str
    column: str
    source_type: str | None
    target_type: str | None

    def __str__(self) -> str:
        # The three messages are fixed texts.
        if self.kind == ADDED:
            return f"Unauthorized column addition: {self.column}"
        if self.kind == REMOVED:
            return f"Unauthorized column removal: {self.column}"
        return f"Unauthorized type change: {self.column} {self.source_type}->{self.target_type}"


class SchemaDrift:
    """Columns by exact name, types by their full spelling; order, nullability and
    comments do not count."""

    def __init__(self, source_schema: StructType, target_schema: StructType):
        self.source_schema = source_schema
        self.target_schema = target_schema

    def changes(self) -> list[Change]:
        source = {f.name: f.dataType.simpleString() for f in self.source_schema}
        target = {f.name: f.dataType.simpleString() for f in self.target_schema}
        found = []
        for name in sorted({*source, *target}):
            old, new = target.get(name), source.get(name)
            if old is None:
                found.append(Change(ADDED, name, new, None))
            elif new is None:
                found.append(Change(REMOVED, name, None, old))
            elif old != new:
                found.append(Change(RETYPED, name, new, old))
        return found

    def nested(self) -> list[Change]:
        """Changes at any depth, each once, at its path: ``lines[].tax`` is a field of the structs in an array, ``props{value}``
        the values of a map. A column that is new, gone or of another kind as a whole is one change."""
        return list(_walk(self.source_schema, self.target_schema, ""))

    def detect(self) -> dict:
        changes = self.changes()
        # The three keys are fixed values.
        return {
            "added_columns": [c.column for c in changes if c.kind == ADDED],
            "removed_columns": [c.column for c in changes if c.kind == REMOVED],
            "type_changes": {c.column: (c.source_type, c.target_type) for c in changes if c.kind == RETYPED},
        }

    def has_drift(self) -> bool:
        return bool(self.changes())


def _named(path: str, field: str) -> str:
    """The path of a field; a name that would read like a path is quoted."""
    name = field if field and not set(field) & set(".[]{}`") else quoted(field)
    return f"{path}.{name}" if path else name


def _walk(source: DataType, target: DataType, path: str) -> Iterator[Change]:
    if isinstance(source, StructType) and isinstance(target, StructType):
        new, old = ({f.name: f.dataType for f in fields} for fields in (source, target))
        for name in sorted({*new, *old}):
            at = _named(path, name)
            if name not in old:
                yield Change(ADDED, at, new[name].simpleString(), None)
            elif name not in new:
                yield Change(REMOVED, at, None, old[name].simpleString())
            else:
                yield from _walk(new[name], old[name], at)
    elif isinstance(source, ArrayType) and isinstance(target, ArrayType):
        yield from _walk(source.elementType, target.elementType, f"{path}[]")
    elif isinstance(source, MapType) and isinstance(target, MapType):
        yield from _walk(source.keyType, target.keyType, f"{path}{{key}}")
        yield from _walk(source.valueType, target.valueType, f"{path}{{value}}")
    elif source.simpleString() != target.simpleString():
        yield Change(RETYPED, path, source.simpleString(), target.simpleString())


def change_rows(spark: SparkSession, changes: Sequence[Change]) -> DataFrame:
    return constant_rows(spark, [(c.kind, c.column, c.source_type, c.target_type) for c in changes], CHANGE_SCHEMA)


@dataclass(frozen=True)
class EvolutionPolicy:
    """The changes that may pass. A type change is a pair (source type, target type)
    per column, a tuple or a list. Columns that disappear pass unless
    ``allow_removals`` is off.

    ``nested=True`` looks inside columns: additions and type changes are then named by path, as ``SchemaDrift.nested``
    spells it, and what is not allowed is reported by path. Tables of files cannot change
    inside a column, so writing to them goes by whole columns whatever the policy says of paths."""

    allowed_additions: Collection[str] = ()
    allowed_type_changes: Mapping[str, Sequence[str]] = field(default_factory=dict)
    allow_removals: bool = True
    nested: bool = False

    def __post_init__(self):
        if isinstance(self.allowed_additions, str):  # one name, not its letters
            object.__setattr__(self, "allowed_additions", (self.allowed_additions,))

    def allows(self, change: Change) -> bool:
        if change.kind == ADDED:
            return change.column in self.allowed_additions
        if change.kind == REMOVED:
            return self.allow_removals
        return tuple(self.allowed_type_changes.get(change.column, ())) == (change.source_type, change.target_type)

    def violations(self, drift: SchemaDrift) -> list[Change]:
        return [c for c in (drift.nested() if self.nested else drift.changes()) if not self.allows(c)]

    def by_column(self) -> EvolutionPolicy:
        """The same allowances, of whole columns."""
        return replace(self, nested=False)

    def validate(self, drift: SchemaDrift) -> None:
        """Raises once, naming every change that is not allowed."""
        refused = self.violations(drift)
        if refused:
            raise SchemaError("\n".join(map(str, refused)))


STRICT = EvolutionPolicy(allow_removals=False)
