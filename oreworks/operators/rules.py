"""Data-quality rules.

A rule names the aggregates it needs and turns their values into a verdict. It
runs nothing itself; ``checks.evaluate`` runs all rules of a set together.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, DateType, StringType, TimestampNTZType, TimestampType

from oreworks.functions.frames import quoted

ROWS = "rows"
MICROS_PER_MINUTE = 60_000_000


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


@dataclass(frozen=True)
class Rule:
    @property
    def name(self) -> str:
        raise NotImplementedError

    def measures(self, df: DataFrame) -> dict[str, Column]:
        """Aggregates that need no shuffle beyond one row per task."""
        return {}

    def keys(self, df: DataFrame) -> dict[str, Column]:
        """Structs whose distinct values are to be counted."""
        return {}

    def settled(self, df: DataFrame) -> dict[str, int]:
        """Numbers that take more than an aggregate: jobs run to find them."""
        return {}

    def verdict(self, value: Mapping[str, Column]) -> tuple[Column, Column]:
        """``(passed, details)`` over the measured values."""
        raise NotImplementedError


@dataclass(frozen=True)
class RowCount(Rule):
    """At least ``min_rows``, and no more than ``max_rows`` if given; both inclusive."""

    min_rows: int = 1
    max_rows: int | None = None

    @property
    def name(self) -> str:
        return "row_count"

    def measures(self, df):
        return {ROWS: F.count("*")}

    def verdict(self, value):
        rows = value[ROWS]
        details = _text("rows=", rows, f", min_required={self.min_rows}")
        if self.max_rows is None:
            return rows >= self.min_rows, details
        return rows.between(self.min_rows, self.max_rows), _text(details, f", max_allowed={self.max_rows}")


@dataclass(frozen=True)
class NotNull(Rule):
    column: str

    @property
    def name(self) -> str:
        return f"not_null_{self.column}"

    def measures(self, df):
        # Two counts, which a source that keeps statistics answers without its rows.
        return {ROWS: F.count("*"), f"present {self.column}": F.count(F.col(self.column))}

    def verdict(self, value):
        nulls = value[ROWS] - value[f"present {self.column}"]
        return nulls == 0, _text("nulls=", nulls)


# Hashes sent to every task at most: 8 MB.
BROADCAST_HASHES = 1 << 20


def key_hash(columns: Sequence[str]) -> Column:
    """64 bits of a key; unlike keys may share them."""
    return F.xxhash64(*columns)


@dataclass(frozen=True)
class UniqueKey(Rule):
    """As many distinct keys as rows. NULL is a key like any other: one may occur.

    ``digest=True`` shuffles SHA-256 digests in place of string and binary key
    columns, for keys that are whole texts; equal digests count as equal keys.

    ``hashed=True`` is exact and shuffles 8 bytes a row, for wide keys: 64-bit hashes are counted first, in a job of its
    own. Only rows whose hash occurs more than once are read again and compared by their keys.
    """

    columns: tuple[str, ...]
    digest: bool = False
    hashed: bool = False

    def __post_init__(self):
        if isinstance(self.columns, str):
            object.__setattr__(self, "columns", (self.columns,))
        if not self.columns:
            raise ValueError("a key needs a column")
        if self.digest and self.hashed:
            raise ValueError("a key is counted by digests or by hashes")

    @property
    def name(self) -> str:
        return "pk_unique_" + "_".join(self.columns)

    @property
    def _measure(self) -> str:
        return f"distinct {self.digest} {self.hashed} {self.columns}"

    def measures(self, df):
        return {ROWS: F.count("*")}

    def keys(self, df):
        return {} if self.hashed else {self._measure: F.struct(*[self._part(df, i, c) for i, c in enumerate(self.columns)])}

    def settled(self, df):
        if not self.hashed:
            return {}
        keys = df.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(self.columns)])
        keys = keys.withColumn("h", key_hash(keys.columns))
        hashes = keys.groupBy("h").agg(F.count("*").alias("n"))
        found = hashes.agg(F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") > 1).alias("more")).first()
        if not found.more:
            return {self._measure: found.once}
        repeated = hashes.where("n > 1").select("h")
        if found.more <= BROADCAST_HASHES:
            repeated = F.broadcast(repeated)
        again = keys.join(repeated, "h", "left_semi").drop("h").distinct().count()
        return {self._measure: found.once + again}

    def _part(self, df: DataFrame, position: int, column: str) -> Column:
        part = F.col(column)
        if self.digest and isinstance(df.select(part).schema[0].dataType, (StringType, BinaryType)):
            part = F.unhex(F.sha2(part, 256))
        return part.alias(f"k{position}")

    def verdict(self, value):
        rows, distinct = value[ROWS], value[self._measure]
        return rows == distinct, _text("total=", rows, ", distinct=", distinct)


@dataclass(frozen=True)
class Fresh(Rule):
    """The newest timestamp is at most ``max_delay_minutes`` older than ``as_of``
    (default: now). Without any timestamp the rule fails.

    Timestamps without zone, dates and a naive ``as_of`` are read as UTC.
    """

    column: str
    max_delay_minutes: float
    as_of: dt.datetime | None = None

    @property
    def name(self) -> str:
        return f"freshness_{self.column}"

    def measures(self, df):
        column = F.col(self.column)
        kind = df.select(column).schema[0].dataType
        if not isinstance(kind, (TimestampType, TimestampNTZType, DateType)):
            raise TypeError(f"{self.column} is {kind.simpleString()}, not a date or timestamp")
        latest = F.max(column)
        if not isinstance(kind, TimestampType):
            # Spelled out with its zone, so that the session's zone plays no part.
            latest = F.concat(latest.cast("timestamp_ntz").cast("string"), F.lit("Z")).cast("timestamp")
        return {ROWS: F.count("*"), f"latest {self.column}": F.unix_micros(latest)}

    def _now(self) -> Column:
        if self.as_of is None:
            return F.unix_micros(F.current_timestamp())
        moment = self.as_of if self.as_of.tzinfo else self.as_of.replace(tzinfo=dt.timezone.utc)
        epoch = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
        return F.lit((moment - epoch) // dt.timedelta(microseconds=1))

    def verdict(self, value):
        delay = self._now() - value[f"latest {self.column}"]
        limit = round(self.max_delay_minutes * MICROS_PER_MINUTE)
        minutes = (delay.cast("decimal(20,0)") / F.lit(MICROS_PER_MINUTE)).cast("decimal(20,6)")
        details = _text("delay_minutes=", minutes, f", max_delay_minutes={self.max_delay_minutes}")
        absent = F.when(value[ROWS] == 0, "no rows").otherwise("no values")
        return F.coalesce(delay <= limit, F.lit(False)), F.coalesce(details, absent)


@dataclass(frozen=True)
class CorruptRecords(Rule):
    """Lines of a text source set aside as unreadable: at most ``tolerated``, or with
    None any number, which are then only counted."""

    tolerated: int | None = 0
    column: str = "_corrupt_record"
    stored: bool = False  # the frame is a table: its lines were parsed when it was written

    @property
    def name(self) -> str:
        return "corrupt_records"

    def measures(self, df):
        # Spark parses only the columns a plan asks for, and a bad value in any other goes unseen.
        line = F.col(self.column)
        seen = line if self.stored else F.when(line.isNotNull(), F.struct(*[F.col(quoted(c)) for c in df.columns]))
        return {f"corrupt {self.column}": F.count(seen)}

    def verdict(self, value):
        corrupt = value[f"corrupt {self.column}"]
        passed = F.lit(True) if self.tolerated is None else corrupt <= self.tolerated
        return passed, _text("corrupt=", corrupt)
