"""Steps for ``DataFrame.transform``: each returns ``DataFrame -> DataFrame``.

All are built-in column expressions, so filters and column lists reach the scan
and grouped results are combined within each task before they are shuffled; a
group that holds most of the rows costs one partial row per task.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType

Transform = Callable[[DataFrame], DataFrame]


def same(df: DataFrame) -> DataFrame:
    return df


def rename(old: str, new: str) -> Transform:
    """Rename a column. Unlike ``withColumnRenamed``, refuses a frame without it."""

    def step(df: DataFrame) -> DataFrame:
        if old not in df.columns:
            raise ValueError(f"no column {old!r} to rename in {df.columns}")
        return df.withColumnRenamed(old, new)

    return step


def pick(column: str) -> Transform:
    return lambda df: df.select(column)


def keep_positive(column: str) -> Transform:
    """Rows above zero. NULL is dropped; NaN is kept, as it sorts above all numbers."""
    return lambda df: df.filter(F.col(column) > 0)


def keep_not_null(column: str) -> Transform:
    return lambda df: df.filter(F.col(column).isNotNull())


def keep_null(column: str) -> Transform:
    return lambda df: df.filter(F.col(column).isNull())


def as_decimal(column: str, precision: int = 18, scale: int = 2) -> Transform:
    """A number as decimal, rounded half up to ``scale`` places."""
    return lambda df: df.withColumn(column, F.col(column).cast(f"decimal({precision},{scale})"))


def total(value: str, by: str, alias: str) -> Transform:
    """Sum per group in the column's own type. Keep money as decimal: a sum of
    doubles depends on the order in which tasks finish."""
    return lambda df: df.groupBy(by).agg(F.sum(value).alias(alias))


@dataclass(frozen=True)
class Rollup:
    """A grouped result that can be put together from those of parts of the rows: ``merge`` over the
    ``partial`` rows of any parts gives what ``whole`` gives over all rows. It is itself the step ``whole``."""

    whole: Transform
    partial: Transform
    merge: Transform

    def __call__(self, df: DataFrame) -> DataFrame:
        return df.transform(self.whole)


# Exact sums hold numbers as digits of ten: a number is digits times 10 ** (6 * scale). Sums of digits have 16 places behind
# the point and 22 before it.
SCALE, DIGITS, ODD = "scale_of_ten", "digits", "beyond"
_PLACES, _FRACTION, _LIMBS = 6, 18, 7  # digits of a scale, places that limbs have behind the point, scales that a sum fills
_BASE = 10**_PLACES
_SUM = "decimal(38,16)"
# Scales that sums are kept at, each for numbers from its one on to where the next begins, and where the last ends.
_KEPT, _END = (-4, -2, 0, 2), 4


def _digits(value: Column, plain: bool, scale: Column | int) -> Column:
    """The decimal number that the shortest text of a finite number spells, in units of 10 ** (6 * scale); the number is one unit or more,
    and less than 10 ** 12 of them. Exact: 17 digits leave 16 places behind the point at most."""
    text = value.cast("string")
    mantissa, exponent = F.substring_index(text, "E", 1), F.coalesce(F.substring_index(text, "E", -1).try_cast("int"), F.lit(0))
    written = F.contains(text, F.lit("E"))
    tens = F.array(*[F.lit(Decimal(10) ** i).cast("decimal(13,0)") for i in range(2 * _PLACES + 1)])

    def times(number: Column, power: Column) -> Column:
        return (number * F.get(tens, power)).cast("decimal(28,16)")

    large = times(mantissa.try_cast("decimal(18,17)"), exponent - F.lit(scale) * _PLACES)
    # Written out, a number is 0.001 or more and less than ten millions.
    small = times(text.try_cast("decimal(21,20)"), -F.lit(scale) * _PLACES)
    same = value.try_cast("decimal(28,16)") if plain else text.try_cast("decimal(28,16)")
    return F.when(written, large).when(F.lit(scale) < 0, small).otherwise(same)


def _plain(digits: Column) -> Column:
    """The text of a sum, never with an exponent."""
    return F.replace(F.format_number(digits, _FRACTION), F.lit(","), F.lit(""))


def _limbs(digits: Column) -> Column:
    """The text of a sum without its point and sign, as long as all its scales."""
    return F.lpad(F.replace(_plain(F.abs(digits)), F.lit("."), F.lit("")), _LIMBS * _PLACES, "0")


def _nearest(parts: Column) -> Column:
    """The double nearest to the sum of (scale, digits), each sum taken apart into limbs of six digits."""
    held = F.transform(parts, lambda x: F.struct(x[SCALE].alias("at"), F.signum(x[DIGITS].cast("double")).cast("long").alias("sign"), _limbs(x[DIGITS]).alias("text")))
    low = F.array_min(F.transform(parts, lambda x: x[SCALE])) - _FRACTION // _PLACES
    high = F.array_max(F.transform(parts, lambda x: x[SCALE])) + _LIMBS

    def total(place: Column) -> Column:
        def add(sum_: Column, x: Column) -> Column:
            limb = place - x["at"] + _FRACTION // _PLACES
            there = limb.between(0, _LIMBS - 1)
            return sum_ + F.when(there, x["sign"] * F.substring(x["text"], (_LIMBS - 1 - limb) * _PLACES + 1, F.lit(_PLACES)).cast("long")).otherwise(0)

        return F.aggregate(held, F.lit(0).cast("long"), add)

    totals = F.transform(F.sequence(low, high), total)

    def carried(sign: int) -> Column:
        def step(state: Column, limb: Column) -> Column:
            sum_ = state["carry"] + sign * limb
            rest = F.pmod(sum_, F.lit(_BASE))
            return F.struct(((sum_ - rest) / _BASE).cast("long").alias("carry"), F.concat(F.lpad(rest.cast("string"), _PLACES, "0"), state["text"]).alias("text"))

        return F.aggregate(totals, F.struct(F.lit(0).cast("long").alias("carry"), F.lit("").alias("text")), step)

    def read(state: Column) -> Column:
        return F.concat(state["carry"].cast("string"), state["text"], F.lit("E"), (low * _PLACES).cast("string")).cast("double")

    up = carried(1)
    return F.when(up["carry"] >= 0, read(up)).otherwise(-read(carried(-1)))


def _kind(df: DataFrame, value: str) -> type:
    return type(df.schema[value].dataType)


def exact_total(value: str, by: str, alias: str) -> Rollup:
    """Sum per group: of doubles the exact sum of the decimal numbers they are written as, and of that the nearest double.
    So the order in which tasks finish plays no part, and cents add up to cents.

    Sums are kept per group in four decimals, for sizes from 1e-24, 1e-12, 1 and 1e12 on, 1e10 values each at least. Sizes from 1e24 on or
    below 1e-24, NaN and infinities, are added up as doubles of their own and added at the end (``any_total`` is exact for
    all sizes). Other types are summed as ``total`` does."""
    columns = {scale: f"{DIGITS}_{i}" for i, scale in enumerate(_KEPT)}

    def is_float(df: DataFrame) -> bool:
        return _kind(df, value) in (DoubleType, FloatType)

    def partial(df: DataFrame) -> DataFrame:
        if not is_float(df):
            return df.transform(total(value, by, alias))
        plain, size = _kind(df, value) is DoubleType, F.abs(F.col(value))
        sums, least = [], 10.0 ** (_PLACES * _KEPT[0])
        for scale, end in zip(_KEPT, (*_KEPT[1:], _END), strict=True):
            there = (size >= 10.0 ** (_PLACES * scale)) & (size < 10.0 ** (_PLACES * end))
            there = there | (size == 0) if scale == 0 else there
            sums.append(F.sum(F.when(there, _digits(F.col(value), plain, scale))).cast(_SUM).alias(columns[scale]))
        beyond = (size >= 10.0 ** (_PLACES * _END)) | F.isnan(value) | ((size < least) & (size > 0))
        return df.groupBy(by).agg(*sums, F.sum(F.when(beyond, F.col(value).cast("double"))).alias(ODD))

    def finished(sums: DataFrame) -> DataFrame:
        parts = F.filter(F.array(*[F.struct(F.lit(k).alias(SCALE), F.col(c).alias(DIGITS)) for k, c in columns.items()]), lambda x: x[DIGITS].isNotNull())
        others = F.coalesce(*[F.col(c) for k, c in columns.items() if k])
        # Sums at scale 0 alone are the number itself.
        exact = F.when(others.isNull(), F.col(columns[0]).cast("double")).otherwise(_nearest(parts))
        sum_ = F.when(F.col(ODD).isNull(), exact).otherwise(F.col(ODD) + F.coalesce(exact, F.lit(0.0)))
        return sums.select(by, sum_.alias(alias))

    def merge(parts: DataFrame) -> DataFrame:
        if ODD not in parts.columns:
            return parts.groupBy(by).agg(F.sum(alias).cast(parts.schema[alias].dataType).alias(alias))
        added = [F.sum(c).cast(_SUM).alias(c) for c in columns.values()]
        return parts.groupBy(by).agg(*added, F.sum(ODD).alias(ODD)).transform(finished)

    def whole(df: DataFrame) -> DataFrame:
        return df.transform(partial).transform(finished) if is_float(df) else df.transform(total(value, by, alias))

    return Rollup(whole, partial, merge)


def any_total(value: str, by: str, alias: str) -> Transform:
    """``exact_total`` for doubles of any size: sums are shuffled per group and scale, and a group's scales, some hundred at
    most, are listed. NaN and infinities are summed among themselves."""

    def step(df: DataFrame) -> DataFrame:
        number = F.col(value)
        text = number.cast("string")
        # Written with an exponent, a number has one digit before the point; else it is 0.001 or more, and has scale -1 below 1.
        scale = F.floor(F.substring_index(text, "E", -1).try_cast("int") / _PLACES).cast("int")
        scale = F.when(F.contains(text, F.lit("E")), scale).when((F.abs(number) < 1) & (number != 0), -1).otherwise(0)
        finite = F.abs(number) < float("inf")
        parts = df.select(by, F.when(finite, scale).alias(SCALE), number.alias("number"), F.when(~finite, number.cast("double")).alias(ODD))
        digits = F.when(F.col(SCALE).isNotNull(), _digits(F.col("number"), _kind(df, value) is DoubleType, F.col(SCALE)))
        sums = parts.groupBy(by, SCALE).agg(F.sum(digits).cast(_SUM).alias(DIGITS), F.sum(ODD).alias(ODD))
        listed = F.collect_list(F.when(F.col(DIGITS).isNotNull(), F.struct(SCALE, DIGITS)))
        sums = sums.groupBy(by).agg(listed.alias("parts"), F.sum(ODD).alias(ODD))
        return sums.select(by, F.coalesce(ODD, F.when(F.size("parts") > 0, _nearest(F.col("parts")))).alias(alias))

    return step


def row_counts(by: str, alias: str) -> Rollup:
    count = lambda df: df.groupBy(by).agg(F.count("*").alias(alias))
    return Rollup(count, count, lambda parts: parts.groupBy(by).agg(F.sum(alias).alias(alias)))


def then(*steps: Transform) -> Transform:
    """Several steps as one."""

    def chained(df: DataFrame) -> DataFrame:
        for step in steps:
            df = df.transform(step)
        return df

    return chained
