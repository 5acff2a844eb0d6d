"""Exact money arithmetic, rounding, percentages and score tables."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, DecimalType, FloatType, IntegralType

from tillframe.constants import SECONDS_PER_HOUR, TDP_WATTS

#: Decimal places that a double or text may carry; decimals carry those of their type, whole numbers none.
PLACES = 4
#: Places of generated money.
CENT_PLACES = 2
LOW_BITS = 20


def places_of(kind: DataType) -> int:
    """Decimal places that are kept of values of this type."""
    if isinstance(kind, IntegralType):
        return 0
    return kind.scale if isinstance(kind, DecimalType) else PLACES


def units(df: DataFrame, name: str) -> Column:
    """Column `name` as a whole number that counts 10**-places_of its type.

    Sums and products of whole numbers do not depend on the order of the rows, and
    stay primitive, unlike decimals, in generated code. Nothing is rounded: a double
    with more than PLACES places raises an error that names the column, and so does a
    number beyond 64 bits; `operators.doubles` has the analyses for such values.
    """
    column, kind = F.col(name), df.schema[name].dataType
    places = places_of(kind)
    if isinstance(kind, IntegralType):
        return column.cast("bigint")
    if isinstance(kind, DecimalType):
        fitting = column.cast(f"decimal({max(19, places)},{places})")  # what 64 bits can hold; more raises
        return (fitting * F.lit(10**places).cast(f"decimal({places + 1},0)")).cast("bigint")
    value = column.cast("double")
    whole = F.rint(value * F.lit(float(10**places)))
    message = F.concat(F.lit(f"column {name} has more than {places} decimal places: "), value.cast("string"))
    back = whole / F.lit(float(10**places))
    same = back.cast(kind) == column if isinstance(kind, FloatType) else back == value
    return F.when(value.isNull(), None).when(same, whole.cast("bigint")).otherwise(
        F.raise_error(message).cast("bigint"))


def high_sum(value: Column) -> Column:
    return F.sum(F.shiftright(value, LOW_BITS))


def low_sum(value: Column) -> Column:
    return F.sum(value.bitwiseAND(F.lit(2**LOW_BITS - 1)))


def joined(high: Column, low: Column, places: int) -> Column:
    """The decimal that a high and a low sum stand for."""
    high, low = high.cast("decimal(20,0)"), low.cast("decimal(20,0)")
    return scaled(high * F.lit(2**LOW_BITS).cast("decimal(7,0)") + low, places)


def total(value: Column, places: int) -> Column:
    """Exact sum of a whole-number column that counts 10**-places, as a decimal.

    High and low bits are summed apart as 64-bit numbers, so that neither sum can
    overflow below eight trillion rows per group.
    """
    return joined(high_sum(value), low_sum(value), places)


def scaled(value: Column, places: int) -> Column:
    """A decimal that counts 10**-places, brought to units; exact below 10**(37 - 2 * places)."""
    whole = value.cast(f"decimal({37 - places},0)")
    parts = whole * F.lit(f"1e-{places}").cast(f"decimal({places},{places})") if places else whole
    return parts.cast(f"decimal(36,{places})")  # leaves room for the difference of two


def amount(value: Column, places: int = CENT_PLACES) -> Column:
    """A whole number that counts 10**-places, as a double."""
    return value / F.lit(float(10**places))


def quantity(df: DataFrame, name: str, value: Column) -> Column:
    """A sum of `units(df, name)`: whole if the column is whole, else a double."""
    kind = df.schema[name].dataType
    return value.cast("bigint") if isinstance(kind, IntegralType) else amount(value, places_of(kind)).cast("double")


def cents(value: Column) -> Column:
    """Round half up to two places; through a decimal, so that ties are decided alike everywhere."""
    return F.round(value.cast("decimal(28,8)"), 2).cast("double")


def mean(total: Column, rows: Column) -> Column:
    """`total / rows`, null when there are no rows."""
    return F.try_divide(total.cast("double"), rows.cast("double"))


def percent_of(value: Column, whole: Column) -> Column:
    """`value` as a percentage of `whole`, null when `whole` is zero or null."""
    return F.try_divide(value.cast("double"), whole.cast("double")) * 100


def percent_growth(value: Column, previous: Column) -> Column:
    """Percent change from `previous`; null unless `previous` is above zero."""
    change = (value - previous).cast("double") / previous.cast("double") * 100
    return F.when(previous > 0, change)


def clamp(value: Column, low: Column, high: Column) -> Column:
    return F.greatest(low, F.least(high, value))


def first_match(tests: Iterable[tuple[Column, object]], default: object) -> Column:
    """Value of the first test that holds, else `default`; a null never passes a test."""
    chain = reduce(lambda acc, rule: acc.when(rule[0], F.lit(rule[1])), tests, F)
    return chain.otherwise(F.lit(default))


def unit_total(df: DataFrame, name: str) -> Column:
    """Exact sum of a column, as a decimal."""
    return total(units(df, name), places_of(df.schema[name].dataType))


def score_at_most(value: Column, bins: Iterable[tuple], default: object) -> Column:
    return first_match(((value <= limit, score) for limit, score in bins), default)


def score_at_least(value: Column, bins: Iterable[tuple], default: object) -> Column:
    return first_match(((value >= limit, score) for limit, score in bins), default)


def energy_wh(cpu_seconds: Column, tdp_watts: float = TDP_WATTS) -> Column:
    """Watt-hours used by `cpu_seconds` of work on a processor of the given power."""
    return cpu_seconds * F.lit(float(tdp_watts)) / F.lit(float(SECONDS_PER_HOUR))
