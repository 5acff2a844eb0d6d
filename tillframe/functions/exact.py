"""Exact sums of doubles of any size, independent of the order of the rows.

A double is cut into four whole numbers of 24 bits, counted in powers of 2**24 from its own
band downwards; the cut is exact. Whole numbers of one band add up exactly in 64 bits, for up to
5 * 10**11 rows of a group. The bands of a group, 88 at most, are then carried
into digits, and the digits are rounded once: the result is the double nearest to the
true sum, as `math.fsum` gives it. All of it is built-in functions.

Defined cases: null values do not count; a group without values has a null sum. A group with NaN or
infinite values has the sum that IEEE addition gives of those. A sum beyond the largest
double is infinite; zero is positive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

BITS = 24
PARTS = 4


def is_special(value: Column) -> Column:
    return F.isnan(value) | (F.abs(value) == F.lit(float("inf")))


def band(value: Column) -> Column:
    """The power of 2**BITS that the value's leading bits count; 0 for zero, null for special values."""
    size = F.abs(value)
    found = F.floor(F.log2(size) / BITS).cast("int")
    return F.when(value.isNull() | is_special(value), None).when(value == 0, 0).otherwise(found)


def _power(exponent: Column) -> Column:
    return F.pow(F.lit(2.0), exponent.cast("double"))


def part_columns(value: Column, of: Column) -> list[Column]:
    """The value as PARTS signed whole numbers, the first in units of 2**(BITS * of), each next in finer ones."""
    half = _power(-of * (BITS // 2))  # in two steps, since the whole power may not be a double
    rest, parts = F.abs(value) * half * half, []
    sign = F.when(value < 0, -1).otherwise(1).cast("bigint")
    for _ in range(PARTS):
        whole = F.floor(rest)
        parts.append(whole.cast("bigint") * sign)
        rest = (rest - whole.cast("double")) * F.lit(float(1 << BITS))
    return parts


def banded(df: DataFrame, keys: list, value: Column, *others: Column) -> DataFrame:
    """Partial sums: per keys and band `part_0` to `part_3`, `counted`, and `special`, the sum of NaN and infinite values.

    `others` are further aggregates, to be added up (or otherwise merged) over the bands.
    """
    of = band(value)
    parts = [F.sum(part).alias(f"part_{i}") for i, part in enumerate(part_columns(value, of))]
    return df.groupBy(*keys, of.alias("band")).agg(
        *parts, F.count(value).alias("counted"), F.sum(F.when(is_special(value), value)).alias("special"), *others)


def merged(df: DataFrame, keys: list, *others: Column) -> DataFrame:
    """Rows of `banded` summed again over coarser keys."""
    return df.groupBy(*keys, "band").agg(
        *[F.sum(f"part_{i}").alias(f"part_{i}") for i in range(PARTS)], F.sum("counted").alias("counted"),
        F.sum("special").alias("special"), *others)


def exact_total() -> Column:
    """The aggregate that makes a double of the rows of `banded` or `merged` of one group."""
    rows = F.collect_list(F.when(F.col("band").isNotNull(), F.struct("band", F.array(*[f"part_{i}" for i in range(PARTS)]).alias("parts"))))
    return F.when(F.sum("counted") == 0, None).otherwise(F.coalesce(F.sum("special"), rounded(rows)))


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def rounded(rows: Column) -> Column:
    """Bands with their parts, as one double; at most 88 short rows."""
    return _with(rows, lambda found: F.when(F.size(found) > 0, _with(
        F.struct((F.array_min(F.transform(found, lambda row: row["band"])) - PARTS + 1).alias("low"),
                 (F.array_max(F.transform(found, lambda row: row["band"])) + PARTS).alias("high")),
        lambda ends: _with(_digits(found, ends["low"], ends["high"]), lambda digits: _with(
            _carried(digits)["carry"] < 0, lambda negative: _with(
                F.reverse(_carried(F.transform(digits, lambda digit: F.when(negative, -digit).otherwise(digit)))["digits"]),
                lambda leading: F.when(negative, -_nearest(leading, ends["high"])).otherwise(_nearest(leading, ends["high"])))))))
        .otherwise(0.0))


def _digits(rows: Column, low: Column, high: Column) -> Column:
    """For each power of 2**BITS, from the lowest up, what the bands hold of it; high bits of a sum go to the next power, so nothing overflows."""
    mask = F.lit((1 << BITS) - 1).cast("bigint")
    none = F.lit(0).cast("bigint")
    return F.transform(F.sequence(low, high), lambda at: F.aggregate(rows, none, lambda total, row: (
        total + F.coalesce(F.get(row["parts"], row["band"] - at).bitwiseAND(mask), none)
        + F.coalesce(F.shiftright(F.get(row["parts"], row["band"] - at + 1), BITS), none))))


def _carried(digits: Column) -> Column:
    """(digits, carry): digits brought to 0 .. 2**BITS - 1, from the lowest up."""
    start = F.struct(F.array().cast("array<bigint>").alias("digits"), F.lit(0).cast("bigint").alias("carry"))
    mask = F.lit((1 << BITS) - 1).cast("bigint")
    return F.aggregate(digits, start, lambda state, digit: F.struct(
        F.array_append(state["digits"], (digit + state["carry"]).bitwiseAND(mask)).alias("digits"),
        F.shiftright(digit + state["carry"], BITS).alias("carry")))


def _nearest(digits: Column, high: Column) -> Column:
    """The double nearest to digits, the leading one first, which counts 2**(BITS * high)."""

    def two(at: Column) -> Column:
        return (F.coalesce(F.get(digits, at), F.lit(0).cast("bigint")) * (1 << BITS) + F.coalesce(F.get(digits, at + 1), F.lit(0).cast("bigint"))).cast("decimal(15,0)")

    def value(top: Column) -> Column:
        left = F.slice(digits, top + PARTS, F.greatest(F.size(digits) - PARTS - top + 1, F.lit(0)))
        sticky = F.when(F.exists(left, lambda digit: digit != 0), 1).otherwise(0).cast("decimal(1,0)")
        lead = two(top - 1) * F.lit(1 << 2 * BITS).cast("decimal(15,0)") + two(top + 1)
        whole = (lead.cast("decimal(36,0)") * F.lit(2).cast("decimal(1,0)") + sticky).cast("decimal(38,0)").cast("double")
        exponent = (high - (top - 1) - (PARTS - 1)) * BITS - 1
        half = F.floor(exponent / 2)
        return whole * _power(half) * _power(exponent - half)

    first = F.array_position(F.transform(digits, lambda digit: digit != 0), True).cast("int")
    return _with(first, lambda top: F.when(top == 0, 0.0).otherwise(value(top)))


def exact_sums(df: DataFrame, keys: list[str], **values: Column) -> DataFrame:
    """(keys, one column per value): the exact sums of doubles per group.

    Several values are summed side by side, as rows that name their value.
    """
    names = list(values)
    kept = df.select(*keys, F.inline(F.array(*[F.struct(F.lit(name).alias("__name"), value.cast("double").alias("__value")) for name, value in values.items()])))
    totals = banded(kept, [*keys, "__name"], F.col("__value")).groupBy(*keys, "__name").agg(exact_total().alias("__total"))
    return totals.groupBy(*keys).agg(*[F.max(F.when(F.col("__name") == name, F.col("__total"))).alias(name) for name in names])
