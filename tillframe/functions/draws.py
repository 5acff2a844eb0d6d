"""Random draws that depend only on a row's key, a seed and a name.

A row draws the same value on any executor, under any partitioning and after any
task retry. A draw takes 60 bits of one MD5 digest; a row that needs several small
draws splits those bits into lanes.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

HEX_DIGITS = 15
BITS = 4 * HEX_DIGITS
DOUBLE_BITS = 52


def _bits(key: str, seed: int, name: str) -> str:
    digest = f"md5(concat('{seed}:{name}:', CAST({key} AS STRING)))"
    return f"CAST(conv(substring({digest}, 1, {HEX_DIGITS}), 16, 10) AS BIGINT)"


def _fraction(source: str, lane: int, lanes: int) -> str:
    width = BITS // lanes
    kept = min(width, DOUBLE_BITS)
    lane_bits = f"shiftright({source}, {lane * width}) & {2**kept - 1}L"
    return f"(CAST({lane_bits} AS DOUBLE) + 0.5D) / {2**kept}D"


def bits(key: str, seed: int, name: str) -> Column:
    """Sixty bits drawn for a key, which is a column name or another SQL expression."""
    return F.expr(_bits(key, seed, name))


def fraction(source: str, lane: int = 0, lanes: int = 1) -> Column:
    """One lane of a column of bits as a double strictly between 0 and 1."""
    return F.expr(_fraction(source, lane, lanes))


def uniform(key: str, seed: int, name: str, lane: int = 0, lanes: int = 1) -> Column:
    return F.expr(_fraction(_bits(key, seed, name), lane, lanes))


def normal(key: str, seed: int, name: str) -> Column:
    """A standard normal draw by the Box-Muller formula."""
    radius = F.sqrt(F.lit(-2.0) * F.log(uniform(key, seed, name, 0, 2)))
    return radius * F.cos(F.lit(2 * math.pi) * uniform(key, seed, name, 1, 2))


def lomax(key: str, seed: int, name: str, shape: float) -> Column:
    """A Lomax (Pareto II) draw, kept to six places so that its sum is exact."""
    draw = F.pow(F.lit(1.0) - uniform(key, seed, name), F.lit(-1.0 / shape)) - F.lit(1.0)
    return draw.cast("decimal(24,6)")


def whole(draw: Column, low: int, high: int | Column) -> Column:
    """A whole number from `low` to `high`, both included."""
    width = (high - low + 1).cast("double") if isinstance(high, Column) else F.lit(float(high - low + 1))
    return F.lit(low) + F.floor(draw * width)


def hundredths(draw: Column, low: Column | float, high: Column | float) -> Column:
    """An amount from `low` to `high`, in hundredths."""
    low = low if isinstance(low, Column) else F.lit(float(low))
    high = high if isinstance(high, Column) else F.lit(float(high))
    return F.rint((low + draw * (high - low)) * 100).cast("bigint")


def position(draw: Column, length: int) -> Column:
    """A one-based position in a list of `length` values."""
    return F.floor(draw * F.lit(float(length))).cast("int") + 1


def pick(draw: Column, values: Sequence) -> Column:
    return F.element_at(F.lit(list(values)), position(draw, len(values)))
