"""Readable text from numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tillframe.constants import BYTE_UNITS


def readable_bytes(size: Column) -> Column:
    """`1536` -> `1.50 KB`; zero is `0 B`; the largest unit is TB.

    Hundredths are rounded as decimals, half to even, so no floating-point
    formatting decides the last place. The fourteen places of the quotient keep
    every size apart from a tie that is not one.
    """
    powers = range(len(BYTE_UNITS) - 1, 0, -1)

    def by_unit(values: list[Column]) -> Column:
        return F.coalesce(*[F.when(size >= 1024**k, values[k]) for k in powers], values[0])

    divisor = by_unit([F.lit(1024**k).cast("decimal(13,0)") for k in range(len(BYTE_UNITS))])
    hundredths = F.bround(size.cast("decimal(20,0)") * F.lit(100).cast("decimal(3,0)") / divisor, 0)
    number = (hundredths / F.lit(100).cast("decimal(3,0)")).cast("decimal(20,2)").cast("string")
    return F.when(size == 0, F.lit("0 B")).otherwise(
        F.concat(number, F.lit(" "), by_unit([F.lit(unit) for unit in BYTE_UNITS]))
    )
