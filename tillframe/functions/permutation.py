"""A keyed permutation of row numbers: every row computes its own place in a shuffled order.

0 to n - 1 is laid out as a grid of `rows` x `columns` cells with fewer than `rows` numbers left over.
Feistel rounds add to one coordinate a keyed function of the other, which permutes the grid exactly. The grid is laid once
from the front and once from the back, in turn, so the numbers that one leaves over are moved by the other.
Each step is one-to-one on 0 to n - 1, hence so is their chain; nothing is sorted, counted or drawn again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

PRIME = 2**31 - 1
#: Both coordinates stay under PRIME, and products of two of them in 64 bits.
MOST_ROWS = 2**60
GRIDS, ROUNDS = 3, 4


@dataclass(frozen=True)
class Round:
    """Add `mix(other coordinate)` to one coordinate of the grid whose first cell is `start`."""

    start: int
    rows: int
    columns: int
    on_row: bool
    factors: tuple[int, int, int, int]

    def sql(self, place: str) -> str:
        """The new place as SQL that Spark and other engines share; `//` is division of whole numbers."""
        cell = f"({place} - {self.start})"
        row, column = f"({cell} // {self.columns})", f"({cell} % {self.columns})"
        moved = f"(({row} + {self._mix(column)}) % {self.rows}) * {self.columns} + {column}" if self.on_row \
            else f"{row} * {self.columns} + ({column} + {self._mix(row)}) % {self.columns}"
        inside = f"{place} BETWEEN {self.start} AND {self.start + self.rows * self.columns - 1}"
        return f"CASE WHEN {inside} THEN {self.start} + {moved} ELSE {place} END"

    def _mix(self, value: str) -> str:
        a, b, c, d = self.factors
        first = f"(({value} * {a} + {b}) % {PRIME})"
        return f"(((({first} * {first} + {c}) % {PRIME}) * {d} + {value}) % {PRIME})"


def rounds(n: int, seed: int = 42) -> Iterator[Round]:
    if n > MOST_ROWS:
        raise ValueError(f"{n} rows are more than {MOST_ROWS}")
    if n < 2:
        return
    rows = math.isqrt(n)
    columns = n // rows
    state = (seed * 0x9E3779B97F4A7C15 + 1) % 2**64
    for grid in range(GRIDS):
        for nth in range(ROUNDS):
            factors = []
            for _ in range(4):
                state = (state * 6364136223846793005 + 1442695040888963407) % 2**64
                factors.append(1 + (state >> 33) % (PRIME - 1))
            yield Round((n - rows * columns) * (grid % 2), rows, columns, nth % 2 == 0, tuple(factors))


def with_place(df: DataFrame, index: str, n: int, seed: int = 42, out: str = "place") -> DataFrame:
    """`df` with each row's place in the shuffled order; `index` holds 0 to n - 1, each once. Null stays null."""
    placed = df.withColumn(out, F.col(index).cast("bigint"))
    for step in rounds(n, seed):
        placed = placed.withColumn(out, F.expr(step.sql(f"`{out}`").replace("//", "DIV")))
    return placed


def in_shuffled_order(df: DataFrame, index: str, n: int, tasks: int, seed: int = 42, out: str = "place") -> DataFrame:
    """The rows in shuffled order: partition i holds the i-th run of places, in order. One exchange, no sampling."""
    each = max(1, -(-n // tasks))
    placed = with_place(df, index, n, seed, out)
    return placed.repartitionById(tasks, F.expr(f"CAST(`{out}` DIV {each} AS INT)")).sortWithinPartitions(out)
