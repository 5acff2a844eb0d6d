"""Column checks, table summaries and the comparison of two results."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def require_columns(df: DataFrame, names: Iterable[str], table: str = "table") -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"{table} lacks required column(s): {', '.join(missing)}")


def require_tables(tables: Mapping[str, DataFrame | None], names: Iterable[str]) -> None:
    missing = [name for name in names if tables.get(name) is None]
    if missing:
        raise ValueError(f"table(s) not loaded: {', '.join(missing)}")


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _rows(columns: Iterable[Column]) -> Column:
    """Turn a list of structs into rows."""
    return F.inline(F.array(*columns))


def schema_audit(tables: Mapping[str, DataFrame], required: Mapping[str, Iterable[str]]) -> DataFrame:
    """(table, column, present, filled_rows) for every required column.

    `filled_rows` counts non-null values, in one scan per table over the required
    columns only; it is null for an absent column.
    """

    def audit(table: str, names: list[str]) -> DataFrame:
        df = tables[table]
        counts = df.agg(*[F.count(name).alias(name) for name in names if name in df.columns])
        return counts.select(_rows(
            F.struct(
                F.lit(table).alias("table"),
                F.lit(name).alias("column"),
                F.lit(name in df.columns).alias("present"),
                (F.col(name) if name in df.columns else F.lit(None).cast("bigint")).alias("filled_rows"),
            )
            for name in names
        ))

    return union_all(audit(table, list(names)) for table, names in required.items())


def scan_summary(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, and the table's row and column counts."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count",
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        _rows(
            F.struct(
                F.lit(i).cast("bigint").alias("position"),
                F.lit(field.name).alias("column"),
                F.lit(field.dataType.simpleString()).alias("type"),
            )
            for i, field in enumerate(df.schema.fields, start=1)
        ),
    )


def table_row_counts(tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """(table, row_count) of every table that is loaded."""
    loaded = {name: df for name, df in tables.items() if df is not None}
    require_tables(loaded, [] if loaded else ["any"])
    return union_all(
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table"), "row_count")
        for name, df in loaded.items()
    )


def preview_rows(df: DataFrame, keys: list[str], n: int = 3) -> DataFrame:
    """The first n rows in key order."""
    return df.orderBy(*keys).limit(n)


def reconcile(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row that says whether two results hold the same rows, duplicates included.

    Rows of the left side count +1 and of the right side -1; one aggregation over
    whole rows then finds the surplus of each side. Equal rows combine before the
    shuffle, so a row that repeats very often costs no more than a rare one.
    """
    same_width = len(left.columns) == len(right.columns)
    if same_width:
        names = left.columns
        signed = left.select("*", F.lit(1).cast("bigint").alias("__side")).union(
            right.toDF(*names).select("*", F.lit(-1).cast("bigint").alias("__side"))
        )
        per_row = signed.groupBy(*names).agg(
            F.count_if(F.col("__side") > 0).alias("in_left"),
            F.count_if(F.col("__side") < 0).alias("in_right"),
        )
        surplus = F.col("in_left") - F.col("in_right")
        totals = per_row.agg(
            F.coalesce(F.sum("in_left"), F.lit(0)).alias("left_rows"),
            F.coalesce(F.sum("in_right"), F.lit(0)).alias("right_rows"),
            F.coalesce(F.sum(F.greatest(surplus, F.lit(0))), F.lit(0)).alias("only_left"),
            F.coalesce(F.sum(F.greatest(-surplus, F.lit(0))), F.lit(0)).alias("only_right"),
        )
    else:
        sides = union_all(
            df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(side).alias("side"), "n")
            for side, df in (("left", left), ("right", right))
        )
        totals = sides.agg(
            F.max(F.when(F.col("side") == "left", F.col("n"))).alias("left_rows"),
            F.max(F.when(F.col("side") == "right", F.col("n"))).alias("right_rows"),
            F.max(F.when(F.col("side") == "left", F.col("n"))).alias("only_left"),
            F.max(F.when(F.col("side") == "right", F.col("n"))).alias("only_right"),
        )
    same_shape = F.lit(same_width) & (F.col("left_rows") == F.col("right_rows"))
    return totals.select(
        "left_rows",
        "right_rows",
        F.lit(len(left.columns)).cast("bigint").alias("left_columns"),
        F.lit(len(right.columns)).cast("bigint").alias("right_columns"),
        same_shape.alias("same_shape"),
        "only_left",
        "only_right",
        (F.lit(same_width) & (F.col("only_left") == 0) & (F.col("only_right") == 0)).alias("same_rows"),
    )


def _unequal(left: Column, right: Column, tolerance: float | None) -> Column:
    if tolerance is None:
        return ~left.eqNullSafe(right)
    near = F.abs(left.cast("double") - right.cast("double")) <= F.lit(float(tolerance))
    return ~(left.eqNullSafe(right) | F.coalesce(near, F.lit(False)))


def match_by_key(left: DataFrame, right: DataFrame, keys: list[str], tolerances: Mapping[str, float] | None = None) -> DataFrame:
    """The keys whose rows differ: (keys, status, columns, and `<column>_left` and `<column>_right` of every other column).

    `status` is `only_left`, `only_right`, `repeated` (more than one row of the key on a side) or `differs`, for which
    `columns` names the columns that differ, in order and comma-joined. Keys match if both are null. Values are equal
    if both are null, or no further apart than the column's tolerance (default: none). Both sides are united and grouped by
    key, so a key that repeats very often is combined before the shuffle.
    """
    require_columns(left, keys, "left")
    columns = [name for name in left.columns if name not in keys]
    require_columns(right, [*keys, *columns], "right")
    tolerances = tolerances or {}
    named = [F.col(f"`{name}`") for name in (*keys, *columns)]
    both = left.select(*named, F.lit(True).alias("__left")).union(right.select(*named, F.lit(False).alias("__left")))
    per_key = both.groupBy(*keys).agg(
        F.count_if(F.col("__left")).alias("__in_left"), F.count_if(~F.col("__left")).alias("__in_right"),
        *[F.max(F.when(F.col("__left") == side, F.col(f"`{name}`"))).alias(f"{name}_{'left' if side else 'right'}")
          for name in columns for side in (True, False)])
    differing = F.array_compact(F.array(*[
        F.when(_unequal(F.col(f"`{name}_left`"), F.col(f"`{name}_right`"), tolerances.get(name)), F.lit(name)) for name in columns])
        if columns else F.array().cast("array<string>"))
    status = (F.when((F.col("__in_left") > 1) | (F.col("__in_right") > 1), "repeated").when(F.col("__in_right") == 0, "only_left")
              .when(F.col("__in_left") == 0, "only_right").when(F.size("__columns") > 0, "differs"))
    found = per_key.withColumn("__columns", differing).withColumn("status", status).filter("status is not null")
    return found.select(*keys, "status", F.when(F.col("status") == "differs", F.array_join("__columns", ",")).alias("columns"),
                        *[f"{name}_{side}" for name in columns for side in ("left", "right")])


def match_summary(matched: DataFrame, numbers: list[str]) -> DataFrame:
    """(status, columns, keys, and `<column>_change` for each of `numbers`): how many keys differ in which way, and right minus left, summed."""
    change = [F.sum(F.col(f"{name}_right").cast("double") - F.col(f"{name}_left").cast("double")).alias(f"{name}_change") for name in numbers]
    return matched.groupBy("status", "columns").agg(F.count(F.lit(1)).alias("keys"), *change)
