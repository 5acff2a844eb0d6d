"""Shares of a total, ratios to a baseline row, and the best row per metric.

Totals and baselines are scalar subqueries: one row each, whatever the input size.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from tillframe.constants import TDP_WATTS
from tillframe.functions.numbers import energy_wh, percent_of
from tillframe.operators.checks import require_columns


def share_of_total(df: DataFrame, metric: str, out: str = "share_pct") -> DataFrame:
    """Add each row's percentage of the column total."""
    require_columns(df, [metric])
    whole = df.agg(F.sum(metric)).scalar()
    return df.withColumn(out, percent_of(F.col(metric), whole))


def ratio_to_baseline(df: DataFrame, name: str, baseline: str, metrics: Mapping[str, str]) -> DataFrame:
    """Add each metric as a percentage of the row called `baseline`.

    `metrics` maps a metric to its output column. A missing baseline counts as 1.
    """
    require_columns(df, [name, *metrics])
    base = (
        df.filter(F.col(name) == baseline)
        .agg(F.struct(*[F.max(metric).alias(metric) for metric in metrics]))
        .scalar()
    )
    return df.select(
        "*",
        *[
            percent_of(F.col(metric), F.coalesce(base.getField(metric), F.lit(1))).alias(out)
            for metric, out in metrics.items()
        ],
    )


def best_by_metric(df: DataFrame, name: str, metrics: list[str], error: str | None = None) -> DataFrame:
    """(metric, best, value): the row with the smallest value of each metric.

    Rows with an error are left out, equal values go to the first name, and a
    metric that no row has is null. One pass finds all metrics.
    """
    require_columns(df, [name, *metrics])
    valid = df.filter(F.col(error).isNull()) if error else df
    smallest = valid.agg(
        *[
            F.min(F.when(
                F.col(metric).isNotNull(),
                F.struct(F.col(metric).cast("double").alias("value"), F.col(name).alias("best")),
            )).alias(metric)
            for metric in metrics
        ]
    )
    return smallest.select(F.inline(F.array(*[
        F.struct(
            F.lit(metric).alias("metric"),
            F.col(metric)["best"].alias("best"),
            F.col(metric)["value"].alias("value"),
        )
        for metric in metrics
    ])))


def energy_estimate(df: DataFrame, cpu_seconds: str, tdp_watts: float = TDP_WATTS,
                    out: str = "energy_consumption_wh") -> DataFrame:
    require_columns(df, [cpu_seconds])
    return df.withColumn(out, energy_wh(F.col(cpu_seconds), tdp_watts))


