"""Customer segments by recency, frequency and monetary value."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from tillframe import constants as fixed
from tillframe.functions.numbers import score_at_least, score_at_most
from tillframe.operators.checks import require_columns
from tillframe.operators.orders import customer_sums, group_total


@dataclass(frozen=True)
class Thresholds:
    """Score tables: (limit, score) rows, the first that holds wins."""

    recency: tuple = fixed.RECENCY_DAYS_AT_MOST
    frequency: tuple = fixed.FREQUENCY_AT_LEAST
    monetary: tuple = fixed.MONETARY_AT_LEAST
    segment: tuple = fixed.SEGMENT_AT_LEAST


def _as_date(as_of: date | str | Column | None) -> Column:
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.to_date(F.lit(str(as_of)))


def rfm_metrics(orders: DataFrame, as_of: date | str | Column | None = None) -> DataFrame:
    """Last order, order count and spend per customer with orders; recency counts to `as_of`."""
    return _exact_metrics(_sums(orders), as_of).withColumn("monetary", F.col("monetary").cast("double"))


def _sums(orders: DataFrame) -> DataFrame:
    require_columns(orders, ["order_date"], "orders")
    return customer_sums(orders)


def _exact_metrics(sums: DataFrame, as_of: date | str | Column | None) -> DataFrame:
    return sums.select(
        "customer_id",
        "last_order_date",
        F.col("order_count").alias("frequency"),
        group_total(sums).alias("monetary"),
        F.datediff(_as_date(as_of), F.col("last_order_date").cast("date")).cast("bigint").alias("recency_days"),
    )


def rfm_scores(orders: DataFrame, as_of: date | str | Column | None = None,
               thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Metrics with a score from 1 to 5 each and their sum."""
    return rfm_scores_of(_sums(orders), as_of, thresholds)


def rfm_scores_of(sums: DataFrame, as_of: date | str | Column | None = None,
                  thresholds: Thresholds = Thresholds()) -> DataFrame:
    """The scores, from sums per customer."""
    parts = ("recency_score", "frequency_score", "monetary_score")
    scored = _exact_metrics(sums, as_of).select(
        "*",
        score_at_most(F.col("recency_days"), thresholds.recency, fixed.LOWEST_SCORE).alias(parts[0]),
        score_at_least(F.col("frequency"), thresholds.frequency, fixed.LOWEST_SCORE).alias(parts[1]),
        score_at_least(F.col("monetary"), thresholds.monetary, fixed.LOWEST_SCORE).alias(parts[2]),
    )
    return scored.withColumn("rfm_score", sum((F.col(p) for p in parts[1:]), F.col(parts[0]))).withColumn(
        "monetary", F.col("monetary").cast("double")
    )


def customer_segments(orders: DataFrame, as_of: date | str | Column | None = None,
                      thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Scores with the segment name; customers without orders do not appear."""
    return customer_segments_of(_sums(orders), as_of, thresholds)


def customer_segments_of(sums: DataFrame, as_of: date | str | Column | None = None,
                         thresholds: Thresholds = Thresholds()) -> DataFrame:
    """The segments, from sums per customer."""
    return rfm_scores_of(sums, as_of, thresholds).withColumn(
        "segment", score_at_least(F.col("rfm_score"), thresholds.segment, fixed.LOWEST_SEGMENT)
    )
