"""Sums of order headers, to be grouped further."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillframe.functions.numbers import high_sum, joined, low_sum, places_of, units
from tillframe.operators.checks import require_columns


def order_sums(orders: DataFrame, *keys: str | Column) -> DataFrame:
    """Per group: `order_count`, `valued` (orders with a total), `high` and `low` (parts of the exact
    total), `highest`, `lowest` and, where orders have dates, `last_order_date`.

    Sums that a caller does not use are pruned, down to the scan. The metadata of `high`
    says how many decimal places the sums have.
    """
    require_columns(orders, ["order_id", "order_total"], "orders")
    value = units(orders, "order_total")
    places = {"places": places_of(orders.schema["order_total"].dataType)}
    last = [F.max("order_date").alias("last_order_date")] if "order_date" in orders.columns else []
    return orders.groupBy(*keys).agg(
        F.count("order_id").alias("order_count"),
        F.count("order_total").alias("valued"),
        high_sum(value).alias("high", metadata=places),
        low_sum(value).alias("low"),
        F.max("order_total").alias("highest"),
        F.min("order_total").alias("lowest"),
        *last,
    )


def customer_sums(orders: DataFrame) -> DataFrame:
    require_columns(orders, ["customer_id"], "orders")
    return order_sums(orders, "customer_id")


def shared(sums: DataFrame) -> DataFrame:
    """The same rows, with all sums part of each use: the condition always holds.

    Several analyses of a report then have the same plan up to here, and Spark groups the orders once.
    """
    return sums.filter(F.xxhash64(*sums.columns) >= F.lit(-(2**63)))


def group_total(sums: DataFrame) -> Column:
    """The exact total of a row of `order_sums`."""
    return joined(F.col("high"), F.col("low"), sums.schema["high"].metadata["places"])


def summed_total(sums: DataFrame) -> Column:
    """The exact total of a group of rows of `order_sums`."""
    return joined(F.sum("high"), F.sum("low"), sums.schema["high"].metadata["places"])
