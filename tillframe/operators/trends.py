"""Sales over time: overview, months and hours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillframe.functions.numbers import cents, mean, percent_growth
from tillframe.operators.checks import require_columns
from tillframe.operators.hotkeys import HotKeys
from tillframe.operators.orders import customer_sums, order_sums, summed_total
from tillframe.operators.revenue import revenue_sums, summed_revenue


def _year(date: str) -> Column:
    return F.year(date).cast("bigint").alias("year")


def _month(date: str) -> Column:
    return F.month(date).cast("bigint").alias("month")


def _hour(date: str) -> Column:
    return F.hour(date).cast("bigint").alias("hour")


def monthly_trends(orders: DataFrame, products: DataFrame | None, headers: DataFrame | None = None,
                   hot: HotKeys | None = None) -> DataFrame:
    """Revenue per month, with growth and change against the previous month on record.

    The first month has no growth and a change of zero. The window spans one row
    per calendar month, so its size is bounded by the calendar, not by the data.
    """
    return monthly_trends_of(revenue_sums(orders, products, ["order_date"], headers, hot))


def monthly_trends_of(sums: DataFrame) -> DataFrame:
    months = sums.groupBy(_year("order_date"), _month("order_date")).agg(
        summed_revenue(sums).alias("revenue")
    )
    previous = F.lag("revenue").over(Window.orderBy("year", "month"))
    revenue, before = F.col("revenue"), F.col("previous")
    return (
        months.withColumn("previous", previous)
        .select(
            "year",
            "month",
            cents(revenue).alias("monthly_revenue"),
            cents(percent_growth(revenue, before)).alias("monthly_growth_pct"),
            cents(F.coalesce(revenue - before, F.lit(0))).alias("revenue_change"),
        )
        .orderBy("year", "month")
    )


def _order_measures(sums: DataFrame) -> list[Column]:
    return [
        F.coalesce(F.sum("order_count"), F.lit(0)).alias("order_count"),
        summed_total(sums).alias("total"),
        F.sum("valued").alias("valued"),
    ]


def _total_and_mean() -> list[Column]:
    return [
        F.col("total").cast("double").alias("total_revenue"),
        mean(F.col("total"), F.col("valued")).alias("avg_order_value"),
    ]


def sales_overview(orders: DataFrame) -> DataFrame:
    """One row over all orders of every status."""
    return sales_overview_of(customer_sums(orders))


def sales_overview_of(sums: DataFrame) -> DataFrame:
    """The overview, from sums per customer."""
    return sums.agg(
        *_order_measures(sums),
        F.max("highest").alias("max_order_value"),
        F.min("lowest").alias("min_order_value"),
        F.count("customer_id").alias("unique_customers"),
    ).select(
        F.col("order_count").alias("total_orders"),
        *_total_and_mean(),
        "max_order_value",
        "min_order_value",
        "unique_customers",
    )


def calendar_sums(orders: DataFrame) -> DataFrame:
    """Sums per year, month and hour of the day; as many rows as the calendar has, at most."""
    require_columns(orders, ["order_date"], "orders")
    return order_sums(orders, _year("order_date"), _month("order_date"), _hour("order_date"))


def monthly_sales(orders: DataFrame) -> DataFrame:
    require_columns(orders, ["order_date"], "orders")
    return monthly_sales_of(order_sums(orders, _year("order_date"), _month("order_date")))


def monthly_sales_of(sums: DataFrame) -> DataFrame:
    return (
        sums.groupBy("year", "month")
        .agg(*_order_measures(sums))
        .select("year", "month", "order_count", *_total_and_mean())
        .orderBy("year", "month")
    )


def hourly_sales(orders: DataFrame) -> DataFrame:
    """Orders per hour of the day; hours without orders are left out."""
    require_columns(orders, ["order_date"], "orders")
    return hourly_sales_of(order_sums(orders, _hour("order_date")))


def hourly_sales_of(sums: DataFrame) -> DataFrame:
    return (
        sums.groupBy("hour")
        .agg(*_order_measures(sums))
        .select("hour", "order_count", *_total_and_mean())
        .orderBy("hour")
    )
