"""Sales per product and per product category, from order items."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillframe.constants import TOP_ROWS
from tillframe.functions.numbers import quantity, unit_total, units
from tillframe.operators.checks import require_columns


def _sold(order_items: DataFrame, products: DataFrame, *keep: str) -> DataFrame:
    """Items summed per product, then matched with the products.

    Summing first means that a product with very many items reaches the join as
    one row, and the join and every later grouping that includes product_id reuse
    the partitioning of the sum.
    """
    require_columns(order_items, ["order_id", "product_id", "quantity", "total_price"], "order_items")
    require_columns(products, ["product_id", *keep], "products")
    per_product = order_items.groupBy("product_id").agg(
        F.sum(units(order_items, "quantity")).alias("sold"),
        unit_total(order_items, "total_price").alias("revenue"),
        F.count("order_id").alias("items"),
    )
    return per_product.join(products.select("product_id", *keep), "product_id")


def top_products(order_items: DataFrame, products: DataFrame, n: int = TOP_ROWS) -> DataFrame:
    """The n products with most revenue; `order_count` counts items."""
    keys = ["product_id", "product_name", "category"]
    return (
        _sold(order_items, products, "product_name", "category")
        .groupBy(*keys)
        .agg(
            quantity(order_items, "quantity", F.sum("sold")).alias("total_quantity_sold"),
            F.sum("revenue").cast("double").alias("total_revenue"),
            F.sum("items").alias("order_count"),
        )
        .orderBy(F.desc("total_revenue"), *keys)
        .limit(n)
    )


def category_performance(order_items: DataFrame, products: DataFrame) -> DataFrame:
    return (
        _sold(order_items, products, "category")
        .groupBy("category")
        .agg(
            quantity(order_items, "quantity", F.sum("sold")).alias("total_quantity_sold"),
            F.sum("revenue").cast("double").alias("total_revenue"),
            F.countDistinct("product_id").alias("unique_products"),
            F.sum("items").alias("order_count"),
        )
        .orderBy(F.desc("total_revenue"), "category")
    )
