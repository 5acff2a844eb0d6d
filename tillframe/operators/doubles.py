"""The revenue analyses for doubles of any size and any number of places.

Quantity times price is the double product; every sum is exact and rounded once (`functions.exact`), so
results do not depend on the order of the rows or on how they are split. Columns
are those of the analyses of the same name, which are faster where values have up to four places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tillframe.constants import TOP_ROWS
from tillframe.functions import exact
from tillframe.functions.numbers import mean, percent_growth
from tillframe.operators.checks import require_columns


def _two_places(value):
    """Round half up to two places, without a limit on size: from 2**43 on, a double has no more than ten places to lose."""
    return F.when(F.abs(value) < 2.0**43, F.round(value.cast("decimal(38,18)"), 2).cast("double")).otherwise(value)


def _lines(orders: DataFrame, products: DataFrame, *keep: str) -> DataFrame:
    require_columns(orders, ["product_id", "quantity", *keep], "orders")
    require_columns(products, ["product_id", "price"], "products")
    prices = products.select("product_id", F.col("price").cast("double").alias("price"))
    lines = orders.select("product_id", *keep, F.col("quantity").cast("double").alias("quantity"))
    return lines.join(prices, "product_id").withColumn("revenue", F.col("quantity") * F.col("price"))


def revenue_bands(orders: DataFrame, products: DataFrame, keys: list[str], headers: DataFrame | None = None) -> DataFrame:
    """Partial sums of `exact.banded` per keys, with `lines`, the lines that have an order id.

    With headers, lines are summed per order before they meet the keys, and again per keys.
    """
    lines = F.count("order_id").alias("lines")
    if headers is None:
        return exact.banded(_lines(orders, products, "order_id", *keys), keys, F.col("revenue"), lines)
    require_columns(headers, ["order_id", *keys], "headers")
    per_order = exact.banded(_lines(orders, products, "order_id"), ["order_id"], F.col("revenue"), lines)
    return exact.merged(per_order.join(headers.select("order_id", *keys), "order_id"), keys, F.sum("lines").alias("lines"))


def customer_revenue(orders: DataFrame, products: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    bands = revenue_bands(orders, products, ["customer_id"], headers)
    return bands.groupBy("customer_id").agg(exact.exact_total().alias("revenue"))


def top_customers(orders: DataFrame, products: DataFrame, n: int = TOP_ROWS, headers: DataFrame | None = None) -> DataFrame:
    per_customer = revenue_bands(orders, products, ["customer_id"], headers).groupBy("customer_id").agg(
        exact.exact_total().alias("revenue"), F.sum("counted").alias("priced"), F.sum("lines").alias("order_count"))
    return per_customer.select(
        "customer_id", _two_places(F.col("revenue")).alias("total_revenue"), "order_count",
        _two_places(mean(F.col("revenue"), F.col("priced"))).alias("avg_order_value"),
    ).orderBy(F.desc("total_revenue"), "customer_id").limit(n)


def sales_by_category(orders: DataFrame, products: DataFrame) -> DataFrame:
    require_columns(products, ["category"], "products")
    lines = _lines(orders, products).join(products.select("product_id", "category"), "product_id")
    sums = exact.exact_sums(lines, ["category"], revenue=F.col("revenue"), sold=F.col("quantity"), prices=F.col("price"))
    counts = lines.groupBy("category", "product_id").agg(F.count("price").alias("priced")).groupBy("category").agg(
        F.sum("priced").alias("priced"), F.count("product_id").alias("unique_products"))
    joined = sums.withColumnRenamed("category", "__category").join(counts, F.col("__category").eqNullSafe(F.col("category")))
    return joined.select(
        "category", _two_places(F.col("revenue")).alias("total_revenue"), F.col("sold").alias("total_units_sold"), "unique_products",
        _two_places(mean(F.col("prices"), F.col("priced"))).alias("avg_price_per_unit"),
    ).orderBy(F.desc("total_revenue"), "category")


def monthly_trends(orders: DataFrame, products: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    bands = revenue_bands(orders, products, ["order_date"], headers).withColumns({
        "year": F.year("order_date").cast("bigint"), "month": F.month("order_date").cast("bigint")})
    months = exact.merged(bands, ["year", "month"]).groupBy("year", "month").agg(exact.exact_total().alias("revenue"))
    revenue, before = F.col("revenue"), F.col("previous")
    return months.withColumn("previous", F.lag("revenue").over(Window.orderBy("year", "month"))).select(
        "year", "month", _two_places(revenue).alias("monthly_revenue"), _two_places(percent_growth(revenue, before)).alias("monthly_growth_pct"),
        _two_places(F.coalesce(revenue - before, F.lit(0.0))).alias("revenue_change")).orderBy("year", "month")
