"""Money of any number of places: nothing is cut, and what does not fit is refused."""

from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL, rows
from tillframe.operators import checks, products as by_product, revenue, segments, trends
from tillframe.sources import tables


@pytest.fixture
def eighths(spark):
    """1,000 orders of 0.125 times a price of 0.125."""
    products = spark.createDataFrame([(1, "p", "A", 0.125)], "product_id bigint, product_name string, category string, price double")
    orders = spark.range(1000).select(
        F.col("id").alias("order_id"), F.lit(7).cast("bigint").alias("customer_id"), F.lit(1).cast("bigint").alias("product_id"),
        F.lit(0.125).alias("quantity"), F.lit(0.125).alias("total_price"), F.lit(0.125).alias("order_total"),
        F.expr("timestamp_ntz'2024-01-05 10:00:00'").alias("order_date"))
    return orders, products


def test_eighths_keep_their_places(eighths):
    orders, products = eighths
    assert rows(revenue.line_revenue(orders, products).select("quantity", "price", "revenue").distinct()) == [(0.125, 0.125, 0.015625)]
    assert rows(revenue.top_customers(orders, products)) == [(7, 15.63, 1000, 0.02)]
    assert rows(revenue.customer_revenue_top(orders, products)) == [(7, 15.625)]
    assert rows(revenue.sales_by_category(orders, products)) == [("A", 15.63, 125.0, 1, 0.13)]
    assert rows(trends.monthly_trends(orders, products)) == [(2024, 1, 15.63, None, 0.0)]
    assert rows(trends.sales_overview(orders)) == [(1000, 125.0, 0.125, 0.125, 0.125, 1)]
    assert rows(trends.monthly_sales(orders)) == [(2024, 1, 1000, 125.0, 0.125)]
    assert rows(trends.hourly_sales(orders)) == [(10, 1000, 125.0, 0.125)]
    assert rows(by_product.top_products(orders, products)) == [(1, "p", "A", 125.0, 125.0, 1000)]
    assert rows(by_product.category_performance(orders, products)) == [("A", 125.0, 125.0, 1, 1000)]
    assert segments.rfm_metrics(orders, "2024-02-01").first()["monetary"] == 125.0
    agreed = checks.reconcile(revenue.customer_revenue(orders, products), revenue.customer_revenue_sql(orders, products)).first()
    assert agreed["same_rows"] and agreed["left_rows"] == 1


def cents(value):
    return float(value.quantize(Decimal("0.01"), ROUND_HALF_UP))


def test_four_place_prices_are_exact(spark):
    """Each line's discounted price, with four places, against decimals on the driver."""
    lines = tables.table(spark, SMALL, "lineitem").select(
        F.monotonically_increasing_id().alias("product_id"), F.col("l_orderkey").alias("order_id"), F.col("l_quantity").alias("quantity"),
        F.col("l_returnflag").alias("category"),
        (F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))).alias("price"))
    headers = tables.order_headers(spark, SMALL)
    products = lines.select("product_id", "category", "price")
    assert products.schema["price"].dataType.scale == 4
    orders = lines.select("order_id", "product_id", "quantity").join(headers.select("order_id", "customer_id", "order_date"), "order_id")
    by_customer, by_category, by_month = defaultdict(Decimal), defaultdict(Decimal), defaultdict(Decimal)
    for row in orders.join(products, "product_id").collect():
        value = Decimal(str(row.quantity)) * row.price
        by_customer[row.customer_id] += value
        by_category[row.category] += value
        by_month[row.order_date.year, row.order_date.month] += value
    best = sorted(by_customer.items(), key=lambda x: (-x[1], x[0]))[:10]
    assert [(r[0], r[1]) for r in rows(revenue.top_customers(orders, products))] == [(c, cents(v)) for c, v in best]
    assert rows(revenue.customer_revenue_top(orders, products)) == sorted((c, float(v)) for c, v in best)
    assert {r[0]: r[1] for r in rows(revenue.sales_by_category(orders, products))} == {c: cents(v) for c, v in by_category.items()}
    assert [(r[0], r[1], r[2]) for r in rows(trends.monthly_trends(orders, products))] == [(*m, cents(v)) for m, v in sorted(by_month.items())]


def test_too_many_places_name_the_column(eighths):
    orders, products = eighths
    with pytest.raises(Exception, match="column price has more than 4 decimal places"):
        revenue.line_revenue(orders, products.withColumn("price", F.lit(0.123456))).collect()
    with pytest.raises(Exception, match="column order_total has more than 4 decimal places"):
        trends.sales_overview(orders.withColumn("order_total", F.lit(0.123456))).collect()
    with pytest.raises(Exception, match="column quantity has more than 4 decimal places"):
        revenue.customer_revenue_sql(orders.withColumn("quantity", F.lit(0.123456)), products).collect()
