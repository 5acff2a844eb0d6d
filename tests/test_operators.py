import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillframe.operators import checks, products as by_product, rankings, revenue, segments, trends


def test_top_customers(shop):
    got = rows(revenue.top_customers(*shop, n=2))
    assert got == [(1, 20.0, 1, 20.0), (2, 20.0, 1, 20.0)]  # a tie goes to the lower id
    assert rows(revenue.top_customers(*shop)) == got + [(3, 0.7, 1, 0.35)]  # a null order_id is not counted


def test_headers_give_what_lines_give(spark, shop):
    """Customer and date once per order, also where an order has many lines or several headers."""
    orders, products = shop
    items = orders.select("order_id", "product_id", "quantity").union(
        spark.range(500).selectExpr("2", "id % 4", "cast(id % 7 as int)"))
    headers = orders.select("order_id", "customer_id", "order_date").union(
        spark.sql("SELECT 2L, 8L, TIMESTAMP_NTZ'2024-07-01 00:00:00'"))
    lines = items.join(headers, "order_id")
    for analysis in (revenue.top_customers, revenue.customer_revenue_top, trends.monthly_trends):
        assert rows(analysis(items, products, headers=headers)) == rows(analysis(lines, products))


def test_customer_revenue_is_listed_by_id(shop):
    assert rows(revenue.customer_revenue_top(*shop, n=2)) == [(1, 20.0), (2, 20.0)]


def test_sales_by_category(shop):
    got = rows(revenue.sales_by_category(*shop))
    assert got == [("B", 20.7, 15, 2, 0.9), ("A", 20.0, 2, 1, 10.0)]


def test_sales_by_category_equals_the_plain_join(spark):
    """Summing before the join gives what a join of every line gives, duplicate products included."""
    products = spark.createDataFrame(
        [(1, "A", 1.25), (1, "B", 2.0), (2, "A", None), (3, "C", 7.77), (4, None, 1.0)],
        "product_id bigint, category string, price double",
    )
    orders = spark.range(3000).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 6).cast("bigint").alias("product_id"),
        F.when(F.col("id") % 11 != 0, (F.col("id") % 7 + 0.25)).alias("quantity"),
    )
    money = "decimal(12,2)"
    plain = orders.join(products, "product_id").groupBy("category").agg(
        F.round(F.sum(F.col("quantity").cast(money) * F.col("price").cast(money)), 2).cast("double"),
        F.sum("quantity"),
        F.countDistinct("product_id"),
        F.round(F.avg("price"), 2),
    )
    assert sorted(map(str, rows(revenue.sales_by_category(orders, products)))) == sorted(map(str, rows(plain)))


def test_monthly_trends(shop):
    assert rows(trends.monthly_trends(*shop)) == [
        (2024, 1, 40.0, None, 0.0),
        (2024, 3, 0.7, -98.25, -39.3),  # the gap in February is not filled
    ]


def test_no_growth_after_a_month_without_revenue(spark):
    products = spark.createDataFrame([(1, 5.0)], "product_id bigint, price double")
    orders = spark.createDataFrame(
        [(1, 0, "2023-12-01"), (1, 2, "2024-01-01"), (1, 3, "2024-02-01")],
        "product_id bigint, quantity int, day string",
    ).withColumn("order_date", F.to_date("day"))
    assert rows(trends.monthly_trends(orders, products)) == [
        (2023, 12, 0.0, None, 0.0), (2024, 1, 10.0, None, 10.0), (2024, 2, 15.0, 50.0, 5.0),
    ]


def headers(spark, data):
    return spark.createDataFrame(
        data, "order_id bigint, customer_id bigint, day string, order_total double"
    ).withColumn("order_date", F.col("day").cast("timestamp_ntz")).drop("day")


def test_overview_months_and_hours(spark):
    orders = headers(spark, [
        (1, 1, "2024-01-01 05:30:00", 10.0), (2, 1, "2024-01-02 05:00:00", 20.5), (3, 2, "2024-02-01 23:59:59", None),
    ])
    assert rows(trends.sales_overview(orders)) == [(3, 30.5, 15.25, 20.5, 10.0, 2)]
    assert rows(trends.monthly_sales(orders)) == [(2024, 1, 2, 30.5, 15.25), (2024, 2, 1, None, None)]
    assert rows(trends.hourly_sales(orders)) == [(5, 2, 30.5, 15.25), (23, 1, None, None)]
    assert rows(trends.sales_overview(orders.limit(0))) == [(0, None, None, None, None, 0)]


def test_products_and_categories(spark):
    products = spark.createDataFrame(
        [(1, "a", "X"), (2, "b", "X"), (3, "c", "Y")], "product_id bigint, product_name string, category string"
    )
    items = spark.createDataFrame(
        [(1, 1, 2, 5.0), (1, 2, 1, 10.0), (2, 1, 1, 5.0), (3, 3, 1, 4.0), (4, 7, 9, 99.0)],
        "order_id bigint, product_id bigint, quantity int, total_price double",
    )
    assert rows(by_product.top_products(items, products, 2)) == [
        (1, "a", "X", 3, 10.0, 2), (2, "b", "X", 1, 10.0, 1),
    ]
    assert rows(by_product.category_performance(items, products)) == [("X", 4, 20.0, 2, 3), ("Y", 1, 4.0, 1, 1)]


def test_segments(spark):
    orders = headers(spark, [(i, 1, "2024-05-01", 100.0) for i in range(10)] + [(99, 2, "2023-01-01", 99.99)])
    got = rows(segments.customer_segments(orders, "2024-05-31").orderBy("customer_id"))
    assert [r[2:] for r in got] == [(10, 1000.0, 30, 5, 5, 5, 15, "Champions"), (1, 99.99, 516, 1, 1, 1, 3, "Lost")]
    assert "recency_days" in segments.rfm_metrics(orders).columns  # the default counts to today


def test_missing_columns_are_named(shop):
    orders, products = shop
    with pytest.raises(ValueError, match="orders lacks .* quantity, customer_id"):
        revenue.top_customers(orders.drop("quantity", "customer_id"), products)
    with pytest.raises(ValueError, match="products lacks .* category"):
        revenue.sales_by_category(orders, products.drop("category"))
    with pytest.raises(ValueError, match="order_date"):
        trends.monthly_trends(orders.drop("order_date"), products)
    with pytest.raises(ValueError, match="order_id"):
        revenue.top_customers(orders.drop("order_id"), products)
    assert revenue.customer_revenue(orders.drop("order_id"), products).count() == 3  # needs no order_id


def test_audits_and_counts(shop):
    orders, products = shop
    audit = checks.schema_audit({"o": orders}, {"o": ["order_id", "price"]})
    assert rows(audit) == [("o", "order_id", True, 4), ("o", "price", False, None)]
    assert rows(checks.table_row_counts({"o": orders, "none": None, "p": products})) == [("o", 5), ("p", 3)]
    assert rows(checks.scan_summary(products))[1] == (3, 3, 2, "category", "string")
    assert [r[0] for r in rows(checks.preview_rows(products, ["product_id"], 2))] == [1, 2]
    with pytest.raises(ValueError, match="not loaded"):
        checks.table_row_counts({"none": None})


def test_reconcile(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, v string")
    right = spark.createDataFrame([(2, None), (1, "a"), (3, "c")], "x int, y string")
    assert rows(checks.reconcile(left, right)) == [(3, 3, 2, 2, True, 1, 1, False)]
    assert rows(checks.reconcile(left, left)) == [(3, 3, 2, 2, True, 0, 0, True)]
    assert rows(checks.reconcile(left, right.drop("y"))) == [(3, 3, 2, 1, False, 3, 3, False)]
    assert rows(checks.reconcile(left.limit(0), right)) == [(0, 3, 2, 2, False, 0, 3, False)]


def test_rankings(spark):
    df = spark.createDataFrame(
        [("CSV", 4.0, 2.0, None), ("ORC", 1.0, 2.0, None), ("BAD", None, 0.5, "broken")],
        "format string, size double, seconds double, error string",
    )
    shares = rankings.share_of_total(df, "size").select("share_pct")
    assert rows(shares) == [(80.0,), (20.0,), (None,)]
    ratios = rankings.ratio_to_baseline(df, "format", "CSV", {"size": "size_pct"}).select("size_pct")
    assert rows(ratios) == [(100.0,), (25.0,), (None,)]
    missing = rankings.ratio_to_baseline(df, "format", "XML", {"size": "size_pct"}).select("size_pct")
    assert rows(missing) == [(400.0,), (100.0,), (None,)]
    best = rankings.best_by_metric(df, "format", ["size", "seconds"], error="error")
    assert rows(best) == [("size", "ORC", 1.0), ("seconds", "CSV", 2.0)]
    assert rows(rankings.best_by_metric(df.filter("error is not null"), "format", ["size"])) == [("size", None, None)]
