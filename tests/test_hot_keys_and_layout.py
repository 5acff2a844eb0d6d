"""Hot keys are named and dealt over tasks; stored buckets are joined without a shuffle."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL, rows
from tillframe.operators import hotkeys, revenue, trends
from tillframe.sources import layout, tables

TASKS = 16


@pytest.fixture
def shuffled(settings):
    """No broadcast, and no help from adaptive execution."""
    for name, value in {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.adaptive.coalescePartitions.enabled": "false",
                        "spark.sql.shuffle.partitions": str(TASKS)}.items():
        settings(name, value)


@pytest.fixture
def skewed(spark):
    """400,000 lines, a third of them of product 7, a tenth of product 11, some without a product."""
    lines = spark.range(400_000).select(
        F.col("id").alias("order_id"), (F.col("id") % 5000).alias("customer_id"),
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, 11).when(F.col("id") % 1000 == 2, None).otherwise(F.col("id") % 10_000).cast("bigint").alias("product_id"),
        (F.col("id") % 9 + 1).cast("int").alias("quantity"))
    products = spark.range(9_990).select(F.col("id").alias("product_id"), (F.col("id") % 90 + 0.99).alias("price"))
    return lines, products


def task_rows(df):
    return sorted(n for _, n in rows(df.groupBy(F.spark_partition_id()).count()))


def test_no_join_task_has_twice_the_median(spark, shuffled, skewed):
    lines, products = skewed
    hot = hotkeys.hot_keys(lines, "product_id", TASKS)
    assert {key for keys in hot.parts.values() for key in keys} == {7, 11} and sum(n * len(keys) for n, keys in hot.parts.items()) <= 4 * TASKS
    plain, salted = task_rows(lines.join(products, "product_id")), task_rows(hotkeys.salted_join(lines, products, hot))
    assert len(salted) == TASKS and sum(plain) == sum(salted)
    assert plain[-1] > 5 * plain[TASKS // 2]
    assert salted[-1] <= 2 * salted[TASKS // 2]


def test_salted_results_are_the_same(spark, shuffled, skewed):
    lines, products = skewed
    hot = hotkeys.hot_keys(lines, "product_id", TASKS)
    for how in ("inner", "left"):
        one, two = lines.join(products, "product_id", how), hotkeys.salted_join(lines, products, hot, how)
        assert one.columns == two.columns
        assert one.exceptAll(two).count() == two.exceptAll(one).count() == 0
    assert rows(revenue.top_customers(lines, products, hot=hot)) == rows(revenue.top_customers(lines, products))
    with pytest.raises(ValueError, match="inner and left"):
        hotkeys.salted_join(lines, products, hot, "right")


def test_rows_repeated_in_products_are_kept(spark, skewed):
    lines, products = skewed
    twice = products.filter("product_id < 20").union(products.filter("product_id = 7"))
    hot = hotkeys.hot_keys(lines, "product_id", TASKS)
    assert hotkeys.salted_join(lines, twice, hot).count() == lines.join(twice, "product_id").count()


def test_even_keys_need_no_salt(spark, skewed):
    even = spark.range(10_000).select((F.col("id") % 500).alias("product_id"))
    hot = hotkeys.hot_keys(even, "product_id", TASKS)
    assert not hot and hotkeys.salted_join(even, skewed[1], hot).count() == 10_000
    assert hotkeys.frequent_keys(even.limit(0), "product_id", 0.01) == []
    assert hotkeys.frequent_keys(even.select(F.lit(None).cast("bigint").alias("product_id")), "product_id", 0.01) == []


def test_frequent_keys_are_counted_exactly(spark):
    words = spark.range(1000).select(F.when(F.col("id") < 100, "a").when(F.col("id") < 180, "b").otherwise(F.col("id").cast("string")).alias("k"))
    assert sorted(rows(hotkeys.frequent_key_report(words, "k", 0.08))) == [("a", 100, 10.0), ("b", 80, 8.0)]
    assert rows(hotkeys.frequent_key_report(words, "k", 0.09)) == [("a", 100, 10.0)]


def test_many_frequent_keys_stay_out_of_the_driver_and_the_plan(spark):
    keys = [None if i % 11 == 0 else i % 3000 if i % 4 else i % 500 for i in range(24_000)]
    lines = spark.range(24_000).select(
        F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 4 != 0, F.col("id") % 3000).otherwise(F.col("id") % 500).alias("k"))
    report = hotkeys.frequent_key_report(lines, "k", 1 / 3000)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert "INSET" not in plan and " IN (" not in plan
    counts = Counter(key for key in keys if key is not None)
    expected = sorted((key, n, n / 24_000 * 100) for key, n in counts.items() if n >= 24_000 * (1 / 3000))
    assert len(expected) > 100 and sorted(rows(report)) == expected


@pytest.mark.parametrize("analysis", [revenue.top_customers, trends.monthly_trends, revenue.customer_revenue])
def test_stored_lines_are_not_shuffled(spark, shuffled, analysis):
    """Above the scan of the lines there is no exchange before the sums per order have met the headers."""
    stored = layout.write_sales_layout(tables.order_items(spark, SMALL), tables.products(spark, SMALL), tables.order_headers(spark, SMALL), buckets=4)
    try:
        lines, headers = stored.read(spark)
        found = analysis(lines, None, headers=headers)
        text = found._jdf.queryExecution().executedPlan().toString()
        join = text.index("SortMergeJoin")
        assert "Exchange" not in text[join:] and len(re.findall("Bucketed: true", text)) == 2
        expected = analysis(tables.order_items(spark, SMALL), tables.products(spark, SMALL), headers=tables.order_headers(spark, SMALL))
        assert sorted(rows(found)) == sorted(rows(expected))
    finally:
        stored.drop(spark)


def test_the_layout_keeps_lines_of_known_products_and_every_header(spark, shop):
    orders, products = shop
    headers = orders.select("order_id", "order_date")
    stored = layout.write_sales_layout(orders, products, headers, buckets=3)
    lines, kept = stored.read(spark)
    assert lines.count() == orders.join(products, "product_id").count() and kept.count() == headers.count()
    assert {"price", "category"} <= set(lines.columns)
    salted = layout.write_sales_layout(orders, products, headers, buckets=3, hot=hotkeys.HotKeys("product_id", {4: [3]}))
    assert sorted(rows(salted.read(spark)[0].select("order_id", "product_id", "price")), key=str) == sorted(rows(lines.select("order_id", "product_id", "price")), key=str)
    for one in (stored, salted):
        one.drop(spark)
