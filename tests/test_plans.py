"""What the plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL, rows
from tillframe.operators import revenue
from tillframe.plans.catalog import QUERIES
from tillframe.plans.reports import run

# these run jobs while they are built
WRITING = {"file_size_report", "storage_format_report", "timed_report", "frequent_products", "shuffled_orders", "csv_rejects", "replaced_table",
           *(name for name in QUERIES if "_roundtrip" in name or name.startswith(("salted_", "bucketed_")))}


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_pairs_and_no_python_rows(spark, settings, name):
    settings("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = plan(QUERIES[name](spark, SMALL))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in text


@pytest.mark.parametrize("name", ["top_customers_by_revenue", "customer_revenue_top10", "top_products", "preview_rows"])
def test_top_rows_need_no_full_sort(spark, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SMALL))


def read_columns(df):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", df._jdf.queryExecution().executedPlan().toString())
    return {column.split(":")[0] for schema in schemas for column in schema.split(",") if column}


@pytest.mark.parametrize("name, columns", [
    ("sales_by_category", {"l_partkey", "l_quantity", "p_partkey", "p_type", "p_retailprice"}),
    ("monthly_trends", {"l_orderkey", "l_partkey", "l_quantity", "o_orderkey", "o_orderdate", "p_partkey", "p_retailprice"}),
    ("top_products", {"l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "p_partkey", "p_name", "p_type"}),
    ("rfm_metrics", {"o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"}),
])
def test_scans_read_only_what_is_used(spark, name, columns):
    assert read_columns(QUERIES[name](spark, SMALL)) == columns


@pytest.mark.parametrize("name", ["sales_by_category", "top_products", "category_performance"])
def test_items_are_shuffled_once_and_already_summed(spark, settings, name):
    settings("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(product_id", text)) == 2  # one for the items, one for the products
    assert re.search(r"Exchange hashpartitioning\(product_id[^\n]*\n[^\n]*HashAggregate[^\n]*partial_sum", text)


@pytest.mark.parametrize("name", ["top_customers_by_revenue", "customer_revenue_top10", "monthly_trends"])
def test_lines_reach_the_headers_summed_per_order(spark, settings, name):
    settings("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(order_id", text)) == 2
    assert re.search(r"Exchange hashpartitioning\(order_id[^\n]*\n[^\n]*HashAggregate[^\n]*partial_sum", text)


def test_the_sales_report_reads_the_lines_twice(spark):
    """Once for the categories, once for customers and months together."""
    report = QUERIES["sales_report"](spark, SMALL)
    report.collect()
    final = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet \[l_", final)) == 2


def test_the_full_report_reads_the_orders_twice(spark):
    """Once for customers and the overview, once for months and hours; the items once."""
    report = QUERIES["full_report"](spark, SMALL)
    report.collect()
    final = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet \[o_", final)) == 2
    assert len(re.findall(r"FileScan parquet \[l_", final)) == 1


def test_a_hot_product_is_split(spark, settings):
    """A product with half of all lines, too large to broadcast: its partition is cut up, and the result is whole."""
    for name, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    }.items():
        settings(name, value)
    lines = spark.range(400_000).select(
        F.col("id").alias("order_id"),
        (F.col("id") % 5000).alias("customer_id"),
        F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("product_id"),
        (F.col("id") % 9 + 1).cast("int").alias("quantity"),
    ).repartition(16)
    products = spark.range(1000).select(F.col("id").alias("product_id"), (F.col("id") % 90 + 0.99).alias("price"))
    result = revenue.customer_revenue(lines, products)
    collected = result.agg(F.sum("revenue"), F.count("*"))
    got = rows(collected)
    assert "skew=true" in collected._jdf.queryExecution().executedPlan().toString()
    price = {i: i % 90 * 100 + 99 for i in range(1000)}
    expected = sum((i % 9 + 1) * price[7 if i % 2 == 0 else i % 1000] for i in range(400_000)) / 100
    assert got[0][1] == 5000 and got[0][0] == pytest.approx(expected, rel=1e-12)
    run(result)
