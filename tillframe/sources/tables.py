"""The logical sales tables, as schemas and as views over the test data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Shop tables: one order is one product line.
SHOP_SCHEMAS = {
    "customers": "customer_id bigint, name string, email string, age int, city string, "
                 "country string, registration_date date",
    "products": "product_id bigint, name string, category string, price double, stock int, "
                "rating double",
    "orders": "order_id bigint, customer_id bigint, product_id bigint, quantity int, "
              "order_date timestamp_ntz",
}

# Store tables: an order header with items.
STORE_SCHEMAS = {
    "customers": "customer_id bigint, first_name string, last_name string, email string, "
                 "phone string, age int, age_group string, gender string, city string, "
                 "state string, country string, registration_date date, "
                 "last_login timestamp_ntz, is_active boolean",
    "products": "product_id bigint, product_name string, category string, description string, "
                "price double, cost double, stock_quantity int, weight double, brand string, "
                "sku string, created_date date, is_active boolean",
    "orders": "order_id bigint, customer_id bigint, order_date timestamp_ntz, "
              "order_status string, payment_method string, shipping_address string, "
              "order_total double, shipping_cost double, tax_amount double, "
              "discount_amount double, final_amount double",
    "order_items": "order_item_id bigint, order_id bigint, product_id bigint, quantity int, "
                   "unit_price double, total_price double",
}

# The given tables; a known schema saves the job that reads it from the files.
TEST_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TEST_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name")
    )


def order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_totalprice").alias("order_total"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("total_price"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with one row per product line."""
    headers = order_headers(spark, sf_dir).drop("order_total")
    return order_items(spark, sf_dir).drop("total_price").join(headers, "order_id")


def timed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as orders, since only they carry a time of day."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("order_id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("order_date"),
        F.col("value").alias("order_total"),
    )
