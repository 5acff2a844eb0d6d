"""Every registered query against its SQL, and again where no table may be broadcast."""

import pytest

import __spark_entry__ as entry
from tests.compare import database, differences
from tests.conftest import SMALL
from tillframe.plans.catalog import QUERIES
from tillframe.plans.oracle import ORACLE_SQL

SQL = ORACLE_SQL
JOINING = [
    "line_revenue", "top_customers_by_revenue", "customer_revenue_top10", "sales_by_category",
    "monthly_trends", "top_products", "category_performance", "gen_orders",
]


@pytest.fixture(scope="module")
def tables():
    return database(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, tables, name):
    assert differences(QUERIES[name](spark, SMALL), tables, SQL[name]) == []


@pytest.mark.parametrize("name", JOINING)
def test_same_rows_without_broadcast(spark, settings, tables, name):
    settings("spark.sql.autoBroadcastJoinThreshold", "-1")
    settings("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    assert differences(QUERIES[name](spark, SMALL), tables, SQL[name]) == []


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["customer_id", "total_revenue", "order_count", "avg_order_value"]
    assert df.count() == 10


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


# these run jobs while they are built
WRITING = {"file_size_report", "timed_report", "storage_format_report", "frequent_products", "shuffled_orders", "csv_rejects", "replaced_table",
           *(name for name in QUERIES if "_roundtrip" in name or name.startswith(("salted_", "bucketed_")))}


def test_building_a_query_starts_no_job(spark):
    context = spark.sparkContext
    context.setJobGroup("building", "building")
    for name in sorted(set(QUERIES) - WRITING - {"scan_parquet", "input_audit"}):  # these two read unknown files' footers
        QUERIES[name](spark, SMALL)
    assert list(context.statusTracker().getJobIdsForGroup("building")) == []
    context.setLocalProperty("spark.jobGroup.id", None)
