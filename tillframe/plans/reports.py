"""Report bundles, their long form, and timed runs."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import NumericType

from tillframe.constants import TOP_ROWS
from tillframe.operators import products as by_product
from tillframe.operators import revenue, segments, trends
from tillframe.operators.checks import require_tables, union_all
from tillframe.operators.orders import customer_sums, shared
from tillframe.operators.rankings import share_of_total
from tillframe.sources.files import load_table, table_path

STORE_TABLES = ("customers", "products", "orders", "order_items")


def sales_report(orders: DataFrame, products: DataFrame, n: int = TOP_ROWS,
                 headers: DataFrame | None = None, cache: bool = False) -> dict[str, DataFrame]:
    """Top customers, categories and monthly trends of order lines.

    Customer and date stand on every line, or once per order in `headers`. With
    `cache`, customers and months share one pass over the lines: its sums are kept in
    memory and on disk when the first of the two is computed.
    """
    if cache:
        sums = revenue.revenue_sums(orders, products, ["customer_id", "order_date"], headers).persist()
        customers, months = revenue.top_customers_of(sums, n), trends.monthly_trends_of(sums)
    else:
        customers = revenue.top_customers(orders, products, n, headers)
        months = trends.monthly_trends(orders, products, headers)
    return {
        "top_customers": customers,
        "category_sales": revenue.sales_by_category(orders, products),
        "monthly_trends": months,
    }


def sales_report_from(spark: SparkSession, orders_path: str, products_path: str,
                      n: int = TOP_ROWS, cache: bool = False, fmt: str = "parquet",
                      schemas: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    paths = {"orders": orders_path, "products": products_path}
    found = {name: load_table(spark, path, fmt, schemas and schemas[name]) for name, path in paths.items()}
    absent = [path for name, path in paths.items() if found[name] is None]
    if absent:
        raise FileNotFoundError(f"no such path: {', '.join(absent)}")
    return sales_report(found["orders"], found["products"], n, cache=cache)


def load_store(spark: SparkSession, base: str, schemas: Mapping[str, str] | None = None,
               fmt: str = "csv") -> dict[str, DataFrame | None]:
    """The store tables among the raw files of a format; a missing file gives None.

    Without schemas, the types of CSV and JSON are inferred, which reads every file once more.
    """
    return {
        name: load_table(spark, table_path(base, "raw", f"{name}.{fmt}"), fmt, schemas and schemas[name])
        for name in STORE_TABLES
    }


def full_report(tables: Mapping[str, DataFrame | None], n: int = TOP_ROWS,
                as_of: date | str | Column | None = None) -> dict[str, DataFrame]:
    """The six analyses of orders with items.

    The orders are grouped once by customer and once by the calendar, for two analyses each.
    """
    require_tables(tables, STORE_TABLES)
    orders, items, products = tables["orders"], tables["order_items"], tables["products"]
    per_customer, calendar = shared(customer_sums(orders)), trends.calendar_sums(orders)
    return {
        "sales_overview": trends.sales_overview_of(per_customer),
        "monthly_sales_trends": trends.monthly_sales_of(calendar),
        "top_products": by_product.top_products(items, products, n),
        "customer_segments": segments.customer_segments_of(per_customer, as_of),
        "category_performance": by_product.category_performance(items, products),
        "hourly_sales_pattern": trends.hourly_sales_of(calendar),
    }


def long_form(results: Mapping[str, DataFrame], keys: Mapping[str, list[str]]) -> DataFrame:
    """All results in one table (report, row_key, metric, value, label).

    Numbers go to `value` and everything else, as text, to `label`.
    """

    def cells(name: str, df: DataFrame) -> DataFrame:
        key_names = keys.get(name, [])
        key = F.concat_ws("|", *[F.col(k).cast("string") for k in key_names]) if key_names else F.lit("all")
        metrics = [field for field in df.schema.fields if field.name not in key_names]

        def cell(field) -> Column:
            number = isinstance(field.dataType, NumericType)
            column = F.col(field.name)
            return F.struct(
                F.lit(field.name).alias("metric"),
                (column.cast("double") if number else F.lit(None).cast("double")).alias("value"),
                (F.lit(None).cast("string") if number else column.cast("string")).alias("label"),
            )

        return df.select(
            F.lit(name).alias("report"), key.alias("row_key"), F.inline(F.array(*map(cell, metrics)))
        )

    return union_all(cells(name, df) for name, df in results.items())


def run(df: DataFrame) -> float:
    """Compute every row without keeping it; returns the seconds it took."""
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def timed_report(spark: SparkSession, analyses: Mapping[str, Callable[[], DataFrame]]) -> DataFrame:
    """(operation, seconds, row_count, pct) of each analysis, planning and execution included."""

    def measured(name: str, build: Callable[[], DataFrame]) -> tuple[str, float, int]:
        seen = Observation()
        start = time.perf_counter()
        run(build().observe(seen, F.count(F.lit(1)).alias("rows")))
        return name, time.perf_counter() - start, seen.get["rows"]

    rows = [measured(name, build) for name, build in analyses.items()]
    timed = spark.createDataFrame(rows, "operation string, seconds double, row_count bigint")
    return share_of_total(timed, "seconds", "pct")
