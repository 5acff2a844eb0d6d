"""The registered queries: each analysis over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tillframe.functions import exact, permutation
from tillframe.functions.numbers import cents
from tillframe.functions.text import readable_bytes
from tillframe.operators import checks, distinct, doubles, hotkeys, products as by_product, rankings, revenue, segments, trends
from tillframe.plans import reports, storage
from tillframe.sources import checked, files, layout, synthetic, tables

Query = Callable[[SparkSession, str], DataFrame]

SEED = 42
AS_OF = "2001-08-02"
#: Tasks that the salted joins aim to fill evenly; a product with more than a two-thousandth of all lines is hot.
HOT_TASKS = 1000
SHUFFLED_FILES = 16
GENERATED_AS_OF = "2024-01-01"
SCALED_THRESHOLDS = segments.Thresholds(
    frequency=((14, 5), (11, 4), (9, 3), (6, 2)),
    monetary=((3_200_000, 5), (2_600_000, 4), (2_200_000, 3), (1_700_000, 2)),
)
BASELINE_CATEGORY = "ECONOMY"
CATEGORY_METRICS = ["total_quantity_sold", "total_revenue", "unique_products", "order_count"]
REPORT_KEYS = {
    "top_customers": ["customer_id"],
    "category_sales": ["category"],
    "monthly_trends": ["year", "month"],
    "monthly_sales_trends": ["year", "month"],
    "top_products": ["product_id"],
    "customer_segments": ["customer_id"],
    "category_performance": ["category"],
    "hourly_sales_pattern": ["hour"],
}


def _with_headers(analysis: Callable[..., DataFrame]) -> Query:
    return lambda spark, sf: analysis(
        tables.order_items(spark, sf), tables.products(spark, sf), headers=tables.order_headers(spark, sf)
    )


def _items(analysis: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: analysis(tables.order_items(spark, sf), tables.products(spark, sf))


def _headers(analysis: Callable[..., DataFrame], *args) -> Query:
    return lambda spark, sf: analysis(tables.order_headers(spark, sf), *args)


def _round_trip(fmt: str, name: str = "orders") -> Query:
    return lambda spark, sf: files.round_trip(tables.table(spark, sf, name), fmt)


def _size(spark: SparkSession, sf: str, name: str) -> Column:
    """Rows of a table, as a scalar subquery."""
    return tables.table(spark, sf, name).agg(F.count(F.lit(1))).scalar()


def _paths(sf: str) -> dict[str, str]:
    named = {"customers": "customer", "products": "part", "orders": "orders", "returns": "returns"}
    return {name: f"{sf.rstrip('/')}/{file}.parquet" for name, file in named.items()}


def input_audit(spark: SparkSession, sf: str) -> DataFrame:
    return files.input_audit(spark, _paths(sf)).drop("path")


def schema_audit(spark: SparkSession, sf: str) -> DataFrame:
    return checks.schema_audit(
        {"orders": tables.order_items(spark, sf), "products": tables.products(spark, sf)},
        {
            "orders": ["order_id", "product_id", "quantity", "order_date"],
            "products": ["product_id", "price", "category"],
        },
    )


def scan_parquet(spark: SparkSession, sf: str) -> DataFrame:
    return checks.scan_summary(files.load_parquet(spark, f"{sf.rstrip('/')}/lineitem.parquet"))


def table_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    return checks.table_row_counts({
        "customers": tables.customers(spark, sf),
        "products": tables.products(spark, sf),
        "orders": tables.order_headers(spark, sf),
        "order_items": tables.order_items(spark, sf),
        "returns": None,
    })


def preview_rows(spark: SparkSession, sf: str) -> DataFrame:
    return checks.preview_rows(tables.table(spark, sf, "customer"), ["c_custkey"], 3)


def format_bytes(spark: SparkSession, sf: str) -> DataFrame:
    cents_of_order = F.round(F.col("o_totalprice") * 100).cast("bigint")
    scale = F.element_at(F.lit([1, 1024, 1024**2, 1024**3]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    sized = tables.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), (cents_of_order * scale).alias("size_bytes")
    )
    return sized.withColumn("size", readable_bytes(F.col("size_bytes")))


def energy_estimate(spark: SparkSession, sf: str) -> DataFrame:
    usage = tables.table(spark, sf, "events").select("event_id", F.col("value").alias("cpu_time_s"))
    return rankings.energy_estimate(usage, "cpu_time_s")


def line_revenue(spark: SparkSession, sf: str) -> DataFrame:
    return revenue.line_revenue(tables.order_lines(spark, sf), tables.products(spark, sf))


def share_of_total(spark: SparkSession, sf: str) -> DataFrame:
    sales = _items(revenue.sales_by_category)(spark, sf).select("category", "total_revenue")
    return rankings.share_of_total(sales, "total_revenue").withColumn("share_pct", cents(F.col("share_pct")))


def ratio_to_baseline(spark: SparkSession, sf: str) -> DataFrame:
    ratios = {"total_revenue": "revenue_pct", "total_quantity_sold": "quantity_pct", "order_count": "items_pct"}
    sales = _items(by_product.category_performance)(spark, sf).select("category", *ratios)
    compared = rankings.ratio_to_baseline(sales, "category", BASELINE_CATEGORY, ratios)
    return compared.withColumns({out: cents(F.col(out)) for out in ratios.values()})


def best_by_metric(spark: SparkSession, sf: str) -> DataFrame:
    per_item = {
        "revenue_per_item": F.col("total_revenue") / F.col("order_count"),
        "units_per_item": F.col("total_quantity_sold") / F.col("order_count"),
    }
    sales = _items(by_product.category_performance)(spark, sf).withColumns(per_item)
    return rankings.best_by_metric(sales, "category", [*CATEGORY_METRICS, *per_item])


def result_reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    """Customer revenue by DataFrame functions against the same by a SQL text."""
    by_functions = _with_headers(revenue.customer_revenue)(spark, sf)
    by_sql = revenue.customer_revenue_sql(tables.order_lines(spark, sf), tables.products(spark, sf))
    return checks.reconcile(by_functions, by_sql)


def _generated_shop(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Shop tables of the test tables' own sizes, over their keys counted from 1."""
    customer_ids = _keys(spark, sf, "customer", "c_custkey", "customer_id")
    product_ids = _keys(spark, sf, "part", "p_partkey", "product_id")
    orders, products = (_size(spark, sf, name) for name in ("orders", "part"))
    return {
        "customers": synthetic.shop_customers(customer_ids, SEED, GENERATED_AS_OF),
        "products": synthetic.shop_products(product_ids, SEED),
        "orders": synthetic.shop_orders(customer_ids, products, orders, SEED, GENERATED_AS_OF),
    }


def _keys(spark: SparkSession, sf: str, table: str, key: str, out: str) -> DataFrame:
    """A table's keys, counted from 1, as the keys of a generated table."""
    return synthetic.spread(tables.table(spark, sf, table).select((F.col(key) + 1).alias(out)))


def gen_customers(spark: SparkSession, sf: str) -> DataFrame:
    return synthetic.shop_customers(_keys(spark, sf, "customer", "c_custkey", "customer_id"), SEED, GENERATED_AS_OF)


def gen_products(spark: SparkSession, sf: str) -> DataFrame:
    return synthetic.shop_products(_keys(spark, sf, "part", "p_partkey", "product_id"), SEED)


def gen_pareto_counts(spark: SparkSession, sf: str) -> DataFrame:
    total = _size(spark, sf, "orders")
    ids = _keys(spark, sf, "customer", "c_custkey", "customer_id")
    return synthetic.pareto_counts(ids, "customer_id", total, seed=SEED)


def gen_orders(spark: SparkSession, sf: str) -> DataFrame:
    return _generated_shop(spark, sf)["orders"]


def gen_shuffle(spark: SparkSession, sf: str) -> DataFrame:
    return synthetic.shuffle_rows(tables.table(spark, sf, "orders"), "o_orderkey", SEED)


def gen_customers_profile(spark: SparkSession, sf: str) -> DataFrame:
    return synthetic.store_customers(_keys(spark, sf, "customer", "c_custkey", "customer_id"), SEED, GENERATED_AS_OF)


def gen_products_catalog(spark: SparkSession, sf: str) -> DataFrame:
    return synthetic.store_products(_keys(spark, sf, "part", "p_partkey", "product_id"), SEED, GENERATED_AS_OF)


def gen_order_items(spark: SparkSession, sf: str) -> DataFrame:
    products = _size(spark, sf, "part")
    return synthetic.store_order_items(_keys(spark, sf, "orders", "o_orderkey", "order_id"), products, SEED)


def gen_orders_header(spark: SparkSession, sf: str) -> DataFrame:
    customers = _size(spark, sf, "customer")
    ids = _keys(spark, sf, "orders", "o_orderkey", "order_id")
    return synthetic.store_orders(ids, customers, SEED, GENERATED_AS_OF)


def gen_benchmark_rows(spark: SparkSession, sf: str) -> DataFrame:
    return synthetic.benchmark_rows(_keys(spark, sf, "orders", "o_orderkey", "id"), SEED)


def gen_summary(spark: SparkSession, sf: str) -> DataFrame:
    return synthetic.data_summary(_generated_shop(spark, sf))


def sales_report(spark: SparkSession, sf: str) -> DataFrame:
    return reports.long_form(_with_headers(reports.sales_report)(spark, sf), REPORT_KEYS)


def _store(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "customers": tables.customers(spark, sf),
        "products": tables.products(spark, sf),
        "orders": tables.order_headers(spark, sf),
        "order_items": tables.order_items(spark, sf),
    }


def full_report(spark: SparkSession, sf: str) -> DataFrame:
    return reports.long_form(reports.full_report(_store(spark, sf), as_of=AS_OF), REPORT_KEYS)


def file_size_report(spark: SparkSession, sf: str) -> DataFrame:
    """The whole raw tables, saved and read back: columns, rows, and whether the sizes add up to the total."""
    raw = {"customers": "customer", "products": "part", "orders": "orders", "order_items": "lineitem"}
    saved = files.save_tables({name: tables.table(spark, sf, file) for name, file in raw.items()}, files.scratch_path(spark, "sizes"), "raw")
    sizes = files.file_size_report(spark, saved)
    is_total = F.col("name") == "TOTAL"
    adds_up = sizes.agg(F.sum(F.when(is_total, F.col("size_bytes"))) == F.sum(F.when(~is_total, F.col("size_bytes")))).scalar()
    back = {name: files.load_parquet(spark, path) for name, path in saved.items()}
    widths = F.create_map(*[F.lit(x) for name, df in back.items() for x in (name, len(df.columns))])
    return checks.table_row_counts(back).select(
        F.col("table").alias("name"), widths[F.col("table")].cast("bigint").alias("column_count"), "row_count", adds_up.alias("total_adds_up"))


def timed_report(spark: SparkSession, sf: str) -> DataFrame:
    analyses = {
        "top_customers": _with_headers(revenue.top_customers),
        "category_sales": _items(revenue.sales_by_category),
        "monthly_trends": _with_headers(trends.monthly_trends),
    }
    report = reports.timed_report(
        spark, {name: lambda query=query: query(spark, sf) for name, query in analyses.items()}
    )
    adds_up = F.abs(report.agg(F.sum("pct")).scalar() - 100) < 1e-6
    return report.select("operation", "row_count", (F.col("seconds") > 0).alias("timed"), adds_up.alias("pct_adds_up"))


def storage_format_report(spark: SparkSession, sf: str) -> DataFrame:
    """The order lines in every format: what was read back, and that each measure was taken."""
    report = storage.storage_format_report(tables.table(spark, sf, "lineitem"), sums=["l_quantity", "l_extendedprice"])
    measured = reduce(lambda a, b: a & b, [F.coalesce(F.col(name) > 0, F.lit(False)) for name in (
        "file_size_mb", "write_time_s", "read_time_s", "scan_time_s", "total_cpu_time_s", "energy_consumption_wh")])
    return report.select("format", "error", measured.alias("measured"), "row_count", "sum_l_quantity", "sum_l_extendedprice")


def frequent_products(spark: SparkSession, sf: str) -> DataFrame:
    """The products with a tenth more lines than an even deal over all products would give each."""
    items = tables.order_items(spark, sf)
    share = 1.1 / max(1, tables.products(spark, sf).count())
    return hotkeys.frequent_key_report(items, "product_id", share)


def _salted(analysis: Callable[..., DataFrame]) -> Query:
    """An analysis whose join with the products deals the lines of hot products over more tasks."""
    def query(spark: SparkSession, sf: str) -> DataFrame:
        items = tables.order_items(spark, sf)
        hot = hotkeys.hot_keys(items, "product_id", HOT_TASKS)
        return analysis(items, tables.products(spark, sf), headers=tables.order_headers(spark, sf), hot=hot)

    return query


def _from_layout(analysis: Callable[..., DataFrame]) -> Query:
    """An analysis over lines and headers that are stored bucketed by order."""
    def query(spark: SparkSession, sf: str) -> DataFrame:
        stored = layout.write_sales_layout(tables.order_items(spark, sf), tables.products(spark, sf), tables.order_headers(spark, sf))
        lines, headers = stored.read(spark)
        return analysis(lines, None, headers=headers)

    return query


def exact_customer_revenue(spark: SparkSession, sf: str) -> DataFrame:
    """Discounted, taxed lines per customer: doubles with as many places as multiplication gives them, summed exactly."""
    lines = tables.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("charge"))
    bands = exact.banded(lines, ["order_id"], F.col("charge"))
    headers = tables.order_headers(spark, sf).select("order_id", "customer_id")
    merged = exact.merged(bands.join(headers, "order_id"), ["customer_id"])
    return merged.groupBy("customer_id").agg(exact.exact_total().alias("revenue"))


def _edited_orders(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Order headers, and the same with known edits: some orders gone, some new, some totals and customers changed."""
    orders = tables.order_headers(spark, sf).select("order_id", "customer_id", "order_total")
    edited = orders.filter(F.col("order_id") % 97 != 0).select(
        F.when(F.col("order_id") % 89 == 0, -F.col("order_id")).otherwise(F.col("order_id")).alias("order_id"),
        F.when(F.col("order_id") % 83 == 0, F.lit(None)).otherwise(F.col("customer_id")).alias("customer_id"),
        F.when(F.col("order_id") % 7 == 0, F.col("order_total") + 0.25).when(F.col("order_id") % 5 == 0, F.col("order_total") + 16)
        .otherwise(F.col("order_total")).alias("order_total"))
    return orders, edited


def order_differences(spark: SparkSession, sf: str) -> DataFrame:
    return checks.match_by_key(*_edited_orders(spark, sf), ["order_id"], {"order_total": 0.5})


def order_difference_summary(spark: SparkSession, sf: str) -> DataFrame:
    return checks.match_summary(order_differences(spark, sf), ["order_total"]).withColumn("order_total_change", F.round("order_total_change", 2))


def shuffled_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders dealt in shuffled order to files of equal size: number, place, file and the place in it."""
    orders = _keys(spark, sf, "orders", "o_orderkey", "order_id")
    numbered = synthetic.running_offsets(orders.withColumn("one", F.lit(1)), "order_id", "one", "number").drop("one")
    n = orders.count()
    each = max(1, -(-n // SHUFFLED_FILES))
    placed = permutation.in_shuffled_order(numbered, "number", n, SHUFFLED_FILES, SEED)
    return placed.withColumn("file", F.expr(f"CAST(place DIV {each} AS BIGINT)")).select(
        "order_id", "number", "place", "file", F.row_number().over(Window.partitionBy("file").orderBy("place")).cast("bigint").alias("nth"))


def _damaged_csv(spark: SparkSession, sf: str) -> str:
    """The orders as CSV lines, some with a word for a number, some short, some long; the path they are written to."""
    key, total = F.col("o_orderkey"), F.round(F.col("o_totalprice") * 100).cast("bigint")
    fields = [F.when(key % 101 == 0, F.concat(F.lit("no. "), key)).otherwise(key.cast("string")), F.col("o_custkey").cast("string"),
              F.when(key % 97 == 0, F.lit("n/a")).otherwise(total.cast("string")), F.date_format("o_orderdate", "yyyy-MM-dd")]
    line = F.when(key % 89 == 0, F.concat_ws(",", *fields[:3])).when(key % 83 == 0, F.concat_ws(",", *fields, F.lit("more"))).otherwise(
        F.concat_ws(",", *fields))
    path = files.scratch_path(spark, "damaged")
    tables.table(spark, sf, "orders").select(line.alias("value")).write.text(path)
    return path


def csv_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Rejected records by fault and column, and the rows that are left with their total, from damaged CSV files."""
    found = checked.read_csv_checked(spark, _damaged_csv(spark, sf), "order_id bigint, customer_id bigint, cents bigint, day date", header=False)
    fine = found.rows.agg(F.lit("none").alias("fault"), F.lit(None).cast("string").alias("column"), F.count(F.lit(1)).alias("records"),
                          F.sum(F.lit(0)).cast("bigint").alias("n_bytes"), F.sum("cents").alias("cents"))
    return fine.unionByName(checked.reject_report(found).withColumn("cents", F.lit(None).cast("bigint")))


def replaced_table(spark: SparkSession, sf: str) -> DataFrame:
    """Customers, replaced by rows read from the same table, then by a write that fails: what the table holds, and faults in its files."""
    path = files.write_table(tables.table(spark, sf, "customer"), files.scratch_path(spark, "replaced"))
    there = files.read_table(spark, path)
    files.write_table(there.withColumn("c_acctbal", F.col("c_acctbal") + 1).filter("c_custkey % 3 <> 0"), path, manifest=True)
    try:
        files.write_table(files.read_table(spark, path).withColumn("c_acctbal", F.raise_error(F.lit("a failing task")).cast("double")), path)
        failed = False
    except PySparkException:
        failed = True
    faults = files.file_faults(spark, path).agg(F.count(F.lit(1))).scalar()
    return files.read_table(spark, path).select("c_custkey", "c_acctbal", F.lit(failed).alias("last_write_failed"), faults.alias("file_faults"))


QUERIES: dict[str, Query] = {
    "scan_parquet": scan_parquet,
    "input_audit": input_audit,
    "schema_audit": schema_audit,
    "table_row_counts": table_row_counts,
    "preview_rows": preview_rows,
    "csv_roundtrip": _round_trip("csv"),
    "json_roundtrip": _round_trip("json"),
    "parquet_roundtrip": _round_trip("parquet"),
    "orc_roundtrip": _round_trip("orc"),
    "csv_roundtrip_events": _round_trip("csv", "events"),
    "json_roundtrip_events": _round_trip("json", "events"),
    "parquet_roundtrip_events": _round_trip("parquet", "events"),
    "orc_roundtrip_events": _round_trip("orc", "events"),
    "file_size_report": file_size_report,
    "line_revenue": line_revenue,
    "top_customers_by_revenue": _with_headers(revenue.top_customers),
    "customer_revenue_top10": _with_headers(revenue.customer_revenue_top),
    "sales_by_category": _items(revenue.sales_by_category),
    "monthly_trends": _with_headers(trends.monthly_trends),
    "sales_overview": _headers(trends.sales_overview),
    "monthly_sales_trends": _headers(trends.monthly_sales),
    "hourly_sales_pattern": lambda spark, sf: trends.hourly_sales(tables.timed_orders(spark, sf)),
    "top_products": _items(by_product.top_products),
    "category_performance": _items(by_product.category_performance),
    "rfm_metrics": _headers(segments.rfm_metrics, AS_OF),
    "rfm_scores": _headers(segments.rfm_scores, AS_OF),
    "customer_segments": _headers(segments.customer_segments, AS_OF),
    "customer_segments_scaled": _headers(segments.customer_segments, AS_OF, SCALED_THRESHOLDS),
    "format_bytes": format_bytes,
    "energy_estimate": energy_estimate,
    "share_of_total": share_of_total,
    "ratio_to_baseline": ratio_to_baseline,
    "best_by_metric": best_by_metric,
    "result_reconciliation": result_reconciliation,
    "gen_customers": gen_customers,
    "gen_products": gen_products,
    "gen_pareto_counts": gen_pareto_counts,
    "gen_orders": gen_orders,
    "gen_shuffle": gen_shuffle,
    "gen_customers_profile": gen_customers_profile,
    "gen_products_catalog": gen_products_catalog,
    "gen_order_items": gen_order_items,
    "gen_orders_header": gen_orders_header,
    "gen_benchmark_rows": gen_benchmark_rows,
    "gen_summary": gen_summary,
    "sales_report": sales_report,
    "full_report": full_report,
    "timed_report": timed_report,
    "storage_format_report": storage_format_report,
    "frequent_products": frequent_products,
    "salted_top_customers": _salted(revenue.top_customers),
    "salted_monthly_trends": _salted(trends.monthly_trends),
    "bucketed_top_customers": _from_layout(revenue.top_customers),
    "bucketed_monthly_trends": _from_layout(trends.monthly_trends),
    "exact_customer_revenue": exact_customer_revenue,
    "exact_top_customers": _with_headers(doubles.top_customers),
    "exact_sales_by_category": _items(doubles.sales_by_category),
    "customers_by_month": _headers(distinct.customers_by_month),
    "order_differences": order_differences,
    "order_difference_summary": order_difference_summary,
    "exact_monthly_trends": _with_headers(doubles.monthly_trends),
    "shuffled_orders": shuffled_orders,
    "csv_rejects": csv_rejects,
    "replaced_table": replaced_table,
}
