"""Command line.

    python -m tillframe generate --kind shop  --data DIR [--customers N --products N --orders N]
    python -m tillframe generate --kind store --data DIR
    python -m tillframe analyze  --data DIR [--top N] [--save] [--format F]
    python -m tillframe report   --data DIR [--as-of YYYY-MM-DD] [--format F]
    python -m tillframe compare  --data DIR
    python -m tillframe formats  [--rows N]

DIR holds the folders `raw` and `processed`. Shop tables have one product line per order
and are Parquet; store tables have order items and are CSV. `--format` names another
format, for the tables written as well as for those read.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from tillframe import constants as fixed
from tillframe.operators import revenue
from tillframe.operators.checks import preview_rows, reconcile, table_row_counts
from tillframe.plans import reports, storage
from tillframe.session import get_session
from tillframe.sources import files, synthetic, tables

MAKERS = {"shop": (synthetic.shop_tables, fixed.SHOP_SIZES, "parquet"),
          "store": (synthetic.store_tables, fixed.STORE_SIZES, "csv")}
SCHEMAS = {"shop": tables.SHOP_SCHEMAS, "store": tables.STORE_SCHEMAS}


def shop_paths(spark: SparkSession, data: str, fmt: str = "parquet") -> dict[str, str]:
    return files.check_inputs(
        spark, {name: files.table_path(data, "raw", f"{name}.{fmt}") for name in fixed.SHOP_SIZES}
    )


def generate(spark: SparkSession, args: argparse.Namespace) -> None:
    make, sizes, fmt = MAKERS[args.kind]
    chosen = {name: size if getattr(args, name) is None else getattr(args, name) for name, size in sizes.items()}
    made = make(spark, **chosen, seed=args.seed, as_of=args.as_of)
    saved = files.save_tables(made, args.data, "raw", args.format or fmt)
    schemas = SCHEMAS[args.kind]
    stored = {name: files.read_table(spark, path, args.format or fmt, schemas[name]) for name, path in saved.items()}
    sizes = files.file_size_report(spark, saved)
    synthetic.data_summary(stored, sizes).show(truncate=False)
    sizes.show(truncate=False)
    for name, df in stored.items():
        preview_rows(df, [df.columns[0]]).show(truncate=False)


def analyze(spark: SparkSession, args: argparse.Namespace) -> None:
    fmt = args.format or "parquet"
    paths = shop_paths(spark, args.data, fmt)
    results = reports.sales_report_from(
        spark, paths["orders"], paths["products"], args.top, args.cache, fmt, tables.SHOP_SCHEMAS)

    def finish(name: str) -> DataFrame:
        """Compute a result once: into its file, or else into memory for display."""
        if args.save:
            results[name] = files.read_table(spark, files.save_tables({name: results[name]}, args.data)[name])
        return results[name].cache()

    timings = reports.timed_report(spark, {name: lambda name=name: finish(name) for name in results})
    for name, df in results.items():
        print(name)
        df.show(20, truncate=False)
    timings.show()


def report(spark: SparkSession, args: argparse.Namespace) -> None:
    store = reports.load_store(spark, args.data, tables.STORE_SCHEMAS, args.format or "csv")
    results = reports.full_report(store, args.top, args.as_of)
    saved = files.save_tables(results, args.data, fmt="csv")
    for name, path in saved.items():
        print(name, path)
        files.read_table(spark, path, "csv").show(5, truncate=False)
    table_row_counts(store).show()


def compare(spark: SparkSession, args: argparse.Namespace) -> None:
    fmt = args.format or "parquet"
    paths = shop_paths(spark, args.data, fmt)
    orders, products = (files.read_table(spark, paths[name], fmt, tables.SHOP_SCHEMAS[name]) for name in ("orders", "products"))
    by_functions = revenue.customer_revenue(orders, products)
    by_sql = revenue.customer_revenue_sql(orders, products)
    reconcile(by_functions, by_sql).show()
    reports.timed_report(spark, {"functions": lambda: by_functions, "sql": lambda: by_sql}).show()
    revenue.customer_revenue_top(orders, products, args.top).show()


def formats(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = synthetic.benchmark_rows(synthetic.entity_ids(spark, args.rows, "id"), args.seed)
    measured = storage.storage_format_report(rows)
    measured.show(truncate=False)
    storage.best_formats(measured).show(truncate=False)


COMMANDS = {"generate": generate, "analyze": analyze, "report": report, "compare": compare, "formats": formats}


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tillframe", description="Retail sales analytics on Spark")
    parser.add_argument("command", choices=COMMANDS)
    parser.add_argument("--data", default="data")
    parser.add_argument("--kind", choices=MAKERS, default="shop")
    parser.add_argument("--format", choices=fixed.FORMATS)
    for name in fixed.SHOP_SIZES:
        parser.add_argument(f"--{name}", type=int)
    parser.add_argument("--rows", type=int, default=fixed.BENCHMARK_ROWS)
    parser.add_argument("--top", type=int, default=fixed.TOP_ROWS)
    parser.add_argument("--seed", type=int, default=42)
    parser.add_argument("--as-of")
    parser.add_argument("--cache", action="store_true", help="let analyses share one pass over the orders")
    parser.add_argument("--save", action="store_true", help="save the analyses under `processed`")
    parser.add_argument("--master", help="for example local[8]; left to the launcher by default")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = get_session(master=args.master)
    try:
        COMMANDS[args.command](spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
