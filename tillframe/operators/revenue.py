"""Revenue per line, customer and category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillframe.constants import TOP_ROWS
from tillframe.functions.numbers import (
    LOW_BITS, PLACES, amount, cents, high_sum, joined, low_sum, mean, places_of, quantity, scaled, units,
)
from tillframe.operators.checks import require_columns
from tillframe.operators.hotkeys import HotKeys, salted_join


def revenue_places(orders: DataFrame, products: DataFrame | None) -> int:
    """Decimal places of quantity times price."""
    require_columns(orders, ["product_id", "quantity"], "orders")
    priced = orders if products is None else products
    require_columns(priced, ["product_id", "price"], "products")
    return places_of(orders.schema["quantity"].dataType) + places_of(priced.schema["price"].dataType)


def priced_lines(orders: DataFrame, products: DataFrame | None, *keep: str, hot: HotKeys | None = None) -> DataFrame:
    """The columns `keep` of each order line, with its quantity, price and revenue in whole units.

    Revenue is the unrounded product; it counts 10**-revenue_places. Without products, the lines
    carry their price, as those of `sources.layout` do, and nothing is joined.

    The join is left to Spark: products are broadcast while their size allows it,
    and beyond that adaptive execution splits the partitions of a hot product. Where neither
    helps, `hot` (from `hotkeys.hot_keys`) deals the lines of hot products over more tasks.
    """
    require_columns(orders, ["product_id", "quantity", *keep], "orders")
    quantities = ["product_id", *keep, units(orders, "quantity").alias("quantity_units")]
    if products is None:
        require_columns(orders, ["price"], "orders")
        joined_lines = orders.select(*quantities, units(orders, "price").alias("price_units"))
    else:
        require_columns(products, ["product_id", "price"], "products")
        prices = products.select("product_id", units(products, "price").alias("price_units"))
        lines = orders.select(*quantities)
        joined_lines = salted_join(lines, prices, hot) if hot else lines.join(prices, "product_id")
    return joined_lines.withColumn("revenue_units", F.col("quantity_units") * F.col("price_units"))


def line_revenue(orders: DataFrame, products: DataFrame) -> DataFrame:
    lines = priced_lines(orders, products, "order_id", "customer_id")
    return lines.select(
        "order_id",
        "customer_id",
        "product_id",
        amount(F.col("quantity_units"), places_of(orders.schema["quantity"].dataType)).alias("quantity"),
        amount(F.col("price_units"), places_of(products.schema["price"].dataType)).alias("price"),
        amount(F.col("revenue_units"), revenue_places(orders, products)).alias("revenue"),
    )


def revenue_sums(orders: DataFrame, products: DataFrame | None, keys: list[str],
                 headers: DataFrame | None = None, hot: HotKeys | None = None) -> DataFrame:
    """Partial sums to be grouped further by the keys: `high`, `low`, `priced` and `lines`.

    Without headers, `orders` carries the keys and the sums are still single lines.
    With headers, the keys stand once per order in `headers`, and lines are summed
    per order before they meet them: an order with very many lines reaches the join
    as one row, and the join reuses the partitioning of that sum. The metadata of `high` says
    how many decimal places the sums have.
    """
    revenue = F.col("revenue_units")
    if headers is None:
        require_columns(orders, ["product_id", "quantity", *keys], "orders")
    places = {"places": revenue_places(orders, products)}
    if headers is None:
        order_id = ["order_id"] if "order_id" in orders.columns else []
        return priced_lines(orders, products, *keys, *order_id, hot=hot).select(
            *keys,
            F.shiftright(revenue, LOW_BITS).alias("high", metadata=places),
            revenue.bitwiseAND(F.lit(2**LOW_BITS - 1)).alias("low"),
            revenue.isNotNull().cast("bigint").alias("priced"),
            (F.col("order_id").isNotNull() if order_id else F.lit(None)).cast("bigint").alias("lines"),
        )
    require_columns(headers, ["order_id", *keys], "headers")
    per_order = (
        priced_lines(orders, products, "order_id", hot=hot)
        .groupBy("order_id")
        .agg(
            high_sum(revenue).alias("high"),
            low_sum(revenue).alias("low"),
            F.count(revenue).alias("priced"),
            F.count("order_id").alias("lines"),
        )
    )
    # holds for every order with an id; it makes all sums part of each use, so that several
    # analyses of a report have the same plan up to here, and Spark shuffles the lines once
    per_order = per_order.filter("lines >= priced")
    kept = per_order.join(headers.select("order_id", *keys), "order_id")
    return kept.select(*keys, F.col("high").alias("high", metadata=places), "low", "priced", "lines")


def summed_revenue(sums: DataFrame) -> Column:
    """The exact revenue of a group of `revenue_sums`."""
    return joined(F.sum("high"), F.sum("low"), sums.schema["high"].metadata["places"])


def customer_revenue(orders: DataFrame, products: DataFrame | None, headers: DataFrame | None = None,
                     hot: HotKeys | None = None) -> DataFrame:
    """(customer_id, revenue) of every customer who bought something."""
    sums = revenue_sums(orders, products, ["customer_id"], headers, hot)
    return sums.groupBy("customer_id").agg(summed_revenue(sums).cast("double").alias("revenue"))


def customer_revenue_sql(orders: DataFrame, products: DataFrame) -> DataFrame:
    """The same as `customer_revenue`, written in SQL over decimals, as a second opinion.

    It holds quantities and prices below 10**13; more digits raise, as do more decimal places.
    """

    def exact(df: DataFrame, name: str) -> str:
        places = places_of(df.schema[name].dataType)
        decimal = f"CAST({name} AS DECIMAL({13 + places}, {places}))"
        if places != PLACES:
            return decimal
        error = f"raise_error('column {name} has more than {places} decimal places')"
        return f"CASE WHEN {name} IS NULL OR CAST({decimal} AS DOUBLE) = {name} THEN {decimal} ELSE {error} END"

    return orders.sparkSession.sql(
        f"""
        SELECT customer_id, CAST(SUM({exact(orders, "quantity")} * {exact(products, "price")}) AS DOUBLE) AS revenue
        FROM {{orders}} JOIN {{products}} USING (product_id)
        GROUP BY customer_id
        """,
        orders=orders, products=products,
    )


def customer_revenue_top(orders: DataFrame, products: DataFrame, n: int = TOP_ROWS,
                         headers: DataFrame | None = None) -> DataFrame:
    """The n customers with most revenue, listed by customer id."""
    top = customer_revenue(orders, products, headers).orderBy(F.desc("revenue"), "customer_id").limit(n)
    return top.orderBy("customer_id")


def top_customers(orders: DataFrame, products: DataFrame | None, n: int = TOP_ROWS,
                  headers: DataFrame | None = None, hot: HotKeys | None = None) -> DataFrame:
    """The n customers with most revenue; `order_count` counts order lines."""
    require_columns(orders, ["order_id"], "orders")
    return top_customers_of(revenue_sums(orders, products, ["customer_id"], headers, hot), n)


def top_customers_of(sums: DataFrame, n: int = TOP_ROWS) -> DataFrame:
    per_customer = sums.groupBy("customer_id").agg(
        summed_revenue(sums).alias("revenue"),
        F.sum("priced").alias("priced"),
        F.sum("lines").alias("order_count"),
    )
    return (
        per_customer.select(
            "customer_id",
            cents(F.col("revenue")).alias("total_revenue"),
            "order_count",
            cents(mean(F.col("revenue"), F.col("priced"))).alias("avg_order_value"),
        )
        .orderBy(F.desc("total_revenue"), "customer_id")
        .limit(n)
    )


def sales_by_category(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue, units and products sold per category.

    Lines are summed per product before they meet the products, so the join sees
    one row per product however unevenly products sell, and it reuses the
    partitioning of that sum. `avg_price_per_unit` is the mean over order lines.
    """
    require_columns(orders, ["product_id", "quantity"], "orders")
    require_columns(products, ["product_id", "price", "category"], "products")
    sold = orders.groupBy("product_id").agg(
        F.sum(units(orders, "quantity")).alias("sold"), F.count(F.lit(1)).alias("lines")
    )
    catalogue = products.select(
        "product_id", "category", units(products, "price").cast("decimal(19,0)").alias("price")
    )
    places = places_of(products.schema["price"].dataType)
    price = F.col("price")
    per_category = (
        sold.join(catalogue, "product_id")
        .groupBy("category")
        .agg(
            F.sum(F.col("sold").cast("decimal(19,0)") * price).alias("revenue"),
            F.sum("sold").alias("sold"),
            F.countDistinct("product_id").alias("unique_products"),
            F.sum(F.col("lines").cast("decimal(19,0)") * price).alias("prices"),
            F.sum(F.when(price.isNotNull(), F.col("lines"))).alias("priced"),
        )
    )
    return per_category.select(
        "category",
        cents(scaled(F.col("revenue"), revenue_places(orders, products))).alias("total_revenue"),
        quantity(orders, "quantity", F.col("sold")).alias("total_units_sold"),
        "unique_products",
        cents(mean(scaled(F.col("prices"), places), F.col("priced"))).alias("avg_price_per_unit"),
    ).orderBy(F.desc("total_revenue"), "category")
