"""Reproducible synthetic sales tables.

Every value is drawn from the row's own key, so tables are built in parallel
without a counter or a seed per task, and a lost executor's rows come back the
same. Money is computed in hundredths and stored as doubles with two places.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec, functions as F

from tillframe import constants as fixed
from tillframe.functions.draws import (
    bits, fraction, hundredths, lomax, normal, pick, uniform, whole,
)
from tillframe.functions.numbers import amount, clamp
from tillframe.operators.checks import require_columns, table_row_counts

ROWS_PER_TASK = 1_000_000
ORDERS_PER_BLOCK = 10_000
SPAN_BITS = 16


def entity_ids(spark: SparkSession, n: int, name: str) -> DataFrame:
    """Keys 1..n, in partitions of at most ROWS_PER_TASK rows."""
    tasks = max(spark.sparkContext.defaultParallelism, -(-n // ROWS_PER_TASK))
    return spark.range(1, n + 1, 1, tasks).toDF(name)


def spread(ids: DataFrame, tasks: int | None = None) -> DataFrame:
    """The same keys dealt to `tasks` partitions, by default one for each core.

    Drawing a row costs far more than moving its key. For tables beyond
    ROWS_PER_TASK rows a core, name the number of tasks.
    """
    return ids.repartition(tasks or ids.sparkSession.sparkContext.defaultParallelism)


def _day(as_of: date | str | None) -> Column:
    return F.current_date() if as_of is None else F.to_date(F.lit(str(as_of)))


def _days_before(as_of: date | str | None, draw: Column, days: int) -> Column:
    return F.date_sub(_day(as_of), whole(draw, 0, days).cast("int"))


def _seconds_before(as_of: date | str | None, draw: Column, seconds: int) -> Column:
    midnight = _day(as_of).cast("timestamp_ntz")
    return F.timestamp_add("SECOND", -whole(draw, 0, seconds), midnight)


def _place(draw: Column, part: int) -> Column:
    return pick(draw, [place[part] for place in fixed.PLACES])


def _email(key: str) -> Column:
    return F.concat(F.lit("user"), F.col(key).cast("string"), F.lit("@example.com"))


def _product_label(key: str, seed: int, categories: Mapping[str, tuple]) -> tuple[Column, Column, Column]:
    """(category draw, category, product name)."""
    kind = uniform(key, seed, "label", 0, 3)
    category = pick(kind, list(categories))
    name = F.concat_ws(
        " ", category,
        pick(uniform(key, seed, "label", 1, 3), fixed.PHRASE_STARTS),
        pick(uniform(key, seed, "label", 2, 3), fixed.PHRASE_ENDS),
    )
    return kind, category, name


def _bound(kind: Column, ranges: Mapping[str, tuple], end: int) -> Column:
    return pick(kind, [float(r[end]) for r in ranges.values()])


# Shop tables -----------------------------------------------------------------


def shop_customers(ids: DataFrame, seed: int = 42, as_of: date | str | None = None) -> DataFrame:
    """Customers with ages around a normal distribution; `ids` has a customer_id column."""
    require_columns(ids, ["customer_id"], "ids")
    key, age = "customer_id", fixed.SHOP_AGE
    first, last, place = (uniform(key, seed, "person", lane, 3) for lane in range(3))
    drawn = F.lit(float(age["mean"])) + F.lit(float(age["deviation"])) * normal(key, seed, "age")
    return ids.select(
        "customer_id",
        F.concat_ws(" ", pick(first, fixed.FIRST_NAMES), pick(last, fixed.LAST_NAMES)).alias("name"),
        _email(key).alias("email"),
        clamp(F.floor(drawn.cast("decimal(28,8)")), F.lit(age["low"]), F.lit(age["high"]))
        .cast("int").alias("age"),
        _place(place, 0).alias("city"),
        _place(place, 2).alias("country"),
        _days_before(as_of, uniform(key, seed, "registered"), fixed.REGISTRATION_DAYS)
        .alias("registration_date"),
    )


def shop_products(ids: DataFrame, seed: int = 42) -> DataFrame:
    """Products priced within the range of their category; `ids` has a product_id column."""
    require_columns(ids, ["product_id"], "ids")
    key, ranges, rating = "product_id", fixed.SHOP_PRICE_RANGES, fixed.SHOP_RATING
    kind, category, name = _product_label(key, seed, ranges)
    price, stock = (uniform(key, seed, "numbers", lane, 2) for lane in range(2))
    drawn = F.lit(rating["mean"]) + F.lit(rating["deviation"]) * normal(key, seed, "rating")
    return ids.select(
        "product_id",
        name.alias("name"),
        category.alias("category"),
        amount(hundredths(price, _bound(kind, ranges, 0), _bound(kind, ranges, 1))).alias("price"),
        whole(stock, *fixed.STOCK_RANGE).cast("int").alias("stock"),
        clamp(F.round(drawn.cast("decimal(28,8)"), 1), F.lit(rating["low"]), F.lit(rating["high"]))
        .cast("double").alias("rating"),
    )


def pareto_counts(ids: DataFrame, key: str, total: int | Column, shape: float = fixed.PARETO_SHAPE,
                  seed: int = 42, out: str = "order_count") -> DataFrame:
    """Split `total` over the keys by a Pareto distribution, so that the parts add up exactly.

    What rounding leaves over goes to the key with the largest weight, the smallest
    key among equals. Both sums are one-row scalar subqueries; no row is shuffled.
    """
    require_columns(ids, [key], "ids")
    rows = total if isinstance(total, Column) else F.lit(total)
    weights = ids.select(key, lomax(key, seed, "pareto", shape).alias("weight"))
    overall = weights.agg(F.struct(
        F.sum("weight").cast("double").alias("weight"),
        F.max(F.struct(F.col("weight"), (-F.col(key)).alias("minus_key"))).alias("top"),
    )).scalar()
    parts = weights.select(
        key,
        F.bround(F.col("weight").cast("double") / overall["weight"] * rows.cast("double"), 0)
        .cast("bigint").alias("part"),
    )
    leftover = rows.cast("bigint") - parts.agg(F.sum("part")).scalar()
    is_top = F.col(key) == -overall["top"]["minus_key"]
    adjusted = parts.select(key, (F.col("part") + F.when(is_top, leftover).otherwise(F.lit(0))).alias(out))
    message = F.concat(rows.cast("string"), F.lit(" is too few to spread: the largest part would be negative"))
    return adjusted.select(key, F.when(F.col(out) < 0, F.raise_error(message)).otherwise(F.col(out)).alias(out))


def running_offsets(df: DataFrame, key: str, value: str, out: str = "offset") -> DataFrame:
    """Add the sum of `value` over all smaller keys, without ordering everything in one task.

    Keys are unique whole numbers. They are cut into spans of 65,536, and spans into
    spans again; each window sorts one span at most, and the last covers one row per
    2^32 keys.
    """

    def before(window: WindowSpec) -> Column:
        up_to_here = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return F.sum(value).over(up_to_here) - F.col(value)

    spans = (
        df.groupBy(F.shiftright(key, SPAN_BITS).alias("span"))
        .agg(F.sum(value).alias(value))
        .withColumn("wide", F.shiftright("span", SPAN_BITS))
    )
    wides = spans.groupBy("wide").agg(F.sum(value).alias(value))
    wides = wides.select("wide", before(Window.orderBy("wide")).alias("wide_offset"))
    spans = (
        spans.withColumn("inner", before(Window.partitionBy("wide").orderBy("span")))
        .join(wides, "wide")
        .select("span", (F.col("inner") + F.col("wide_offset")).alias("span_offset"))
    )
    return (
        df.withColumn("span", F.shiftright(key, SPAN_BITS))
        .withColumn("inner", before(Window.partitionBy("span").orderBy(key)))
        .join(spans, "span")
        .withColumn(out, F.col("inner") + F.col("span_offset"))
        .drop("span", "inner", "span_offset")
    )


def shop_orders(customers: DataFrame, products: int | Column, orders: int | Column, seed: int = 42,
                as_of: date | str | None = None, tasks: int | None = None) -> DataFrame:
    """`orders` order lines, Pareto-distributed over the customers, numbered 1..orders.

    A customer's orders are first cut into blocks of at most 10,000, and the blocks
    spread over the tasks, so that a customer who holds a large share of all orders
    is written by many tasks. Products are drawn evenly from 1..products. Both sizes
    may be columns, such as scalar subqueries; `tasks` is the number of partitions, by
    default one for each core, or for each ROWS_PER_TASK orders where their number is known.
    """
    require_columns(customers, ["customer_id"], "customers")
    if not isinstance(products, Column) and products < 1:
        raise ValueError("products must exist before orders")
    counts = pareto_counts(customers, "customer_id", orders, seed=seed)
    known = 0 if isinstance(orders, Column) else -(-orders // ROWS_PER_TASK)
    tasks = tasks or max(customers.sparkSession.sparkContext.defaultParallelism, known)
    size = F.lit(ORDERS_PER_BLOCK).cast("bigint")
    last_block = F.floor((F.col("order_count") - 1) / size)
    block_numbers = F.when(F.col("order_count") > 0, F.sequence(F.lit(0).cast("bigint"), last_block))
    blocks = (
        running_offsets(counts, "customer_id", "order_count")
        .withColumn("block", F.explode(block_numbers))
        .repartition(tasks, "customer_id", "block")
    )
    numbered = blocks.select(
        "customer_id",
        "offset",
        F.explode(F.sequence(
            F.col("block") * size + 1, F.least((F.col("block") + 1) * size, F.col("order_count"))
        )).alias("nth"),
    ).select((F.col("offset") + F.col("nth")).alias("order_id"), "customer_id")
    key = "order_id"
    return numbered.select(
        "order_id",
        "customer_id",
        whole(uniform(key, seed, "product"), 1, products).alias("product_id"),
        whole(uniform(key, seed, "order", 0, 2), *fixed.SHOP_QUANTITY_RANGE).cast("int").alias("quantity"),
        _seconds_before(as_of, uniform(key, seed, "order", 1, 2), fixed.ORDER_SECONDS).alias("order_date"),
    )


def shuffle_rows(df: DataFrame, key: str, seed: int = 42, out: str = "shuffle_key") -> DataFrame:
    """All rows in a random but repeatable order; the sort key stays as a column."""
    require_columns(df, [key])
    return df.withColumn(out, bits(key, seed, "shuffle")).orderBy(out, key)


def shop_tables(spark: SparkSession, customers: int = fixed.SHOP_SIZES["customers"],
                products: int = fixed.SHOP_SIZES["products"],
                orders: int = fixed.SHOP_SIZES["orders"], seed: int = 42,
                as_of: date | str | None = None, shuffle: bool = True) -> dict[str, DataFrame]:
    ids = entity_ids(spark, customers, "customer_id")
    order_rows = shop_orders(ids, products, orders, seed, as_of)
    return {
        "customers": shop_customers(ids, seed, as_of),
        "products": shop_products(entity_ids(spark, products, "product_id"), seed),
        "orders": shuffle_rows(order_rows, "order_id", seed).drop("shuffle_key") if shuffle else order_rows,
    }


# Store tables ----------------------------------------------------------------


def store_customers(ids: DataFrame, seed: int = 42, as_of: date | str | None = None) -> DataFrame:
    """Customers with an age group and an age inside it; `ids` has a customer_id column."""
    require_columns(ids, ["customer_id"], "ids")
    key, groups = "customer_id", fixed.AGE_GROUPS
    first, last, place = (uniform(key, seed, "person", lane, 3) for lane in range(3))
    gender, active, registered = (uniform(key, seed, "profile", lane, 3) for lane in range(3))
    phone, login = (uniform(key, seed, "contact", lane, 2) for lane in range(2))
    group, within = (uniform(key, seed, "age", lane, 2) for lane in range(2))
    youngest = pick(group, [low for low, _ in groups.values()])
    width = pick(group, [float(high - low + 1) for low, high in groups.values()])
    return ids.select(
        "customer_id",
        pick(first, fixed.FIRST_NAMES).alias("first_name"),
        pick(last, fixed.LAST_NAMES).alias("last_name"),
        _email(key).alias("email"),
        F.concat(F.lit("555-"), F.lpad(whole(phone, 0, 9_999_999).cast("string"), 7, "0")).alias("phone"),
        (youngest + F.floor(within * width)).cast("int").alias("age"),
        pick(group, list(groups)).alias("age_group"),
        pick(gender, fixed.GENDERS).alias("gender"),
        _place(place, 0).alias("city"),
        _place(place, 1).alias("state"),
        _place(place, 2).alias("country"),
        _days_before(as_of, registered, fixed.REGISTRATION_DAYS).alias("registration_date"),
        _seconds_before(as_of, login, fixed.LOGIN_SECONDS).alias("last_login"),
        (active < fixed.ACTIVE_SHARE).alias("is_active"),
    )


def store_products(ids: DataFrame, seed: int = 42, as_of: date | str | None = None) -> DataFrame:
    """A catalogue with prices and costs by category; `ids` has a product_id column."""
    require_columns(ids, ["product_id"], "ids")
    key, ranges = "product_id", fixed.STORE_PRICE_RANGES
    kind, category, name = _product_label(key, seed, ranges)
    price, cost = (uniform(key, seed, "price", lane, 2) for lane in range(2))
    stock, weight = (uniform(key, seed, "numbers", lane, 2) for lane in range(2))
    description, brand, active, created = (uniform(key, seed, "details", lane, 4) for lane in range(4))
    low, high = _bound(kind, ranges, 0), _bound(kind, ranges, 1)
    least, most = low * F.lit(fixed.COST_FACTORS[0]), high * F.lit(fixed.COST_FACTORS[1])
    number = F.col(key).cast("string")
    return ids.select(
        "product_id",
        name.alias("product_name"),
        category.alias("category"),
        pick(description, fixed.DESCRIPTIONS).alias("description"),
        amount(hundredths(price, low, high)).alias("price"),
        amount(hundredths(cost, least, most)).alias("cost"),
        whole(stock, *fixed.STOCK_RANGE).cast("int").alias("stock_quantity"),
        amount(hundredths(weight, *fixed.WEIGHT_RANGE)).alias("weight"),
        pick(brand, fixed.BRANDS).alias("brand"),
        F.concat(F.lit("SKU-"), F.lpad(number, F.greatest(F.length(number), F.lit(6)), F.lit("0"))).alias("sku"),
        _days_before(as_of, created, fixed.CREATED_DAYS).alias("created_date"),
        (active < fixed.ACTIVE_SHARE).alias("is_active"),
    )


def _item_count(order: str, seed: int) -> Column:
    return whole(uniform(order, seed, "header", 0, 3), *fixed.ITEMS_PER_ORDER)


def _item_key(order: str, nth: str | int) -> str:
    """Unique and ascending with the order; there are gaps where an order has fewer items."""
    return f"({order} - 1) * {fixed.ITEMS_PER_ORDER[1]} + {nth}"


def _item_quantity(item_bits: str) -> Column:
    return whole(fraction(item_bits, 0, 2), *fixed.STORE_QUANTITY_RANGE)


def _item_price(item_bits: str) -> Column:
    return hundredths(fraction(item_bits, 1, 2), *fixed.UNIT_PRICE_RANGE)


def store_order_items(ids: DataFrame, products: int | Column, seed: int = 42) -> DataFrame:
    """One to five items per order; `ids` has an order_id column."""
    require_columns(ids, ["order_id"], "ids")
    numbers = F.sequence(F.lit(1).cast("bigint"), _item_count("order_id", seed))
    key, item_bits = "order_item_id", "item_bits"
    items = (
        ids.select("order_id", F.explode(numbers).alias("nth"))
        .select(F.expr(_item_key("order_id", "nth")).alias(key), "order_id")
        .withColumn(item_bits, bits(key, seed, "item"))
    )
    return items.select(
        "order_item_id",
        "order_id",
        whole(uniform(key, seed, "item-product"), 1, products).alias("product_id"),
        _item_quantity(item_bits).cast("int").alias("quantity"),
        amount(_item_price(item_bits)).alias("unit_price"),
        amount(_item_price(item_bits) * _item_quantity(item_bits)).alias("total_price"),
    )


def store_orders(ids: DataFrame, customers: int | Column, seed: int = 42,
                 as_of: date | str | None = None) -> DataFrame:
    """Order headers; the total is the sum of the order's own items.

    Items are functions of the order's key, so the header adds them up in place and
    no shuffle of the items is needed.
    """
    require_columns(ids, ["order_id"], "ids")
    order, numbers = "order_id", range(fixed.ITEMS_PER_ORDER[0], fixed.ITEMS_PER_ORDER[1] + 1)
    drawn = ids.select(
        "order_id",
        _item_count(order, seed).alias("items"),
        *[bits(_item_key(order, nth), seed, "item").alias(f"item_{nth}") for nth in numbers],
    )

    def item_total(nth: int) -> Column:
        value = _item_price(f"item_{nth}") * _item_quantity(f"item_{nth}")
        return F.when(F.col("items") >= nth, value).otherwise(F.lit(0))

    shipping, discounted = (uniform(order, seed, "costs", lane, 2) for lane in range(2))
    total = F.col("total")
    priced = drawn.select(
        "order_id", sum((item_total(nth) for nth in numbers), F.lit(0)).alias("total")
    ).select(
        "order_id",
        "total",
        hundredths(shipping, *fixed.SHIPPING_RANGE).alias("shipping"),
        F.rint(total * fixed.TAX_PERCENT / 100).cast("bigint").alias("tax"),
        F.rint(total * discounted * fixed.DISCOUNT_PERCENT / 100).cast("bigint").alias("discount"),
    )
    street, number, place = (uniform(order, seed, "address", lane, 3) for lane in range(3))
    address = F.concat(
        whole(number, 1, 999).cast("string"), F.lit(" "), pick(street, fixed.STREETS), F.lit(", "),
        _place(place, 0), F.lit(", "), _place(place, 1),
    )
    return priced.select(
        "order_id",
        whole(uniform(order, seed, "customer"), 1, customers).alias("customer_id"),
        _seconds_before(as_of, uniform(order, seed, "ordered"), fixed.ORDER_SECONDS).alias("order_date"),
        pick(uniform(order, seed, "header", 1, 3), fixed.ORDER_STATUSES).alias("order_status"),
        pick(uniform(order, seed, "header", 2, 3), fixed.PAYMENT_METHODS).alias("payment_method"),
        address.alias("shipping_address"),
        amount(total).alias("order_total"),
        amount(F.col("shipping")).alias("shipping_cost"),
        amount(F.col("tax")).alias("tax_amount"),
        amount(F.col("discount")).alias("discount_amount"),
        amount(total + F.col("shipping") + F.col("tax") - F.col("discount")).alias("final_amount"),
    )


def store_tables(spark: SparkSession, customers: int = fixed.STORE_SIZES["customers"],
                 products: int = fixed.STORE_SIZES["products"],
                 orders: int = fixed.STORE_SIZES["orders"], seed: int = 42,
                 as_of: date | str | None = None) -> dict[str, DataFrame]:
    order_ids = entity_ids(spark, orders, "order_id")
    return {
        "customers": store_customers(entity_ids(spark, customers, "customer_id"), seed, as_of),
        "products": store_products(entity_ids(spark, products, "product_id"), seed, as_of),
        "orders": store_orders(order_ids, customers, seed, as_of),
        "order_items": store_order_items(order_ids, products, seed),
    }


# Rows for the storage comparison, and the summary ------------------------------


def benchmark_rows(ids: DataFrame, seed: int = 42) -> DataFrame:
    """Rows with an hourly date from 2020 on; `ids` has an id column that starts at 1.

    Every row has its own hour. Beyond the calendar of Spark's timestamps, some two
    billion rows, it raises.
    """
    require_columns(ids, ["id"], "ids")
    key = "id"
    start = F.lit(fixed.BENCHMARK_START).cast("timestamp_ntz")
    return ids.select(
        "id",
        F.concat(F.lit("Product_"), F.col(key).cast("string")).alias("name"),
        _email(key).alias("email"),
        amount(hundredths(uniform(key, seed, "row", 0, 2), *fixed.BENCHMARK_AMOUNT_RANGE)).alias("amount"),
        F.timestamp_add("HOUR", F.col(key) - 1, start).alias("date"),
        pick(uniform(key, seed, "row", 1, 2), fixed.BENCHMARK_CATEGORIES).alias("category"),
    )


def data_summary(tables: Mapping[str, DataFrame], files: DataFrame | None = None) -> DataFrame:
    """(table, row_count, categories, category_names): sizes, and the categories where a table has them.

    With `files`, a report by `file_size_report`, also its size_bytes, size and last_modified.
    """
    counts = table_row_counts(tables)
    categorised = [name for name, df in tables.items() if "category" in df.columns]
    found, names = F.lit(None).cast("bigint"), F.lit(None).cast("string")
    for name in categorised:
        distinct = tables[name].agg(F.sort_array(F.collect_set("category"))).scalar()  # a fixed list of names
        found = F.when(F.col("table") == name, F.size(distinct).cast("bigint")).otherwise(found)
        names = F.when(F.col("table") == name, F.array_join(distinct, ", ")).otherwise(names)
    summary = counts.withColumn("categories", found).withColumn("category_names", names)
    if files is None:
        return summary
    return summary.join(files.select(F.col("name").alias("table"), "size_bytes", "size", "last_modified"), "table", "left")
