"""SQL over the test tables that must return the same rows as the registered queries.

The SQL is written from the meaning of each query, without the eager aggregation,
the span sums or the in-place order totals that the Spark side uses.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from tillframe import constants as fixed
from tillframe.functions import permutation

AS_OF = "DATE '2001-08-02'"
GENERATED_AS_OF = "DATE '2024-01-01'"


def _cents(value: str) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(28, 8)), 2) AS DOUBLE)"


def _money(column: str) -> str:
    return f"CAST({column} AS DECIMAL(17, 4))"


LINE = f"""
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, l_partkey AS product_id,
           o_orderdate AS order_date, p_type AS category, l_quantity AS quantity,
           p_retailprice AS price, {_money("l_quantity")} * {_money("p_retailprice")} AS revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
"""

ORDERS_AS_WRITTEN = "SELECT * FROM orders"

TOP_CUSTOMERS = f"""
    SELECT customer_id, {_cents("sum(revenue)")} AS total_revenue, count(order_id) AS order_count,
           {_cents("CAST(sum(revenue) AS DOUBLE) / count(revenue)")} AS avg_order_value
    FROM ({LINE}) GROUP BY customer_id ORDER BY total_revenue DESC, customer_id LIMIT 10
"""

SALES_BY_CATEGORY = f"""
    SELECT category, {_cents("sum(revenue)")} AS total_revenue,
           CAST(sum({_money("quantity")}) AS DOUBLE) AS total_units_sold,
           count(DISTINCT product_id) AS unique_products,
           {_cents(f"CAST(sum({_money('price')}) AS DOUBLE) / count(price)")} AS avg_price_per_unit
    FROM ({LINE}) GROUP BY category
"""

MONTHLY_TRENDS = f"""
    WITH months AS (
        SELECT CAST(year(order_date) AS BIGINT) AS year, CAST(month(order_date) AS BIGINT) AS month,
               sum(revenue) AS revenue
        FROM ({LINE}) GROUP BY 1, 2
    ), paired AS (
        SELECT *, lag(revenue) OVER (ORDER BY year, month) AS previous FROM months
    )
    SELECT year, month, {_cents("revenue")} AS monthly_revenue,
           CASE WHEN previous > 0
                THEN {_cents("CAST(revenue - previous AS DOUBLE) / CAST(previous AS DOUBLE) * 100")}
           END AS monthly_growth_pct,
           {_cents("coalesce(revenue - previous, 0)")} AS revenue_change
    FROM paired
"""


def _order_measures(total: str, rows: str = "count(*)", name: str = "order_count") -> str:
    return (
        f"{rows} AS {name}, CAST(sum({_money(total)}) AS DOUBLE) AS total_revenue, "
        f"CAST(sum({_money(total)}) AS DOUBLE) / count({total}) AS avg_order_value"
    )


SALES_OVERVIEW = f"""
    SELECT {_order_measures("o_totalprice", "count(o_orderkey)", "total_orders")},
           max(o_totalprice) AS max_order_value, min(o_totalprice) AS min_order_value,
           count(DISTINCT o_custkey) AS unique_customers
    FROM orders
"""

MONTHLY_SALES = f"""
    SELECT CAST(year(o_orderdate) AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS month,
           {_order_measures("o_totalprice")}
    FROM orders GROUP BY 1, 2
"""

HOURLY_EVENTS = f"""
    SELECT CAST(hour(ts) AS BIGINT) AS hour, {_order_measures("value")} FROM events GROUP BY 1
"""

HOURLY_ORDERS = f"""
    SELECT CAST(hour(o_orderdate) AS BIGINT) AS hour, {_order_measures("o_totalprice")}
    FROM orders GROUP BY 1
"""

ITEM_MEASURES = f"""
    CAST(sum({_money("l_quantity")}) AS DOUBLE) AS total_quantity_sold,
    CAST(sum({_money("l_extendedprice")}) AS DOUBLE) AS total_revenue
"""

TOP_PRODUCTS = f"""
    SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, {ITEM_MEASURES},
           count(l_orderkey) AS order_count
    FROM lineitem JOIN part ON l_partkey = p_partkey
    GROUP BY 1, 2, 3 ORDER BY total_revenue DESC, product_id LIMIT 10
"""

CATEGORY_PERFORMANCE = f"""
    SELECT p_type AS category, {ITEM_MEASURES}, count(DISTINCT l_partkey) AS unique_products,
           count(l_orderkey) AS order_count
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1
"""


def _case(column: str, sign: str, bins: Iterable[tuple], default: object) -> str:
    def literal(value: object) -> str:
        return f"'{value}'" if isinstance(value, str) else f"CAST({value} AS INTEGER)"

    tests = " ".join(f"WHEN {column} {sign} {limit} THEN {literal(value)}" for limit, value in bins)
    return f"CASE {tests} ELSE {literal(default)} END"


RFM_METRICS = f"""
    SELECT o_custkey AS customer_id, max(o_orderdate) AS last_order_date,
           count(o_orderkey) AS frequency, CAST(sum({_money("o_totalprice")}) AS DOUBLE) AS monetary,
           CAST(date_diff('day', CAST(max(o_orderdate) AS DATE), {AS_OF}) AS BIGINT) AS recency_days
    FROM orders GROUP BY 1
"""


def _rfm_scores(frequency: Iterable[tuple], monetary: Iterable[tuple]) -> str:
    return f"""
        SELECT *, recency_score + frequency_score + monetary_score AS rfm_score
        FROM (
            SELECT *,
                   {_case("recency_days", "<=", ((30, 5), (60, 4), (90, 3), (180, 2)), 1)} AS recency_score,
                   {_case("frequency", ">=", frequency, 1)} AS frequency_score,
                   {_case("monetary", ">=", monetary, 1)} AS monetary_score
            FROM ({RFM_METRICS})
        )
    """


def _segments(scores: str) -> str:
    names = ((13, "Champions"), (10, "Loyal Customers"), (7, "Potential Loyalists"), (5, "At Risk"))
    return f"SELECT *, {_case('rfm_score', '>=', names, 'Lost')} AS segment FROM ({scores})"


RFM_SCORES = _rfm_scores(
    ((10, 5), (7, 4), (5, 3), (3, 2)), ((1000, 5), (500, 4), (200, 3), (100, 2))
)
SEGMENTS = _segments(RFM_SCORES)
SEGMENTS_SCALED = _segments(_rfm_scores(
    ((14, 5), (11, 4), (9, 3), (6, 2)),
    ((3200000, 5), (2600000, 4), (2200000, 3), (1700000, 2)),
))


def _scan() -> str:
    columns = (
        ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
        ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
        ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
        ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"),
    )
    values = ", ".join(f"(CAST({i} AS BIGINT), '{n}', '{t}')" for i, (n, t) in enumerate(columns, 1))
    return f"""
        SELECT (SELECT count(*) FROM lineitem) AS row_count, CAST({len(columns)} AS BIGINT) AS column_count,
               position, "column", type
        FROM (VALUES {values}) AS v(position, "column", type)
    """


def _counts(named: Mapping[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", count(*) AS row_count FROM {table}" for name, table in named.items()
    )


SCHEMA_AUDIT = " UNION ALL ".join(
    f"SELECT '{table}' AS \"table\", '{column}' AS \"column\", {str(source is not None).lower()} AS present, "
    + (f"count({source}) AS filled_rows FROM {origin}" if source else "CAST(NULL AS BIGINT) AS filled_rows")
    for table, origin, column, source in (
        ("orders", "lineitem", "order_id", "l_orderkey"),
        ("orders", "lineitem", "product_id", "l_partkey"),
        ("orders", "lineitem", "quantity", "l_quantity"),
        ("orders", "lineitem", "order_date", None),
        ("products", "part", "product_id", "p_partkey"),
        ("products", "part", "price", "p_retailprice"),
        ("products", "part", "category", "p_type"),
    )
)

INPUT_AUDIT = """
    SELECT 'customers' AS name, true AS present, count(*) AS row_count FROM customer
    UNION ALL SELECT 'products', true, count(*) FROM part
    UNION ALL SELECT 'orders', true, count(*) FROM orders
    UNION ALL SELECT 'returns', false, CAST(NULL AS BIGINT)
"""

FORMAT_BYTES = """
    WITH sized AS (
        SELECT o_orderkey AS order_id,
               CAST(round(o_totalprice * 100) AS BIGINT) * CAST(pow(1024, o_orderkey % 4) AS BIGINT) AS size_bytes
        FROM orders
    ), powered AS (
        SELECT *, CASE WHEN size_bytes >= 1099511627776 THEN 4 WHEN size_bytes >= 1073741824 THEN 3
                       WHEN size_bytes >= 1048576 THEN 2 WHEN size_bytes >= 1024 THEN 1 ELSE 0 END AS k
        FROM sized
    )
    SELECT order_id, size_bytes,
           CASE WHEN size_bytes = 0 THEN '0 B'
                ELSE printf('%.2f', CAST(size_bytes AS DOUBLE) / pow(1024, k)) || ' ' ||
                     ['B', 'KB', 'MB', 'GB', 'TB'][k + 1]
           END AS size
    FROM powered
"""

SHARE_OF_TOTAL = f"""
    WITH sales AS (SELECT category, total_revenue FROM ({SALES_BY_CATEGORY}))
    SELECT category, total_revenue,
           {_cents("total_revenue / (SELECT sum(total_revenue) FROM sales) * 100")} AS share_pct
    FROM sales
"""

RATIO_TO_BASELINE = f"""
    WITH sales AS ({CATEGORY_PERFORMANCE}), base AS (SELECT * FROM sales WHERE category = 'ECONOMY')
    SELECT s.category, s.total_revenue, s.total_quantity_sold, s.order_count,
           {_cents("s.total_revenue / coalesce(b.total_revenue, 1) * 100")} AS revenue_pct,
           {_cents("s.total_quantity_sold / coalesce(b.total_quantity_sold, 1) * 100")} AS quantity_pct,
           {_cents("CAST(s.order_count AS DOUBLE) / coalesce(b.order_count, 1) * 100")} AS items_pct
    FROM sales s LEFT JOIN base b ON true
"""


def _best(metrics: Mapping[str, str]) -> str:
    return f"WITH sales AS ({CATEGORY_PERFORMANCE}) " + " UNION ALL ".join(
        f"(SELECT '{name}' AS metric, category AS best, CAST({value} AS DOUBLE) AS value FROM sales "
        f"ORDER BY value, category LIMIT 1)"
        for name, value in metrics.items()
    )


BEST_BY_METRIC = _best({
    "total_quantity_sold": "total_quantity_sold",
    "total_revenue": "total_revenue",
    "unique_products": "unique_products",
    "order_count": "order_count",
    "revenue_per_item": "total_revenue / order_count",
    "units_per_item": "total_quantity_sold / order_count",
})

RESULT_RECONCILIATION = f"""
    WITH customers AS (SELECT count(DISTINCT customer_id) AS n FROM ({LINE}))
    SELECT n AS left_rows, n AS right_rows, CAST(2 AS BIGINT) AS left_columns,
           CAST(2 AS BIGINT) AS right_columns, true AS same_shape, CAST(0 AS BIGINT) AS only_left,
           CAST(0 AS BIGINT) AS only_right, true AS same_rows
    FROM customers
"""


# Generated tables --------------------------------------------------------------


def _bits(key: str, name: str) -> str:
    return f"CAST('0x' || substr(md5('42:{name}:' || CAST({key} AS VARCHAR)), 1, 15) AS BIGINT)"


def _draw(key: str, name: str, lane: int = 0, lanes: int = 1) -> str:
    width = 60 // lanes
    kept = min(width, 52)
    lane_bits = f"(({_bits(key, name)} >> {lane * width}) & {2**kept - 1})"
    return f"((CAST({lane_bits} AS DOUBLE) + 0.5e0) / {2**kept}e0)"


def _normal(key: str, name: str) -> str:
    return f"(sqrt(-2e0 * ln({_draw(key, name, 0, 2)})) * cos(6.283185307179586e0 * {_draw(key, name, 1, 2)}))"


def _whole(draw: str, low: int, high: int) -> str:
    return f"({low} + CAST(floor({draw} * {high - low + 1}e0) AS BIGINT))"


def _hundredths(draw: str, low: str, high: str) -> str:
    return f"CAST(round(({low} + {draw} * ({high} - {low})) * 100e0) AS BIGINT)"


def _between(draw: str, low: str, high: str) -> str:
    return f"({_hundredths(draw, low, high)} / 100e0)"


def _list(values: Iterable) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else f"{float(v)!r}e0" for v in values) + "]"


def _pick(draw: str, values: Iterable) -> str:
    values = list(values)
    return f"{_list(values)}[1 + CAST(floor({draw} * {len(values)}e0) AS INTEGER)]"


def _days_before(draw: str, days: int) -> str:
    return f"({GENERATED_AS_OF} - CAST({_whole(draw, 0, days)} AS INTEGER))"


def _seconds_before(draw: str, seconds: int) -> str:
    return f"(CAST({GENERATED_AS_OF} AS TIMESTAMP) - to_seconds({_whole(draw, 0, seconds)}))"


def _place(key: str, name: str, part: int) -> str:
    return _pick(_draw(key, name, 2, 3), [place[part] for place in fixed.PLACES])


def _product_name(key: str, categories: Iterable[str]) -> str:
    return " || ' ' || ".join(
        _pick(_draw(key, "label", lane, 3), words)
        for lane, words in enumerate((categories, fixed.PHRASE_STARTS, fixed.PHRASE_ENDS))
    )


def _ranged(ranges: Mapping[str, tuple], draw: str, end: int) -> str:
    return _pick(draw, [r[end] for r in ranges.values()])


GEN_CUSTOMERS = f"""
    SELECT id AS customer_id,
           {_pick(_draw("id", "person", 0, 3), fixed.FIRST_NAMES)} || ' ' || {_pick(_draw("id", "person", 1, 3), fixed.LAST_NAMES)} AS name,
           'user' || id || '@example.com' AS email,
           CAST(greatest(18, least(80, floor(CAST(35e0 + 12e0 * {_normal("id", "age")} AS DECIMAL(28, 8))))) AS INTEGER) AS age,
           {_place("id", "person", 0)} AS city, {_place("id", "person", 2)} AS country,
           {_days_before(_draw("id", "registered"), 1825)} AS registration_date
    FROM (SELECT c_custkey + 1 AS id FROM customer)
"""

_KIND = _draw("id", "label", 0, 3)
_SHOP_LOW, _SHOP_HIGH = (_ranged(fixed.SHOP_PRICE_RANGES, _KIND, end) for end in (0, 1))
GEN_PRODUCTS = f"""
    SELECT id AS product_id,
           {_product_name("id", fixed.SHOP_PRICE_RANGES)} AS name,
           {_pick(_KIND, fixed.SHOP_PRICE_RANGES)} AS category,
           {_between(_draw("id", "numbers", 0, 2), _SHOP_LOW, _SHOP_HIGH)} AS price,
           CAST({_whole(_draw("id", "numbers", 1, 2), 10, 1000)} AS INTEGER) AS stock,
           CAST(greatest(1, least(5, round(CAST(4e0 + 0.8e0 * {_normal("id", "rating")} AS DECIMAL(28, 8)), 1))) AS DOUBLE) AS rating
    FROM (SELECT p_partkey + 1 AS id FROM part)
"""

PARETO = f"""
    WITH weights AS (
        SELECT c_custkey + 1 AS id,
               CAST(pow(1e0 - {_draw("(c_custkey + 1)", "pareto")}, -1e0 / 1.16e0) - 1e0 AS DECIMAL(24, 6)) AS weight
        FROM customer
    ), sized AS (SELECT count(*) AS total FROM orders),
    parts AS (
        SELECT id, CAST(round_even(CAST(weight AS DOUBLE) / (SELECT CAST(sum(weight) AS DOUBLE) FROM weights)
                        * (SELECT CAST(total AS DOUBLE) FROM sized), 0) AS BIGINT) AS part
        FROM weights
    ), largest AS (SELECT id FROM weights ORDER BY weight DESC, id LIMIT 1)
    SELECT id AS customer_id,
           CAST(part + CASE WHEN id = (SELECT id FROM largest)
                            THEN (SELECT total FROM sized) - (SELECT sum(part) FROM parts) ELSE 0 END AS BIGINT)
           AS order_count
    FROM parts
"""

GEN_ORDERS = f"""
    WITH counts AS (
        SELECT customer_id, order_count,
               coalesce(sum(order_count) OVER (ORDER BY customer_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
        FROM ({PARETO})
    ), numbered AS (
        SELECT CAST(before + nth AS BIGINT) AS id, customer_id
        FROM (SELECT customer_id, before, unnest(range(1, order_count + 1)) AS nth FROM counts)
    )
    SELECT id AS order_id, customer_id,
           1 + CAST(floor({_draw("id", "product")} * (SELECT CAST(count(*) AS DOUBLE) FROM part)) AS BIGINT) AS product_id,
           CAST({_whole(_draw("id", "order", 0, 2), 1, 10)} AS INTEGER) AS quantity,
           {_seconds_before(_draw("id", "order", 1, 2), 31536000)} AS order_date
    FROM numbered
"""

GEN_SHUFFLE = f"""
    SELECT *, {_bits("o_orderkey", "shuffle")} AS shuffle_key FROM orders
"""

_GROUP = _draw("id", "age", 0, 2)
GEN_CUSTOMERS_PROFILE = f"""
    SELECT id AS customer_id,
           {_pick(_draw("id", "person", 0, 3), fixed.FIRST_NAMES)} AS first_name,
           {_pick(_draw("id", "person", 1, 3), fixed.LAST_NAMES)} AS last_name,
           'user' || id || '@example.com' AS email,
           '555-' || lpad(CAST({_whole(_draw("id", "contact", 0, 2), 0, 9999999)} AS VARCHAR), 7, '0') AS phone,
           CAST({_pick(_GROUP, [18, 26, 46, 66])} + floor({_draw("id", "age", 1, 2)} * {_pick(_GROUP, [8, 20, 20, 15])}) AS INTEGER) AS age,
           {_pick(_GROUP, fixed.AGE_GROUPS)} AS age_group,
           {_pick(_draw("id", "profile", 0, 3), fixed.GENDERS)} AS gender,
           {_place("id", "person", 0)} AS city, {_place("id", "person", 1)} AS state, {_place("id", "person", 2)} AS country,
           {_days_before(_draw("id", "profile", 2, 3), 1825)} AS registration_date,
           {_seconds_before(_draw("id", "contact", 1, 2), 2592000)} AS last_login,
           {_draw("id", "profile", 1, 3)} < 0.75e0 AS is_active
    FROM (SELECT c_custkey + 1 AS id FROM customer)
"""

_LOW, _HIGH = (_ranged(fixed.STORE_PRICE_RANGES, _KIND, end) for end in (0, 1))
GEN_PRODUCTS_CATALOG = f"""
    SELECT id AS product_id,
           {_product_name("id", fixed.STORE_PRICE_RANGES)} AS product_name,
           {_pick(_KIND, fixed.STORE_PRICE_RANGES)} AS category,
           {_pick(_draw("id", "details", 0, 4), fixed.DESCRIPTIONS)} AS description,
           {_between(_draw("id", "price", 0, 2), _LOW, _HIGH)} AS price,
           {_between(_draw("id", "price", 1, 2), f"({_LOW} * 0.3e0)", f"({_HIGH} * 0.6e0)")} AS cost,
           CAST({_whole(_draw("id", "numbers", 0, 2), 10, 1000)} AS INTEGER) AS stock_quantity,
           {_between(_draw("id", "numbers", 1, 2), "0.1e0", "50e0")} AS weight,
           {_pick(_draw("id", "details", 1, 4), fixed.BRANDS)} AS brand,
           'SKU-' || lpad(CAST(id AS VARCHAR), CAST(greatest(6, length(CAST(id AS VARCHAR))) AS INTEGER), '0') AS sku,
           {_days_before(_draw("id", "details", 3, 4), 730)} AS created_date,
           {_draw("id", "details", 2, 4)} < 0.75e0 AS is_active
    FROM (SELECT p_partkey + 1 AS id FROM part)
"""

ORDER_ITEMS = f"""
    SELECT item, id AS order_id,
           1 + CAST(floor({_draw("item", "item-product")} * (SELECT CAST(count(*) AS DOUBLE) FROM part)) AS BIGINT) AS product_id,
           {_whole(_draw("item", "item", 0, 2), 1, 5)} AS quantity,
           {_hundredths(_draw("item", "item", 1, 2), "10e0", "500e0")} AS price
    FROM (
        SELECT id, (id - 1) * 5 + unnest(range(1, items + 1)) AS item
        FROM (
            SELECT id, {_whole(_draw("id", "header", 0, 3), 1, 5)} AS items
            FROM (SELECT o_orderkey + 1 AS id FROM orders)
        )
    )
"""

GEN_ORDER_ITEMS = f"""
    SELECT item AS order_item_id, order_id, product_id, CAST(quantity AS INTEGER) AS quantity,
           price / 100e0 AS unit_price, price * quantity / 100e0 AS total_price
    FROM ({ORDER_ITEMS})
"""

GEN_ORDERS_HEADER = f"""
    WITH totals AS (
        SELECT order_id AS id, CAST(sum(price * quantity) AS BIGINT) AS total
        FROM ({ORDER_ITEMS}) GROUP BY order_id
    ), priced AS (
        SELECT id, total, {_hundredths(_draw("id", "costs", 0, 2), "5e0", "25e0")} AS shipping,
               CAST(round(total * 8 / 100e0) AS BIGINT) AS tax,
               CAST(round(total * {_draw("id", "costs", 1, 2)} * 10 / 100e0) AS BIGINT) AS discount
        FROM totals
    )
    SELECT id AS order_id,
           1 + CAST(floor({_draw("id", "customer")} * (SELECT CAST(count(*) AS DOUBLE) FROM customer)) AS BIGINT) AS customer_id,
           {_seconds_before(_draw("id", "ordered"), 31536000)} AS order_date,
           {_pick(_draw("id", "header", 1, 3), fixed.ORDER_STATUSES)} AS order_status,
           {_pick(_draw("id", "header", 2, 3), fixed.PAYMENT_METHODS)} AS payment_method,
           {_whole(_draw("id", "address", 1, 3), 1, 999)} || ' ' || {_pick(_draw("id", "address", 0, 3), fixed.STREETS)} || ', ' ||
               {_place("id", "address", 0)} || ', ' || {_place("id", "address", 1)} AS shipping_address,
           total / 100e0 AS order_total, shipping / 100e0 AS shipping_cost,
           tax / 100e0 AS tax_amount, discount / 100e0 AS discount_amount,
           (total + shipping + tax - discount) / 100e0 AS final_amount
    FROM priced
"""

GEN_BENCHMARK_ROWS = f"""
    SELECT id, 'Product_' || id AS name, 'user' || id || '@example.com' AS email,
           {_between(_draw("id", "row", 0, 2), "1e0", "1000e0")} AS amount,
           TIMESTAMP '2020-01-01 00:00:00' + to_hours(id - 1) AS date,
           {_pick(_draw("id", "row", 1, 2), fixed.BENCHMARK_CATEGORIES)} AS category
    FROM (SELECT o_orderkey + 1 AS id FROM orders)
"""

GEN_SUMMARY = f"""
    SELECT 'customers' AS "table", count(*) AS row_count, CAST(NULL AS BIGINT) AS categories, CAST(NULL AS VARCHAR) AS category_names
    FROM customer
    UNION ALL SELECT 'products', count(*), count(DISTINCT category), string_agg(DISTINCT category, ', ' ORDER BY category)
    FROM ({GEN_PRODUCTS})
    UNION ALL SELECT 'orders', count(*), NULL, NULL FROM orders
"""

STORED_TABLES = " UNION ALL ".join(
    f"SELECT '{name}' AS name, CAST({columns} AS BIGINT) AS column_count, count(*) AS row_count, true AS total_adds_up FROM {table}"
    for name, table, columns in (("customers", "customer", 5), ("products", "part", 6), ("orders", "orders", 6), ("order_items", "lineitem", 11))
)

TIMED_ANALYSES = " UNION ALL ".join(
    f"SELECT '{name}' AS operation, count(*) AS row_count, true AS timed, true AS pct_adds_up FROM ({sql})"
    for name, sql in (("top_customers", TOP_CUSTOMERS), ("category_sales", SALES_BY_CATEGORY), ("monthly_trends", MONTHLY_TRENDS))
)

FORMAT_ROWS = f"""
    SELECT format, CAST(NULL AS VARCHAR) AS error, true AS measured, count(*) AS row_count,
           CAST(sum({_money("l_quantity")}) AS DOUBLE) AS sum_l_quantity,
           CAST(sum({_money("l_extendedprice")}) AS DOUBLE) AS sum_l_extendedprice
    FROM lineitem, (VALUES ('CSV'), ('JSON'), ('PARQUET'), ('ORC')) AS f(format) GROUP BY format
"""


# Long-form reports ---------------------------------------------------------------


def _cells(report: str, sql: str, key: str, numbers: Iterable[str], texts: Iterable[str] = ()) -> str:
    row = f"SELECT '{report}' AS report, {key} AS row_key"
    return " UNION ALL ".join(
        [f"{row}, '{n}' AS metric, CAST({n} AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS label FROM ({sql})" for n in numbers]
        + [f"{row}, '{t}' AS metric, CAST(NULL AS DOUBLE) AS value, CAST({t} AS VARCHAR) AS label FROM ({sql})" for t in texts]
    )


_MONTH_KEY = "year || '|' || month"
_BASE_MEASURES = ("order_count", "total_revenue", "avg_order_value")

SALES_REPORT = " UNION ALL ".join((
    _cells("top_customers", TOP_CUSTOMERS, "CAST(customer_id AS VARCHAR)",
           ("total_revenue", "order_count", "avg_order_value")),
    _cells("category_sales", SALES_BY_CATEGORY, "category",
           ("total_revenue", "total_units_sold", "unique_products", "avg_price_per_unit")),
    _cells("monthly_trends", MONTHLY_TRENDS, _MONTH_KEY,
           ("monthly_revenue", "monthly_growth_pct", "revenue_change")),
))

FULL_REPORT = " UNION ALL ".join((
    _cells("sales_overview", SALES_OVERVIEW, "'all'",
           ("total_orders", "total_revenue", "avg_order_value", "max_order_value", "min_order_value",
            "unique_customers")),
    _cells("monthly_sales_trends", MONTHLY_SALES, _MONTH_KEY, _BASE_MEASURES),
    _cells("top_products", TOP_PRODUCTS, "CAST(product_id AS VARCHAR)",
           ("total_quantity_sold", "total_revenue", "order_count"), ("product_name", "category")),
    _cells("customer_segments", SEGMENTS, "CAST(customer_id AS VARCHAR)",
           ("frequency", "monetary", "recency_days", "recency_score", "frequency_score", "monetary_score",
            "rfm_score"),
           ("last_order_date", "segment")),
    _cells("category_performance", CATEGORY_PERFORMANCE, "category",
           ("total_quantity_sold", "total_revenue", "unique_products", "order_count")),
    _cells("hourly_sales_pattern", HOURLY_ORDERS, "CAST(hour AS VARCHAR)", _BASE_MEASURES),
))

FREQUENT_PRODUCTS = """
    SELECT l_partkey AS product_id, count(*) AS rows, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM lineitem) * 100 AS share_pct
    FROM lineitem GROUP BY 1 HAVING count(*) >= (SELECT count(*) FROM lineitem) * (1.1e0 / (SELECT count(*) FROM part))
"""

#: Charges below 2**18 are whole multiples of 2**-52 * 2**8, so scaled by 2**44 they add up exactly as whole numbers; text is parsed to the nearest double.
EXACT_CUSTOMER_REVENUE = """
    SELECT o_custkey AS customer_id, CAST(CAST(sum(CAST(charge * 17592186044416e0 AS HUGEINT)) AS VARCHAR) AS DOUBLE) / 17592186044416e0 AS revenue
    FROM (SELECT l_orderkey, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge FROM lineitem) JOIN orders ON l_orderkey = o_orderkey
    GROUP BY 1
"""

CUSTOMERS_BY_MONTH = """
    SELECT CAST(year(o_orderdate) AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS month, count(DISTINCT o_custkey) AS customers
    FROM orders GROUP BY 1, 2 UNION ALL SELECT NULL, NULL, count(DISTINCT o_custkey) FROM orders
"""

ORDER_DIFFERENCES = """
    WITH edited AS (
        SELECT CASE WHEN o_orderkey % 89 = 0 THEN -o_orderkey ELSE o_orderkey END AS order_id,
               CASE WHEN o_orderkey % 83 = 0 THEN NULL ELSE o_custkey END AS customer_id,
               CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 0.25e0 WHEN o_orderkey % 5 = 0 THEN o_totalprice + 16e0 ELSE o_totalprice END AS order_total
        FROM orders WHERE o_orderkey % 97 <> 0
    ), paired AS (
        SELECT coalesce(o_orderkey, order_id) AS order_id, o_orderkey IS NULL AS is_new, e.order_id IS NULL AS is_gone,
               o_custkey AS customer_id_left, customer_id AS customer_id_right, o_totalprice AS order_total_left, order_total AS order_total_right
        FROM orders FULL JOIN edited e ON o_orderkey = order_id
    ), judged AS (
        SELECT *, customer_id_left IS DISTINCT FROM customer_id_right AS other_customer, abs(order_total_left - order_total_right) > 0.5e0 AS other_total
        FROM paired
    )
    SELECT order_id, CASE WHEN is_gone THEN 'only_left' WHEN is_new THEN 'only_right' ELSE 'differs' END AS status,
           CASE WHEN is_gone OR is_new THEN NULL ELSE concat_ws(',', CASE WHEN other_customer THEN 'customer_id' END, CASE WHEN other_total THEN 'order_total' END) END AS columns,
           customer_id_left, customer_id_right, order_total_left, order_total_right
    FROM judged WHERE is_gone OR is_new OR other_customer OR other_total
"""

ORDER_DIFFERENCE_SUMMARY = f"""
    SELECT status, columns, count(*) AS keys, round(sum(order_total_right - order_total_left), 2) AS order_total_change
    FROM ({ORDER_DIFFERENCES}) GROUP BY 1, 2
"""

def _shuffled(seed: int, files: int) -> str:
    """Orders by their place in the keyed permutation; the grid comes from the number of orders."""
    steps = []
    for i, step in enumerate(permutation.rounds(4, seed)):
        a, b, c, d = step.factors
        other, own, size = ("c", "r", "n_rows") if step.on_row else ("r", "c", "n_columns")
        prime = permutation.PRIME
        moved = f"({own} + ((h * h + {c}) % {prime} * {d} + {other}) % {prime}) % {size}"
        start = "n - n_rows * n_columns" if i // permutation.ROUNDS % 2 else "0"
        cell = f"{moved} * n_columns + c" if step.on_row else f"r * n_columns + {moved}"
        steps.append(f"""step_{i + 1} AS MATERIALIZED (SELECT order_id, number, n, n_rows, n_columns,
            CASE WHEN spot >= 0 AND spot < n_rows * n_columns THEN start + {cell} ELSE place END AS place
          FROM (SELECT *, ({other} * {a} + {b}) % {prime} AS h FROM (SELECT *, spot // n_columns AS r, spot % n_columns AS c
            FROM (SELECT *, {start} AS start, place - ({start}) AS spot FROM step_{i}))))""")
    return f"""WITH counted AS (SELECT o_orderkey + 1 AS order_id, row_number() OVER (ORDER BY o_orderkey) - 1 AS number, count(*) OVER () AS n FROM orders),
      step_0 AS (SELECT *, number AS place, floor(sqrt(n))::BIGINT AS n_rows, n // floor(sqrt(n))::BIGINT AS n_columns FROM counted),
      {", ".join(steps)}
      SELECT order_id, number, place, place // ((n + {files - 1}) // {files}) AS file, place % ((n + {files - 1}) // {files}) + 1 AS nth FROM step_{len(steps)}"""


SHUFFLED_ORDERS = _shuffled(42, 16)

CSV_REJECTS = """
    WITH fields AS (
        SELECT o_orderkey AS k, CASE WHEN o_orderkey % 101 = 0 THEN 'no. ' ELSE '' END || o_orderkey AS a, o_custkey::VARCHAR AS b,
               CASE WHEN o_orderkey % 97 = 0 THEN 'n/a' ELSE round(o_totalprice * 100)::BIGINT::VARCHAR END AS c,
               round(o_totalprice * 100)::BIGINT AS cents, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders
    ), lines AS (
        SELECT *, k % 89 = 0 OR k % 83 = 0 AS uneven, CASE WHEN k % 89 = 0 THEN concat_ws(',', a, b, c)
            WHEN k % 83 = 0 THEN concat_ws(',', a, b, c, d, 'more') ELSE concat_ws(',', a, b, c, d) END AS line FROM fields
    ), faults AS (
        SELECT 'fields' AS fault, NULL AS "column", line FROM lines WHERE uneven
        UNION ALL SELECT 'values', 'order_id', line FROM lines WHERE NOT uneven AND k % 101 = 0
        UNION ALL SELECT 'values', 'cents', line FROM lines WHERE NOT uneven AND k % 97 = 0
    )
    SELECT fault, "column", count(*) AS records, sum(strlen(line))::BIGINT AS n_bytes, NULL::BIGINT AS cents FROM faults GROUP BY ALL
    UNION ALL SELECT 'none', NULL, count(*), CASE WHEN count(*) > 0 THEN 0 END::BIGINT, sum(cents)::BIGINT FROM lines
    WHERE NOT uneven AND k % 101 <> 0 AND k % 97 <> 0
"""

REPLACED_TABLE = """
    SELECT c_custkey, c_acctbal + 1 AS c_acctbal, true AS last_write_failed, 0::BIGINT AS file_faults FROM customer WHERE c_custkey % 3 <> 0
"""

ORACLE_SQL: dict[str, str] = {
    "scan_parquet": _scan(),
    "input_audit": INPUT_AUDIT,
    "schema_audit": SCHEMA_AUDIT,
    "table_row_counts": _counts({"customers": "customer", "products": "part", "orders": "orders", "order_items": "lineitem"}),
    "preview_rows": "SELECT * FROM customer ORDER BY c_custkey LIMIT 3",
    "csv_roundtrip": ORDERS_AS_WRITTEN,
    "json_roundtrip": ORDERS_AS_WRITTEN,
    "parquet_roundtrip": ORDERS_AS_WRITTEN,
    "orc_roundtrip": ORDERS_AS_WRITTEN,
    **{f"{fmt}_roundtrip_events": "SELECT * FROM events" for fmt in ("csv", "json", "parquet", "orc")},
    "file_size_report": STORED_TABLES,
    "timed_report": TIMED_ANALYSES,
    "storage_format_report": FORMAT_ROWS,
    "line_revenue": f"SELECT order_id, customer_id, product_id, quantity, price, CAST(revenue AS DOUBLE) AS revenue FROM ({LINE})",
    "top_customers_by_revenue": TOP_CUSTOMERS,
    "customer_revenue_top10": f"SELECT customer_id, CAST(sum(revenue) AS DOUBLE) AS revenue FROM ({LINE}) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    "sales_by_category": SALES_BY_CATEGORY,
    "monthly_trends": MONTHLY_TRENDS,
    "sales_overview": SALES_OVERVIEW,
    "monthly_sales_trends": MONTHLY_SALES,
    "hourly_sales_pattern": HOURLY_EVENTS,
    "top_products": TOP_PRODUCTS,
    "category_performance": CATEGORY_PERFORMANCE,
    "rfm_metrics": RFM_METRICS,
    "rfm_scores": RFM_SCORES,
    "customer_segments": SEGMENTS,
    "customer_segments_scaled": SEGMENTS_SCALED,
    "format_bytes": FORMAT_BYTES,
    "energy_estimate": "SELECT event_id, value AS cpu_time_s, value * 65e0 / 3600e0 AS energy_consumption_wh FROM events",
    "share_of_total": SHARE_OF_TOTAL,
    "ratio_to_baseline": RATIO_TO_BASELINE,
    "best_by_metric": BEST_BY_METRIC,
    "result_reconciliation": RESULT_RECONCILIATION,
    "gen_customers": GEN_CUSTOMERS,
    "gen_products": GEN_PRODUCTS,
    "gen_pareto_counts": PARETO,
    "gen_orders": GEN_ORDERS,
    "gen_shuffle": GEN_SHUFFLE,
    "gen_customers_profile": GEN_CUSTOMERS_PROFILE,
    "gen_products_catalog": GEN_PRODUCTS_CATALOG,
    "gen_order_items": GEN_ORDER_ITEMS,
    "gen_orders_header": GEN_ORDERS_HEADER,
    "gen_benchmark_rows": GEN_BENCHMARK_ROWS,
    "gen_summary": GEN_SUMMARY,
    "sales_report": SALES_REPORT,
    "full_report": FULL_REPORT,
    "frequent_products": FREQUENT_PRODUCTS,
    "salted_top_customers": TOP_CUSTOMERS,
    "salted_monthly_trends": MONTHLY_TRENDS,
    "bucketed_top_customers": TOP_CUSTOMERS,
    "bucketed_monthly_trends": MONTHLY_TRENDS,
    "exact_customer_revenue": EXACT_CUSTOMER_REVENUE,
    "exact_top_customers": TOP_CUSTOMERS,
    "exact_sales_by_category": SALES_BY_CATEGORY,
    "exact_monthly_trends": MONTHLY_TRENDS,
    "customers_by_month": CUSTOMERS_BY_MONTH,
    "order_differences": ORDER_DIFFERENCES,
    "order_difference_summary": ORDER_DIFFERENCE_SUMMARY,
    "shuffled_orders": SHUFFLED_ORDERS,
    "csv_rejects": CSV_REJECTS,
    "replaced_table": REPLACED_TABLE,
}
