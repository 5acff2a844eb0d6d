"""Sums of any doubles equal the true sum, rounded once."""

import math
import random
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL, rows
from tillframe.functions import exact
from tillframe.operators import doubles, revenue, trends
from tillframe.sources import tables


def true_sum(values):
    total = sum(map(Fraction, values), Fraction(0))
    try:
        return float(total)
    except OverflowError:
        return float("inf") if total > 0 else float("-inf")


@pytest.fixture(scope="module")
def values():
    draw = random.Random(1)
    found = defaultdict(list)
    for group in range(60):
        for _ in range(draw.randint(1, 200)):
            found[group].append(
                draw.choice([-1, 1]) * draw.random() * 10**draw.uniform(-15, 15) if group < 30
                else math.ldexp(draw.random() - 0.5, draw.randint(-1070, 1000)) if group < 50
                else draw.choice([0.1, 1 / 3, -0.1, 0.0, 5e-324, 1e308, -1e308]))
    found[100], found[101], found[102] = [1e16, 1.0, -1e16], [0.0], [2.0**53, 1.0, 2.0**-60]
    found[103], found[104] = [2.0**53, 1.0], [5e-324] * 3
    return found


def test_thirty_orders_of_magnitude_in_any_order(spark, values):
    flat = [(group, x) for group, xs in values.items() for x in xs]
    expected = {group: true_sum(xs) for group, xs in values.items()}
    for group in range(30):
        assert expected[group] == math.fsum(values[group])
    for seed, parts in ((1, 1), (2, 7)):
        random.Random(seed).shuffle(flat)
        df = spark.createDataFrame(flat, "g int, x double").repartition(parts)
        assert dict(rows(exact.exact_sums(df, ["g"], x=F.col("x")))) == expected


def test_special_values_and_nulls(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(1, nan), (1, 1.0), (2, inf), (2, 5.0), (3, None), (4, 1.0), (4, None), (5, inf), (5, -inf), (None, 2.0), (None, 0.5)], "g int, x double")
    got = dict(rows(exact.exact_sums(df, ["g"], x=F.col("x"))))
    assert math.isnan(got[1]) and got[2] == inf and got[3] is None and got[4] == 1.0 and math.isnan(got[5])
    assert rows(exact.exact_sums(df.filter("g is null"), [], x=F.col("x"), y=F.col("x") * 2)) == [(2.5, 5.0)]


def test_merged_bands_equal_direct_ones(spark, values):
    df = spark.createDataFrame([(group, i, x) for group, xs in values.items() for i, x in enumerate(xs)], "g int, i int, x double")
    fine = exact.banded(df.withColumn("h", F.col("i") % 5), ["g", "h"], F.col("x"))
    merged = exact.merged(fine, ["g"]).groupBy("g").agg(exact.exact_total().alias("x"))
    assert dict(rows(merged)) == {group: true_sum(xs) for group, xs in values.items()}


@pytest.fixture
def odd_prices(spark):
    """Prices and quantities with many places, over many orders of magnitude."""
    draw = random.Random(7)
    products = [(i, "AB"[i % 2], draw.random() * 10**draw.uniform(-9, 9)) for i in range(50)]
    orders = [(i // 3, i % 11, i % 50, draw.random() * 10**draw.uniform(-3, 3)) for i in range(3000)]
    return (spark.createDataFrame(orders, "order_id bigint, customer_id bigint, product_id bigint, quantity double").withColumn(
        "order_date", F.expr("date_add(date'2024-01-01', cast(order_id % 200 as int))")),
        spark.createDataFrame(products, "product_id bigint, category string, price double"), orders, {p: (c, x) for p, c, x in products})


def test_analyses_of_any_prices(spark, odd_prices):
    orders, products, lines, price = odd_prices
    per_customer, per_category = defaultdict(list), defaultdict(list)
    for _, customer, product, quantity in lines:
        per_customer[customer].append(quantity * price[product][1])
        per_category[price[product][0]].append((quantity * price[product][1], quantity))
    with pytest.raises(Exception, match="more than 4 decimal places"):
        revenue.customer_revenue(orders, products).collect()
    expected = {customer: math.fsum(xs) for customer, xs in per_customer.items()}
    assert dict(rows(doubles.customer_revenue(orders, products))) == expected
    headers = orders.select("order_id", "order_date").distinct().withColumn("customer_id", F.col("order_id") % 4)
    by_header = defaultdict(list)
    for order, _, product, quantity in lines:
        by_header[order % 4].append(quantity * price[product][1])
    assert dict(rows(doubles.customer_revenue(orders, products, headers))) == {c: math.fsum(xs) for c, xs in by_header.items()}
    top = rows(doubles.top_customers(orders, products, 3))
    best = sorted(expected.items(), key=lambda x: -x[1])[:3]
    assert [row[0] for row in top] == [c for c, _ in best] and [row[1] for row in top] == pytest.approx([x for _, x in best], rel=1e-12)
    assert [row[2] for row in top] == [len(per_customer[c]) for c, _ in best]
    found = {row[0]: row for row in rows(doubles.sales_by_category(orders, products))}
    for category, xs in per_category.items():
        assert found[category][1] == pytest.approx(math.fsum(x for x, _ in xs), rel=1e-12) and found[category][2] == math.fsum(q for _, q in xs)
    assert sum(row[2] for row in rows(doubles.monthly_trends(orders, products))) == pytest.approx(math.fsum(expected.values()), rel=1e-9)


def test_both_ways_agree_on_short_prices(spark):
    items, products, headers = tables.order_items(spark, SMALL), tables.products(spark, SMALL), tables.order_headers(spark, SMALL)
    assert rows(doubles.top_customers(items, products, headers=headers)) == rows(revenue.top_customers(items, products, headers=headers))
    assert rows(doubles.monthly_trends(items, products, headers)) == rows(trends.monthly_trends(items, products, headers))
