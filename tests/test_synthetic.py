from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillframe import constants as fixed
from tillframe.operators.checks import reconcile
from tillframe.plans import reports
from tillframe.sources import files, synthetic, tables

AS_OF = "2024-01-01"


def ids(spark, n, name, partitions=3):
    return spark.range(1, n + 1, 1, partitions).toDF(name)


def same(left, right):
    return reconcile(left, right).first()["same_rows"]


@pytest.mark.parametrize("build", [
    lambda s, p: synthetic.shop_customers(ids(s, 500, "customer_id", p), 1, AS_OF),
    lambda s, p: synthetic.shop_products(ids(s, 500, "product_id", p), 1),
    lambda s, p: synthetic.shop_orders(ids(s, 200, "customer_id", p), 50, 2000, 1, AS_OF),
    lambda s, p: synthetic.store_customers(ids(s, 500, "customer_id", p), 1, AS_OF),
    lambda s, p: synthetic.store_products(ids(s, 500, "product_id", p), 1, AS_OF),
    lambda s, p: synthetic.store_orders(ids(s, 500, "order_id", p), 50, 1, AS_OF),
    lambda s, p: synthetic.store_order_items(ids(s, 500, "order_id", p), 50, 1),
    lambda s, p: synthetic.benchmark_rows(ids(s, 500, "id", p), 1),
])
def test_rows_do_not_depend_on_partitioning(spark, build):
    assert same(build(spark, 1), build(spark, 16))


@pytest.mark.parametrize("customers, orders", [(10, 100), (300, 3000), (2000, 20000)])
def test_pareto_counts_add_up(spark, customers, orders):
    counts = synthetic.pareto_counts(ids(spark, customers, "customer_id"), "customer_id", orders)
    found = sorted((r["order_count"] for r in counts.collect()), reverse=True)
    assert len(found) == customers and sum(found) == orders and found[-1] >= 0
    if customers >= 2000:
        assert 0.6 < sum(found[: customers // 5]) / orders < 0.95


def test_a_single_key_takes_everything(spark):
    one = synthetic.pareto_counts(ids(spark, 1, "k"), "k", 7)
    assert rows(one) == [(1, 7)]


def test_running_offsets_equal_a_plain_running_sum(spark):
    keys = [3, 65535, 65536, 65537, 10**6, 2**32, 2**32 + 1, 2**40, 5 * 2**45, 2**62]
    values = list(range(1, len(keys) + 1))
    df = spark.createDataFrame(list(zip(keys, values)), "k bigint, v bigint").repartition(4)
    got = {r["k"]: r["offset"] for r in synthetic.running_offsets(df, "k", "v").collect()}
    assert got == {key: sum(values[:i]) for i, key in enumerate(keys)}


def test_orders_follow_the_counts(spark):
    customers = ids(spark, 300, "customer_id")
    orders = synthetic.shop_orders(customers, 40, 5000, 1, AS_OF)
    found = orders.collect()
    assert sorted(r["order_id"] for r in found) == list(range(1, 5001))
    counts = synthetic.pareto_counts(customers, "customer_id", 5000, seed=1).filter("order_count > 0")
    assert Counter(r["customer_id"] for r in found) == {r[0]: r[1] for r in counts.collect()}
    assert {r["product_id"] for r in found} == set(range(1, 41))
    assert {r["quantity"] for r in found} == set(range(1, 11))
    dates = [str(r["order_date"]) for r in found]
    assert "2023-01-01" <= min(dates) and max(dates) <= "2024-01-01 00:00:00"


def test_a_customer_with_most_orders_is_written_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(synthetic, "ORDERS_PER_BLOCK", 100)
    orders = synthetic.shop_orders(ids(spark, 3, "customer_id"), 5, 20000, 1, AS_OF)
    per_task = orders.groupBy("customer_id", F.spark_partition_id().alias("task")).count().collect()
    hottest = Counter()
    for row in per_task:
        hottest[row["customer_id"]] += row["count"]
    customer, held = hottest.most_common(1)[0]
    shares = [r["count"] for r in per_task if r["customer_id"] == customer]
    assert held > 20000 / 3 and len(shares) == 8 and max(shares) < held / 3


def test_shop_values(spark):
    people = synthetic.shop_customers(ids(spark, 5000, "customer_id"), 1, AS_OF)
    stats = people.agg(F.min("age"), F.max("age"), F.avg("age"), F.min("registration_date"), F.max("registration_date")).first()
    assert (stats[0], stats[1]) == (18, 80) or stats[0] == 18 and stats[1] <= 80
    assert 34 < stats[2] < 36.5
    assert "2019-01-01" <= str(stats[3]) and str(stats[4]) <= AS_OF
    goods = synthetic.shop_products(ids(spark, 5000, "product_id"), 1).collect()
    assert {r["category"] for r in goods} == set(fixed.SHOP_PRICE_RANGES)
    for r in goods:
        low, high = fixed.SHOP_PRICE_RANGES[r["category"]]
        assert low <= r["price"] <= high and r["price"] == round(r["price"], 2)
        assert 10 <= r["stock"] <= 1000 and 1 <= r["rating"] <= 5
        assert r["name"].startswith(r["category"] + " ")


def test_store_values(spark):
    store = synthetic.store_tables(spark, 400, 300, 600, seed=3, as_of=AS_OF)
    for r in store["customers"].collect():
        low, high = fixed.AGE_GROUPS[r["age_group"]]
        assert low <= r["age"] <= high
    active = store["customers"].agg(F.avg(F.col("is_active").cast("int"))).first()[0]
    assert 0.65 < active < 0.85
    for r in store["products"].collect():
        low, high = fixed.STORE_PRICE_RANGES[r["category"]]
        assert low <= r["price"] <= high and 0.3 * low - 0.01 <= r["cost"] <= 0.6 * high + 0.01
        assert r["sku"] == f"SKU-{r['product_id']:06d}"
    sums = store["order_items"].groupBy("order_id").agg(
        F.sum(F.round(F.col("total_price") * 100).cast("bigint")).alias("cents"), F.count("*").alias("items"))
    for r in store["orders"].join(sums, "order_id", "full").collect():
        assert round(r["order_total"] * 100) == r["cents"] and 1 <= r["items"] <= 5
        assert r["tax_amount"] == pytest.approx(r["order_total"] * 0.08, abs=0.0051)
        assert 0 <= r["discount_amount"] <= r["order_total"] * 0.1 + 0.01
        parts = r["order_total"] + r["shipping_cost"] + r["tax_amount"] - r["discount_amount"]
        assert r["final_amount"] == pytest.approx(parts, abs=1e-6)
    items = store["order_items"]
    assert items.select("order_item_id").distinct().count() == items.count()


def test_another_seed_gives_other_rows_and_zero_is_a_seed(spark):
    first, second = (synthetic.shop_products(ids(spark, 50, "product_id"), seed) for seed in (0, 1))
    assert not same(first, second)
    assert same(first, synthetic.shop_products(ids(spark, 50, "product_id"), 0))


def test_shuffle_keeps_rows_and_changes_order(spark):
    df = spark.range(1000).toDF("k")
    first = [r["k"] for r in synthetic.shuffle_rows(df, "k", 1).collect()]
    assert sorted(first) == list(range(1000)) and first != sorted(first)
    assert first == [r["k"] for r in synthetic.shuffle_rows(df.repartition(9), "k", 1).collect()]
    assert first != [r["k"] for r in synthetic.shuffle_rows(df, "k", 2).collect()]


def test_generated_tables_have_the_declared_schemas(spark):
    shop = synthetic.shop_tables(spark, 20, 10, 50, as_of=AS_OF)
    store = synthetic.store_tables(spark, 20, 10, 50, as_of=AS_OF)
    for made, declared in ((shop, tables.SHOP_SCHEMAS), (store, tables.STORE_SCHEMAS)):
        for name, df in made.items():
            expected = spark.createDataFrame([], declared[name]).dtypes
            assert df.dtypes == expected, name


def test_benchmark_rows(spark):
    made = rows(synthetic.benchmark_rows(ids(spark, 30, "id"), 1).orderBy("id"))
    assert made[0][:3] == (1, "Product_1", "user1@example.com")
    assert str(made[0][4]) == "2020-01-01 00:00:00" and str(made[29][4]) == "2020-01-02 05:00:00"
    assert all(1 <= r[3] <= 1000 and r[5] in fixed.BENCHMARK_CATEGORIES for r in made)


def test_summary(spark):
    shop = synthetic.shop_tables(spark, 20, 200, 50, as_of=AS_OF)
    assert rows(synthetic.data_summary(shop)) == [
        ("customers", 20, None, None), ("products", 200, 5, "Books, Clothing, Electronics, Home, Sports"), ("orders", 50, None, None)]


def test_reports_over_generated_files(spark, tmp_path):
    """The way a user works: generate, save, load, analyse, save."""
    shop = synthetic.shop_tables(spark, 100, 20, 1000, as_of=AS_OF)
    saved = files.save_tables(shop, str(tmp_path), "raw")
    results = reports.sales_report_from(spark, saved["orders"], saved["products"], n=5)
    assert list(results) == ["top_customers", "category_sales", "monthly_trends"]
    sharing = reports.sales_report_from(spark, saved["orders"], saved["products"], n=5, cache=True)
    assert all(rows(sharing[name]) == rows(results[name]) for name in results)
    assert "InMemoryTableScan" in sharing["monthly_trends"]._jdf.queryExecution().toString()
    spark.catalog.clearCache()
    assert results["top_customers"].count() == 5
    by_category = results["category_sales"].agg(F.sum("total_revenue")).first()[0]
    by_month = results["monthly_trends"].agg(F.sum("monthly_revenue")).first()[0]
    assert by_category == pytest.approx(by_month, abs=0.05)

    store = synthetic.store_tables(spark, 50, 20, 200, as_of=AS_OF)
    files.save_tables(store, str(tmp_path / "store"), "raw", "csv")
    loaded = reports.load_store(spark, str(tmp_path / "store"))
    report = reports.full_report(loaded, as_of=AS_OF)
    from_memory = reports.full_report(store, as_of=AS_OF)
    assert list(report) == list(from_memory) and len(report) == 6
    for name in ("sales_overview", "top_products", "category_performance", "hourly_sales_pattern"):
        assert list(map(str, rows(report[name]))) == list(map(str, rows(from_memory[name]))), name
    typed = reports.load_store(spark, str(tmp_path / "store"), tables.STORE_SCHEMAS)
    for name, df in store.items():
        assert typed[name].dtypes == df.dtypes and same(typed[name], df), name
    written = files.save_tables(report, str(tmp_path), "processed", "csv")
    assert files.load_csv(spark, written["sales_overview"]).count() == 1
    assert reports.load_store(spark, str(tmp_path))["orders"] is None
    with pytest.raises(ValueError, match="not loaded: order_items"):
        reports.full_report({**store, "order_items": None})


def test_benchmark_hours_do_not_repeat(spark):
    ids = spark.createDataFrame([(1,), (2_000_001,), (2_000_002,), (100_000_000,)], "id bigint")
    hours = [r[0] for r in rows(synthetic.benchmark_rows(ids).selectExpr(
        "timestampdiff(HOUR, timestamp_ntz'2020-01-01', date)").orderBy(F.col("timestampdiff(HOUR, TIMESTAMP_NTZ '2020-01-01 00:00:00', date)")))]
    assert hours == [0, 2_000_000, 2_000_001, 99_999_999]


def test_spread_deals_to_the_named_tasks(spark):
    assert synthetic.spread(spark.range(100), 3).select(F.spark_partition_id().alias("p")).distinct().count() == 3
