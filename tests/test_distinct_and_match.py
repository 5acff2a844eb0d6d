"""Distinct counts from bitmaps, and results matched by key."""

from pyspark.sql import functions as F

from tests.conftest import SMALL, rows
from tillframe.operators import checks, distinct
from tillframe.sources import tables


def test_bitmaps_count_like_distinct(spark):
    df = spark.range(20_000).select((F.col("id") % 5).alias("g"), F.when(F.col("id") % 11 > 0, F.col("id") * F.col("id") % 70_003 - 20_000).alias("k"))
    bitmaps = distinct.key_bitmaps(df, "k", "g")
    assert sorted(rows(distinct.distinct_counts(bitmaps, ["g"], "n"))) == sorted(rows(df.groupBy("g").agg(F.countDistinct("k"))))
    assert rows(distinct.distinct_counts(distinct.merged_bitmaps(bitmaps), [], "n")) == rows(df.agg(F.countDistinct("k")))
    parts = [distinct.key_bitmaps(df.filter(F.col("g") % 2 == i), "k") for i in (0, 1)]
    assert rows(distinct.distinct_counts(distinct.merged_bitmaps(parts[0].union(parts[1])), [], "n")) == rows(df.agg(F.countDistinct("k")))


def test_bitmaps_of_nulls_and_nothing(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 7), (2, 7), (None, 3)], "g int, k bigint")
    assert sorted(rows(distinct.distinct_counts(distinct.key_bitmaps(df, "k", "g"), ["g"], "n")), key=str) == [(1, 0), (2, 1), (None, 1)]
    assert rows(distinct.distinct_counts(distinct.key_bitmaps(df.limit(0), "k"), [], "n")) == [(0,)]


def test_months_and_total_come_from_one_scan_without_distinct(spark):
    text = distinct.customers_by_month(tables.order_headers(spark, SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "customer_id" not in "".join(line for line in text.splitlines() if "Exchange hashpartitioning" in line)


def test_match_names_what_differs(spark):
    left = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0), (None, "n", 4.0), (5, None, None), (6, "x", 6.0), (6, "x", 6.0)], "id int, s string, v double")
    right = spark.createDataFrame([(1, "a", 1.05), (2, "B", 2.5), (None, "n", 9.0), (5, None, None), (6, "x", 6.0), (7, "new", 7.0)], "id int, s string, v double")
    matched = checks.match_by_key(left, right, ["id"], {"v": 0.1})
    assert sorted(rows(matched.select("id", "status", "columns")), key=str) == sorted([
        (2, "differs", "s,v"), (3, "only_left", None), (None, "differs", "v"), (6, "repeated", None), (7, "only_right", None)], key=str)
    assert sorted(rows(checks.match_summary(matched, ["v"])), key=str) == sorted([
        ("differs", "s,v", 1, 0.5), ("differs", "v", 1, 5.0), ("only_left", None, 1, None), ("only_right", None, 1, None), ("repeated", None, 1, 0.0)], key=str)
    assert rows(checks.match_by_key(left.limit(0), right.limit(0), ["id"])) == []
    assert rows(checks.match_by_key(left.select("id"), left.select("id"), ["id"])) == [(6, "repeated", None)]
