"""Exact distinct counts by bitmaps, which merge over any coarser groups without going back to the rows.

Each group holds a bitmap of 32,768 keys for each bucket of keys that it meets. Bitmaps are
built in the tasks before the shuffle, so what moves is a bitmap per group and bucket, not a row per key, and the
counts of months and of their total come from the same pass. Keys are whole numbers, best dense ones.

Null keys do not count; a group that has no other keys counts 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillframe.operators.checks import require_columns


def key_bitmaps(df: DataFrame, key: str, *groups: str | Column) -> DataFrame:
    """(groups, bucket, bitmap): which keys each group has; fit to be stored and merged later."""
    require_columns(df, [key], "df")
    place = F.col(key).cast("bigint")
    return df.groupBy(*groups, F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bitmap"))


def merged_bitmaps(bitmaps: DataFrame, *groups: str) -> DataFrame:
    """The bitmaps of coarser groups, or of several stored tables united."""
    return bitmaps.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def distinct_counts(bitmaps: DataFrame, groups: list[str], result: str) -> DataFrame:
    """(groups, result): how many keys each group has. There must be one bitmap for each group and bucket."""
    counted = F.sum(F.when(F.col("bucket").isNotNull(), F.bitmap_count("bitmap")).otherwise(0))
    return bitmaps.groupBy(*groups).agg(F.coalesce(counted, F.lit(0)).alias(result))


def customers_by_month(orders: DataFrame) -> DataFrame:
    """(year, month, customers): distinct customers per month, and in total where year and month are null."""
    require_columns(orders, ["customer_id", "order_date"], "orders")
    months = key_bitmaps(orders, "customer_id", F.year("order_date").cast("bigint").alias("year"), F.month("order_date").cast("bigint").alias("month"))
    total = distinct_counts(merged_bitmaps(months), [], "customers")
    return distinct_counts(months.filter("year is not null"), ["year", "month"], "customers").unionByName(
        total.select(F.lit(None).cast("bigint").alias("year"), F.lit(None).cast("bigint").alias("month"), "customers"))
