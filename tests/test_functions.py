from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillframe import constants as fixed
from tillframe.functions import draws
from tillframe.functions.numbers import (
    cents, clamp, energy_wh, mean, percent_growth, percent_of, score_at_least, score_at_most,
    total, unit_total, units,
)
from tillframe.functions.text import readable_bytes


def python_size(size):
    """The readable size by repeated division, as plain Python formats it."""
    if size == 0:
        return "0 B"
    power = 0
    while size >= 1024 and power < 4:
        size /= 1024
        power += 1
    return f"{size:.2f} {fixed.BYTE_UNITS[power]}"


def test_readable_bytes(spark):
    sizes = [0, 1, 500, 1023, 1024, 1029, 1152, 1280, 1536, 1048575, 1048576, 5 * 1024**4 // 3,
             5 * 1024**5, 1024**5 + 123456789, 2**53 - 1]
    sizes += [1024**k + step * 1024**k // 800 for k in (1, 2, 3, 4) for step in range(0, 800, 7)]
    df = spark.createDataFrame([(s,) for s in sizes], "size bigint")
    got = rows(df.select("size", readable_bytes(F.col("size"))))
    assert got == [(s, python_size(s)) for s in sizes]
    assert rows(spark.range(1).select(readable_bytes(F.lit(None).cast("bigint")))) == [(None,)]


def test_sums_are_exact_for_any_order_and_sign(spark):
    values = [0.1, 0.2, -0.3, 1e10, -1e10, 922337203.07, -0.01, None]
    df = spark.createDataFrame([(v,) for v in values * 50], "v double")
    expected = sum(Decimal(str(v)) for v in values if v is not None) * 50
    assert rows(df.repartition(7).agg(unit_total(df, "v"))) == [(expected,)]


def test_sum_beyond_64_bits(spark):
    df = spark.range(1000).select(F.lit(2**62).alias("u"))
    assert rows(df.agg(total(F.col("u"), 4).alias("t"))) == [(Decimal(2**62 * 1000).scaleb(-4),)]


@pytest.mark.parametrize("kind, value", [("int", 3), ("decimal(10,2)", "3.25"), ("decimal(30,6)", "3.250001"), ("float", 3.1), ("double", 3.0001)])
def test_units_of_every_number_type(spark, kind, value):
    df = spark.range(1).select(F.lit(value).cast(kind).alias("v"))
    places = {"int": 0, "decimal(10,2)": 2, "decimal(30,6)": 6}.get(kind, 4)
    assert rows(df.select(units(df, "v"))) == [(int(Decimal(str(value)).scaleb(places)),)]


@pytest.mark.parametrize("value", [0.00001, 1.23456, float("inf"), 1e16])
def test_values_that_do_not_fit_raise(spark, value):
    df = spark.createDataFrame([(1.0,), (value,)], "price double")
    with pytest.raises(Exception, match="price has more than 4 decimal places|OVERFLOW|overflow"):
        df.select(units(df, "price")).collect()


def test_rounding_and_percentages(spark):
    df = spark.createDataFrame([(2.675, 1.005, 3.0, 0.0)], "a double, b double, c double, z double")
    got = df.select(
        cents(F.col("a")), cents(F.col("b")), cents(-F.col("a")), mean(F.col("c"), F.lit(2)),
        mean(F.col("c"), F.lit(0)), percent_of(F.col("c"), F.col("z")), percent_of(F.col("c"), F.lit(12)),
        energy_wh(F.lit(3600.0)), energy_wh(F.lit(7200.0), 10), clamp(F.lit(9), F.lit(1), F.lit(5)),
    )
    assert rows(got) == [(2.68, 1.01, -2.68, 1.5, None, None, 25.0, 65.0, 20.0, 5)]


def test_growth_needs_a_positive_previous_value(spark):
    df = spark.createDataFrame([(5.0, None), (5.0, 0.0), (5.0, -1.0), (5.0, 4.0)], "v double, p double")
    assert rows(df.select(percent_growth(F.col("v"), F.col("p")))) == [(None,), (None,), (None,), (25.0,)]


@pytest.mark.parametrize("score, bins, cases", [
    (score_at_most, fixed.RECENCY_DAYS_AT_MOST,
     {30: 5, 31: 4, 60: 4, 61: 3, 90: 3, 91: 2, 180: 2, 181: 1, -5: 5}),
    (score_at_least, fixed.FREQUENCY_AT_LEAST, {10: 5, 9: 4, 7: 4, 6: 3, 5: 3, 4: 2, 3: 2, 2: 1}),
    (score_at_least, fixed.MONETARY_AT_LEAST,
     {1000: 5, 999.99: 4, 500: 4, 499.99: 3, 200: 3, 199.99: 2, 100: 2, 99.99: 1}),
])
def test_score_limits(spark, score, bins, cases):
    df = spark.createDataFrame([(float(v),) for v in cases], "v double")
    assert [r[0] for r in rows(df.select(score(F.col("v"), bins, fixed.LOWEST_SCORE)))] == list(cases.values())


def test_segment_limits(spark):
    df = spark.range(3, 16).toDF("v")
    got = [r[0] for r in rows(df.select(score_at_least(F.col("v"), fixed.SEGMENT_AT_LEAST, fixed.LOWEST_SEGMENT)))]
    assert got == (["Lost"] * 2 + ["At Risk"] * 2 + ["Potential Loyalists"] * 3
                   + ["Loyal Customers"] * 3 + ["Champions"] * 3)


@pytest.mark.parametrize("lanes", [1, 2, 3, 4])
def test_lanes_are_even_and_unrelated(spark, lanes):
    source = spark.range(20000).select(draws.bits("id", 7, "x").alias("b"))
    parts = source.select(*[draws.fraction("b", lane, lanes).alias(f"u{lane}") for lane in range(lanes)])
    for lane in range(lanes):
        stats = parts.agg(F.min(f"u{lane}"), F.max(f"u{lane}"), F.avg(f"u{lane}"), F.var_pop(f"u{lane}")).first()
        assert 0 < stats[0] and stats[1] < 1
        assert abs(stats[2] - 0.5) < 0.01 and abs(stats[3] - 1 / 12) < 0.003
        if lane:
            assert abs(parts.agg(F.corr("u0", f"u{lane}")).first()[0]) < 0.03


def test_normal_draws(spark):
    stats = spark.range(20000).select(draws.normal("id", 1, "n").alias("z")).agg(
        F.avg("z"), F.stddev_pop("z"), F.skewness("z")).first()
    assert abs(stats[0]) < 0.03 and abs(stats[1] - 1) < 0.03 and abs(stats[2]) < 0.06
