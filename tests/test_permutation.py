"""The keyed permutation: one-to-one for every size, without a sort of all rows, and far from the given order."""

import pytest
from pyspark.sql import functions as F

from tillframe.functions.permutation import MOST_ROWS, in_shuffled_order, rounds, with_place


def places(spark, n, seed=42):
    return [row.place for row in with_place(spark.range(n), "id", n, seed).orderBy("id").collect()]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 7, 10, 97, 1000, 1023, 4099])
def test_every_place_once(spark, n):
    assert sorted(places(spark, n)) == list(range(n))


def test_large_numbers_stay_apart_and_inside(spark):
    n = 10**15 + 37
    ends = spark.range(0, 20_000).select(F.explode(F.array(F.col("id"), F.lit(n - 1) - F.col("id"), F.col("id") * 49_999_999_999)).alias("id")).distinct()
    found = with_place(ends, "id", n).agg(F.min("place"), F.max("place"), F.countDistinct("place"), F.count("place")).first()
    assert 0 <= found[0] and found[1] < n and found[2] == found[3]


def test_seed_decides_and_order_is_gone(spark):
    n = 20_011
    one, two = places(spark, n, 1), places(spark, n, 2)
    assert sum(a == b for a, b in zip(one, two)) < 10 and sum(i == a for i, a in enumerate(one)) < 10
    mean = (n - 1) / 2
    for lag in (1, 2, 7, 141, 142):
        pairs = list(zip(one, one[lag:]))
        together = sum((a - mean) * (b - mean) for a, b in pairs) / len(pairs) / (n * n / 12)
        assert abs(together) < 0.04


def test_partitions_hold_runs_of_places_without_sampling(spark):
    shuffled = in_shuffled_order(spark.range(1001), "id", 1001, 4)
    parts = [[row.place for row in part] for part in shuffled.rdd.glom().collect()]
    assert [place for part in parts for place in part] == list(range(1001)) and [len(part) for part in parts] == [251, 251, 251, 248]
    plan = in_shuffled_order(spark.range(1001), "id", 1001, 4)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and plan.count("Exchange ") == 1
    assert plan.count("Sort ") == 1 and "], false" in plan.split("Sort ")[1].splitlines()[0]  # a sort within partitions


def test_too_many_rows():
    with pytest.raises(ValueError, match="more than"):
        list(rounds(MOST_ROWS + 1))
