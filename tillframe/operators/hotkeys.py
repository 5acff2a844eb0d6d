"""Joins on keys of which some hold a large part of all rows.

A first pass over the key column alone keeps a frequent-items sketch per task; sketches are
merged in two steps, and what comes back is bounded by the share that makes a key hot. Only hot keys
are salted: each is dealt over as many parts as its rows need, in powers of two, and the
other side repeats the rows of that key once for each part. All other keys join as ever.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

#: Sketches that are merged apart before the last merge.
_GROUPS = 64
_MOST_TRACKED = 1_000_000
#: Keys that the driver may collect and a plan may list.
_MOST_NAMED = 1000


@dataclass(frozen=True)
class HotKeys:
    """Keys by the number of parts (a power of two) that each is dealt over."""

    key: str
    parts: dict[int, list]

    def __bool__(self) -> bool:
        return bool(self.parts)

    def parts_of(self, key: Column) -> Column:
        """1 for keys that are not hot."""
        chain = reduce(lambda acc, tier: acc.when(key.isin(tier[1]), tier[0]), sorted(self.parts.items()), F)
        return chain.otherwise(1) if self.parts else F.lit(1)


def frequent_keys(df: DataFrame, key: str, share: float) -> list[tuple[object, int]]:
    """(key, about how many rows) of the keys with more than `share` of all rows, most frequent first. Null keys are left out.

    The sketch tracks eight times as many items as there can be such keys, so counts are
    off by less than half of `share` of the rows. At most 1 / share keys reach the driver.
    """
    tracked = min(_MOST_TRACKED, 1 << max(10, int(8 / share) .bit_length()))
    keys = df.select(F.col(key).alias("key")).filter("key is not null")
    sketched = keys.groupBy((F.spark_partition_id() % _GROUPS).alias("__group")).agg(
        F.expr(f"approx_top_k_accumulate(key, {tracked})").alias("sketch"), F.count(F.lit(1)).alias("n"))
    # grouped, since the merge cannot cope with a task that has no sketch at all
    merged = sketched.groupBy(F.pmod("__group", F.lit(1))).agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"), F.sum("n").alias("n"))
    most = max(1, int(1 / share) + 1)
    found = merged.select(F.expr(f"approx_top_k_estimate(sketch, {min(most * 2, tracked)})").alias("items"), "n").first()
    if found is None or not found["n"]:
        return []
    return [(item["item"], item["count"]) for item in found["items"] if item["count"] > share * found["n"]]


def hot_keys(df: DataFrame, key: str, tasks: int | None = None) -> HotKeys:
    """The keys with more than half of what an even deal over `tasks` (default: the shuffle partitions) gives each task.

    There are at most 2 * tasks of them, and their parts sum up to 4 * tasks at most.
    """
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = 0.5 / tasks
    found, parts = frequent_keys(df, key, share), defaultdict(list)
    if not found:
        return HotKeys(key, {})
    rows = df.agg(F.count(key)).first()[0]
    for value, n in found:
        needed = max(1, -int(-n // (share * rows)))
        if needed > 1:
            parts[1 << (needed - 1).bit_length()].append(value)
    return HotKeys(key, dict(parts))


def salted_join(left: DataFrame, right: DataFrame, hot: HotKeys, how: str = "inner", spread: list[str] | None = None) -> DataFrame:
    """`left.join(right, hot.key, how)` for inner and left joins, with hot keys of the left side dealt over parts.

    A row's part follows from a hash of the columns `spread` (default: all of the left side), so a
    repeated task deals alike. `right` should hold few rows for each key.
    """
    if how not in ("inner", "left"):
        raise ValueError("only inner and left joins can be salted on the left side")
    if not hot:
        return left.join(right, hot.key, how)
    key = hot.key
    salt = F.pmod(F.xxhash64(*(spread or left.columns)), hot.parts_of(F.col(key)))
    dealt = left.withColumn("__part", F.when(F.col(key).isin([x for keys in hot.parts.values() for x in keys]), salt).otherwise(F.lit(0).cast("bigint")))
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), (hot.parts_of(F.col(key)) - 1).cast("bigint")))
    return dealt.join(right.withColumn("__part", copies), [key, "__part"], how).drop("__part")


def frequent_key_report(df: DataFrame, key: str, share: float) -> DataFrame:
    """(key, rows, share_pct) of the keys with at least `share` of all rows, counted exactly. Null keys are left out.

    The sketch names candidates down to a quarter of `share` below it; a second narrow pass counts those. Where there
    can be more than _MOST_NAMED candidates, a sketch would track more items than it rules out, and the driver and the plan
    would hold them all: then all keys are counted, of which each task sends one row a key, and none reaches the driver.
    """
    total = df.agg(F.count(F.lit(1))).scalar()
    if 2 / share > _MOST_NAMED:
        candidates = df.filter(F.col(key).isNotNull())
    else:
        candidates = df.filter(F.col(key).isin([value for value, _ in frequent_keys(df, key, share / 2)]))
    counted = candidates.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return counted.filter(F.col("rows") >= total * F.lit(float(share))).select(
        key, "rows", (F.col("rows") / total * 100).alias("share_pct"))
