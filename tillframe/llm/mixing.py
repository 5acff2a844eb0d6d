"""Mixing sources to target weights by iterative proportional fitting (raking).

Tokens are summed per cell of source, language and topic, before any shuffle. Values that
have no target fall into one cell value `*`, which keeps its share, so the number of cells
is bounded by the targets that the caller names and the raking is a few sums over a small
array. It scales the cells to each marginal in turn, which gives the weights (raked over original tokens).

Sampling probabilities are raked too, under the bound of 1. A value that has fewer tokens than its share of the
budget gives all it has, and the others of its axis share the rest by their targets. Then, starting from the weights, each value's
cells are scaled in turn by the factor with which their expected tokens, no probability over 1,
meet that target. So the sample has the marginals wherever the cells allow it; `margins` says how close. A document is kept if a hash of its id falls below its probability.

Defined cases: null values count as values without a target. A null text has no tokens and
the weight of its cell, or weight and probability 0 where the cell has no tokens. A null
id is drawn by its text. Rows that repeat an id share one draw. Targets without
tokens are left out and the others share them. Result columns replace input columns of the
same name. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tillframe.llm.common import own_names, without_columns

OTHER = "*"
ROUNDS = 40
SOURCES = {f"src{i}": 1.0 for i in range(20)}
LANGUAGES = {"en": 0.55, "de": 0.15, "es": 0.15, "fr": 0.15}
TOPICS = {"prose": 0.85, "table": 0.05, "marked": 0.05, "shouted": 0.05}
BUDGET = 0.6
RESULTS = ["topic", "n_tokens", "weight", "probability", "kept"]


def text_kind(text: str = "text") -> Column:
    """A stand-in for a topic, where the table has none: what the text looks like."""
    column = F.coalesce(F.col(text), F.lit(""))
    return (F.when(F.contains(column, F.lit(" | ")), "table")
            .when(column.contains("###") | column.contains("$$$") | column.contains("%%%"), "marked")
            .when(F.contains(column, F.lit("!!")), "shouted").otherwise("prose"))


def token_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def rake(base: np.ndarray, targets: list[np.ndarray], rounds: int = ROUNDS) -> np.ndarray:
    """`base` scaled so that its sums along each axis come to the targets."""
    fitted = base.astype(float)
    for _ in range(rounds):
        for axis, target in enumerate(targets):
            others = tuple(i for i in range(base.ndim) if i != axis)
            sums = fitted.sum(axis=others)
            scale = np.divide(target, sums, out=np.zeros_like(sums), where=sums > 0)
            fitted = fitted * scale.reshape([-1 if i == axis else 1 for i in range(base.ndim)])
    return fitted


def axis_target(sums: np.ndarray, wanted: list[float | None]) -> np.ndarray:
    """Tokens wanted of each value; None keeps its own, the others share the rest by their weights."""
    free = np.array([weight is None for weight in wanted])
    weights = np.array([0.0 if weight is None else weight for weight in wanted]) * (sums > 0)
    rest = sums[~free].sum()
    return np.where(free, sums, rest * weights / weights.sum() if weights.sum() else 0.0)


def bounded_factor(base: np.ndarray, weight: np.ndarray, wanted: float) -> float:
    """The factor f with which sum(base * min(1, f * weight)) is `wanted`, or one that takes all there is."""
    some = np.flatnonzero((weight > 0) & (base > 0))
    if not len(some):
        return 1.0
    order = some[np.argsort(-weight[some], kind="stable")]
    tokens, share = base[order], weight[order]
    factors = (wanted - (np.cumsum(tokens) - tokens)) / (tokens * share)[::-1].cumsum()[::-1]
    fits = np.flatnonzero(factors * share <= 1)
    return max(0.0, float(factors[fits[0]])) if len(fits) else 1 / float(share[-1])


def feasible(sums: np.ndarray, target: np.ndarray, budget: float) -> np.ndarray:
    """Expected tokens of each value: its part of the budget, at most what it has, the rest shared by the others."""
    weight = np.divide(target, sums, out=np.zeros_like(sums), where=sums > 0)
    return sums * np.minimum(1.0, bounded_factor(sums, weight, budget) * weight)


def rake_bounded(base: np.ndarray, weight: np.ndarray, targets: list[np.ndarray], rounds: int = ROUNDS) -> np.ndarray:
    """Probabilities, at most 1, whose expected tokens along each axis come to the targets."""
    scaled = weight.copy()
    for _ in range(rounds):
        for axis, target in enumerate(targets):
            cells, tokens = np.moveaxis(scaled, axis, 0), np.moveaxis(base, axis, 0)
            for i, wanted in enumerate(target):
                cells[i] *= bounded_factor(tokens[i].ravel(), cells[i].ravel(), wanted)
    return np.minimum(1.0, scaled)


def _cells(docs: DataFrame, axes: list[tuple[str, Mapping[str, float]]]) -> list[Column]:
    return [F.when(F.col(name).isin(list(wanted)), F.col(name)).otherwise(F.lit(OTHER)) for name, wanted in axes]


@own_names
def mix(docs: DataFrame, *, sources: Mapping[str, float] = SOURCES, languages: Mapping[str, float] = LANGUAGES,
        topics: Mapping[str, float] = TOPICS, budget: float = BUDGET, key: str = "doc_id", source: str = "source",
        lang: str = "lang", text: str = "text", topic: Column | None = None, rounds: int = ROUNDS) -> DataFrame:
    """`docs` with topic, n_tokens, weight, probability and kept; `budget` is the share of all tokens to keep."""
    kept = without_columns(docs, *RESULTS)
    spark = docs.sparkSession
    named = (text_kind(text) if topic is None else topic).alias("__topic")
    rows = docs.select(*kept, named, token_count(text).alias("__tokens"))
    axes = [(source, sources), (lang, languages), ("__topic", topics)]
    names = ["__s", "__l", "__t"]
    cells = [column.alias(name) for column, name in zip(_cells(docs, axes), names)]
    # at most one row for each combination of the named values
    counted = rows.select(*cells, "__tokens").groupBy(*names).agg(F.sum("__tokens")).collect()
    values = [[*wanted, OTHER] for _, wanted in axes]
    base = np.zeros([len(x) for x in values])
    for s, l, t, tokens in counted:
        base[values[0].index(s), values[1].index(l), values[2].index(t)] = tokens
    targets = [axis_target(base.sum(axis=tuple(j for j in range(3) if j != i)), [*wanted.values(), None])
               for i, (_, wanted) in enumerate(axes)]
    fitted = rake(base, targets, rounds)
    weight = np.divide(fitted, base, out=np.zeros_like(base), where=base > 0)
    wanted = [feasible(base.sum(axis=tuple(j for j in range(3) if j != i)), target, budget * base.sum()) for i, target in enumerate(targets)]
    chance = rake_bounded(base, weight, wanted, rounds)
    plan = spark.createDataFrame(
        [(values[0][i], values[1][j], values[2][k], float(weight[i, j, k]), float(chance[i, j, k]))
         for i, j, k in np.ndindex(base.shape)], "__s string, __l string, __t string, weight double, probability double")
    draw = F.conv(F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.col(text), F.lit("")).cast("binary")), 1, 12), 16, 10)
    marked = rows.select("*", *cells).withColumn("__draw", draw.cast("double") / F.lit(float(16**12)))
    joined = marked.join(F.broadcast(plan), names)
    return joined.select(*kept, F.col("__topic").alias("topic"), F.col("__tokens").alias("n_tokens"), "weight", "probability",
                         (F.col("__draw") < F.col("probability")).alias("kept"))


def mixture_report(docs: DataFrame) -> DataFrame:
    return mix(docs.select("doc_id", "source", "lang", "text")).select(
        "doc_id", "source", "lang", "topic", "n_tokens", F.round("weight", 6).alias("weight"),
        F.round("probability", 6).alias("probability"), "kept")


def margins(mixed: DataFrame, *, sources: Mapping[str, float] = SOURCES, languages: Mapping[str, float] = LANGUAGES,
            topics: Mapping[str, float] = TOPICS, source: str = "source", lang: str = "lang") -> DataFrame:
    """(axis, value, tokens, expected, sampled) of a result of `mix`: tokens there are, expected in the sample, and in it."""
    rows = mixed.select(*[column.alias(axis) for axis, column in zip(
        ("source", "lang", "topic"), _cells(mixed, [(source, sources), (lang, languages), ("topic", topics)]))], "n_tokens", "probability", "kept")
    cells = rows.groupBy("source", "lang", "topic").agg(
        F.sum("n_tokens").alias("tokens"), F.sum(F.col("n_tokens") * F.col("probability")).alias("expected"),
        F.sum(F.when(F.col("kept"), F.col("n_tokens")).otherwise(0)).alias("sampled"))
    each = cells.select(F.explode(F.array(*[F.struct(F.lit(axis).alias("axis"), F.col(axis).alias("value")) for axis in ("source", "lang", "topic")])).alias("m"),
                        "tokens", "expected", "sampled")
    return each.groupBy("m.axis", "m.value").agg(*[F.sum(name).alias(name) for name in ("tokens", "expected", "sampled")])


@own_names
def sampled(docs: DataFrame) -> DataFrame:
    """The kept rows of `docs`, columns as they are."""
    rows = docs.withColumn("__row", F.struct(*docs.columns)).select("__row", "doc_id", "source", "lang", "text")
    return mix(rows).filter("kept").select("__row.*")


def mixture_sql(budget: float = BUDGET, rounds: int = ROUNDS) -> str:
    """DuckDB SQL for `mixture_report`."""
    axes = {"s": SOURCES, "l": LANGUAGES, "t": TOPICS}
    listed = {axis: ", ".join(f"('{name}', {weight!r}::DOUBLE)" for name, weight in wanted.items()) for axis, wanted in axes.items()}
    names = {axis: ", ".join(f"'{name}'" for name in wanted) for axis, wanted in axes.items()}
    parts = [f"""doc AS MATERIALIZED (SELECT *, CASE WHEN source IN ({names['s']}) THEN source ELSE '*' END AS s,
        CASE WHEN lang IN ({names['l']}) THEN lang ELSE '*' END AS l, CASE WHEN topic IN ({names['t']}) THEN topic ELSE '*' END AS t
      FROM (SELECT doc_id, source, lang, CASE WHEN contains(coalesce(text, ''), ' | ') THEN 'table'
          WHEN contains(coalesce(text, ''), '###') OR contains(coalesce(text, ''), '$$$') OR contains(coalesce(text, ''), '%%%') THEN 'marked'
          WHEN contains(coalesce(text, ''), '!!') THEN 'shouted' ELSE 'prose' END AS topic,
        coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS n_tokens,
        ('0x' || substr(md5(coalesce(doc_id::VARCHAR, text, '')), 1, 12))::BIGINT / {float(16**12)!r} AS draw FROM documents))""",
             "base AS MATERIALIZED (SELECT s, l, t, sum(n_tokens)::DOUBLE AS tokens FROM doc GROUP BY ALL)"]
    for axis in axes:
        parts.append(f"""want_{axis} AS MATERIALIZED (SELECT {axis}, CASE WHEN {axis} = '*' THEN sums ELSE
            sum(sums) FILTER ({axis} <> '*') OVER () * share / sum(share) OVER () END AS want
          FROM (SELECT m.{axis}, sums, CASE WHEN sums > 0 THEN coalesce(w, 0) ELSE 0 END AS share
            FROM (SELECT {axis}, sum(tokens) AS sums FROM base GROUP BY ALL) m LEFT JOIN (VALUES {listed[axis]}) v(name, w) ON name = {axis}))""")
    parts.append("fit_0 AS MATERIALIZED (SELECT s, l, t, tokens, tokens AS fit FROM base)")
    step = 0
    for _ in range(rounds):
        for axis in axes:
            step += 1
            parts.append(f"""fit_{step} AS MATERIALIZED (SELECT s, l, t, tokens, CASE WHEN sums > 0 THEN fit * (want / sums) ELSE 0 END AS fit
              FROM (SELECT *, sum(fit) OVER (PARTITION BY {axis}) AS sums FROM fit_{step - 1}) JOIN want_{axis} USING ({axis}))""")
    parts.append(f"""weights AS MATERIALIZED (SELECT s, l, t, tokens, CASE WHEN tokens > 0 THEN fit / tokens ELSE 0 END AS weight FROM fit_{step})""")
    parts.append("cap_0 AS MATERIALIZED (SELECT s, l, t, tokens, weight AS u FROM weights)")
    for axis in axes:
        # what an axis's values can give: the same bounded scaling, over the values themselves
        parts.append(f"""due_{axis} AS MATERIALIZED (SELECT {axis}, sums * least(1.0, f * u) AS due FROM ({_scaling(
            f"(SELECT {axis}, sums AS tokens, want, want / nullif(sums, 0) AS u, sums FROM want_{axis} JOIN (SELECT {axis}, sum(tokens) AS sums FROM base GROUP BY ALL) USING ({axis}))",
            "", axis, f"{budget!r} * sum(sums) OVER ()")}))""")
    step = 0
    for _ in range(rounds):
        for axis in axes:
            step += 1
            parts.append(f"""cap_{step} AS MATERIALIZED (SELECT s, l, t, tokens, u * f AS u FROM ({_scaling(
                f"(SELECT * FROM cap_{step - 1} JOIN due_{axis} USING ({axis}))", f"PARTITION BY {axis}", "s, l, t", "due")}))""")
    return "WITH " + ",\n".join(parts) + f"""
    SELECT doc_id, source, lang, topic, n_tokens, round(weight, 6) AS weight, round(p, 6) AS probability, draw < p AS kept
    FROM (SELECT s, l, t, weight, least(1.0, u) AS p FROM weights JOIN cap_{step} USING (s, l, t)) JOIN doc USING (s, l, t)"""


def _scaling(cells: str, group: str, order: str, wanted: str) -> str:
    """SQL for the rows of `cells` (tokens, u) with f of their group; cells without tokens or weight get 1."""
    live = "CASE WHEN tokens > 0 AND u > 0 THEN 0 ELSE 1 END"
    window = f"OVER (PARTITION BY {group.removeprefix('PARTITION BY ') + ', ' if group else ''}live ORDER BY u DESC, {order} ROWS BETWEEN"
    over = f"OVER (PARTITION BY {group.removeprefix('PARTITION BY ') + ', ' if group else ''}live)"
    return f"""SELECT * REPLACE (coalesce(u, 0) AS u), CASE WHEN live = 1 THEN 1.0 ELSE greatest(0.0, coalesce(
            arg_min(factor, place) FILTER (WHERE factor * u <= 1) {over}, 1 / min(u) {over})) END AS f
        FROM (SELECT *, (goal - before) / nullif(rest, 0) AS factor FROM (
          SELECT *, row_number() {window} UNBOUNDED PRECEDING AND CURRENT ROW) AS place,
            coalesce(sum(tokens) {window} UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
            sum(tokens * u) {window} CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
          FROM (SELECT *, {live} AS live, {wanted} AS goal FROM {cells})))"""
