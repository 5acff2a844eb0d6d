"""Quality rules: decision lists learned by sequential covering, applied as ordered Spark conditions.

Everything here is DataFrame functions. `text_statistics` measures whole texts. `learn`
covers the rows labelled bad, one rule at a time: a rule starts empty and takes the
threshold condition with the highest information gain on the growing rows until it is
pure, is then cut back to the prefix that does best on the pruning rows, and is accepted
if it is precise enough there. Rows that it covers are set aside for the next rule. Each step
is one aggregation over a table of binned statistics, of at most one row for each
combination of bins. Learning uses about `sample_rows` labelled rows, drawn by a hash of the key.

The list becomes one conditional expression (`DecisionList.first_rule`): the number of the
first rule that holds, or null.

Defined cases: a null text counts as empty, with no words, and fails the base rules. Labels
that are null, or have no document, are ignored; a document labelled twice counts twice.
Without labels there are no rules, and the base rules decide. Equal rows get equal
results. Result columns replace input columns of the same name.

Repeated windows are proposed by hashes of 64 bits less the bits of the window's place, and
then compared by their words, so counts are exact at any length.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame, functions as F

from tillframe.llm.common import crc32_of_id, own_names, stored, without_columns

SPACE = " \t\n\x0b\f\r"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_lines", "n_distinct_words", "n_capital_words", "n_bangs"]
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SAMPLE_ROWS = 50_000
QUANTILES = 24


@own_names
def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with the counts in COUNTS and MORE (all bigint) of each whole text."""
    kept = without_columns(docs, *COUNTS, *MORE)
    lines = F.filter(F.split("__text", "\n"), lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]")))
    df = docs.select(*kept, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    df = df.withColumn("__trim", F.btrim("__text", F.lit(SPACE))).withColumn("__lines", lines)
    df = df.select(
        *kept, F.when(F.col("__trim") == "", F.array().cast("array<string>")).otherwise(F.split("__trim", r"[\x20\x09-\x0D]+")).alias("__words"),
        F.size("__lines").cast("bigint").alias("n_lines"), (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint").alias("n_dup_lines"),
        F.regexp_count("__text", F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        F.regexp_count("__text", F.lit("[A-Z]{2,}")).cast("bigint").alias("n_capital_words"),
        F.regexp_count("__text", F.lit("!")).cast("bigint").alias("n_bangs"))
    df = df.withColumn("n_words", F.size("__words").cast("bigint")).withColumn("__bits", F.length(F.bin("n_words")))
    # each window as its hash with its place in the low bits: sorting brings equal windows together
    keyed = F.expr("""coalesce(if(n_words < 3, cast(array() as array<bigint>), transform(sequence(0, cast(n_words as int) - 3), i ->
        coalesce(shiftleft(xxhash64(__words[i], __words[i + 1], __words[i + 2]), __bits) | cast(i as bigint), 0L))), array(0L))""")
    df = df.select(
        *kept, *[name for name in COUNTS + MORE if name in df.columns], "__words", "__bits", F.length(F.array_join("__words", "")).cast("bigint").alias("word_chars"),
        F.size(F.array_distinct("__words")).cast("bigint").alias("n_distinct_words"), F.sort_array(keyed).alias("__keys"))
    proposed = F.expr("""sort_array(transform(filter(__keys, (x, k) ->
        coalesce(shiftright(x, __bits) = shiftright(get(__keys, k - 1), __bits), false)
        or coalesce(shiftright(x, __bits) = shiftright(get(__keys, k + 1), __bits), false)), x -> named_struct('a', __words[cast(x & (shiftleft(1L, __bits) - 1L) as int)],
        'b', __words[cast(x & (shiftleft(1L, __bits) - 1L) as int) + 1], 'c', __words[cast(x & (shiftleft(1L, __bits) - 1L) as int) + 2],
        'place', x & (shiftleft(1L, __bits) - 1L))))""")
    places = F.expr("""sort_array(transform(filter(__windows, (x, k) ->
        coalesce(x.a = get(__windows, k - 1).a and x.b = get(__windows, k - 1).b and x.c = get(__windows, k - 1).c, false)
        or coalesce(x.a = get(__windows, k + 1).a and x.b = get(__windows, k + 1).b and x.c = get(__windows, k + 1).c, false)), x -> x.place))""")
    covered = F.expr("""aggregate(__places, named_struct('last', -3L, 'words', 0L),
        (seen, place) -> named_struct('last', place, 'words', seen.words + least(3L, place - seen.last)), seen -> seen.words)""")
    return df.withColumn("__windows", proposed).withColumn("__places", places).withColumn("n_repeat_words", covered).select(*kept, *COUNTS, *MORE)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _share(part: str, whole: str = "n_words") -> Column:
    return F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double")), F.lit(0.0))




def features() -> dict[str, Column]:
    return {
        "words": F.col("n_words").cast("double"), "word_length": _share("word_chars"), "symbols_per_word": _share("n_symbols"),
        "repeated_lines": _share("n_dup_lines", "n_lines"), "repeated_words": _share("n_repeat_words"),
        "distinct_words": _share("n_distinct_words"), "capital_words": _share("n_capital_words"), "bangs_per_word": _share("n_bangs"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        value = features()[self.feature]
        return value >= self.threshold if self.at_least else value < self.threshold


@dataclass(frozen=True)
class Rule:
    """Drops a row where all conditions hold; counts are of the pruning rows it met."""

    conditions: tuple[Condition, ...]
    bad: int
    good: int

    def column(self) -> Column:
        return reduce(lambda a, b: a & b, [condition.column() for condition in self.conditions])


@dataclass(frozen=True)
class DecisionList:
    rules: tuple[Rule, ...]

    def first_rule(self) -> Column:
        """The number, from 1, of the first rule that holds, else null."""
        if not self.rules:
            return F.lit(None).cast("int")
        first, *others = [(rule.column(), F.lit(i)) for i, rule in enumerate(self.rules, 1)]
        return reduce(lambda chain, rule: chain.when(*rule), others, F.when(*first))

    def text(self) -> list[str]:
        return [" and ".join(f"{c.feature} {'>=' if c.at_least else '<'} {c.threshold:g}" for c in rule.conditions) for rule in self.rules]


def _gain(bad: int, good: int, before_bad: int, before_good: int) -> float:
    return bad * (log2(bad / (bad + good)) - log2(before_bad / (before_bad + before_good))) if bad else 0.0


def _holds(condition: tuple[str, bool, int]) -> Column:
    feature, at_least, cut = condition
    return F.col(feature) >= cut if at_least else F.col(feature) < cut


def _bin(feature: str, cuts: list[float]) -> Column:
    """How many of the cuts the feature reaches."""
    return F.size(F.filter(F.array(*[F.lit(cut) for cut in cuts]).cast("array<double>"), lambda cut: F.col(feature) >= cut))


def learn(labelled: DataFrame, bad: Column, *, key: str = "doc_id", sample_rows: int = SAMPLE_ROWS, max_rules: int = 8,
          max_conditions: int = 3, min_support: int = 8, min_precision: float = 0.95) -> DecisionList:
    """Learn rules for the rows of `labelled` (with the columns of `text_statistics`) where `bad` holds."""
    names = list(features())
    rows = labelled.select(F.col(key).alias("__key"), bad.alias("bad"), *[column.alias(name) for name, column in features().items()]).filter("bad is not null")
    n = rows.count()
    draw = F.pmod(F.xxhash64("__key", F.lit(11)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = stored(rows.filter(draw < min(1.0, sample_rows / max(n, 1))).withColumn("grow", crc32_of_id("__key") % 3 != 0), "labelled")
    steps = F.array(*[F.lit((i + 1) / (QUANTILES + 1)) for i in range(QUANTILES)])
    marks = rows.agg(*[F.percentile(name, steps).alias(name) for name in names],
                     *[F.percentile(F.when(F.col("bad"), F.col(name)), steps).alias(f"bad_{name}") for name in names]).first()
    cuts = {name: sorted({*(marks[name] or []), *(marks[f"bad_{name}"] or [])}) for name in names}
    binned = rows.select("bad", "grow", *[_bin(name, cuts[name]).alias(name) for name in names])
    cells = stored(binned.groupBy("bad", "grow", *names).count(), "binned")
    rules: list[Rule] = []
    while len(rules) < max_rules:
        conditions: list[tuple[str, bool, int]] = []
        inside = cells
        while len(conditions) < max_conditions:
            tested = inside.filter("grow").select("bad", "count", F.posexplode(F.array(*names)).alias("feature", "bin"))
            sums: dict[int, dict[int, list[int]]] = {}
            for feature, place, bad_here, count in tested.groupBy("feature", "bin", "bad").agg(F.sum("count")).collect():
                sums.setdefault(feature, {}).setdefault(place, [0, 0])[not bad_here] += count
            total = [sum(x[i] for x in sums.get(0, {}).values()) for i in (0, 1)]
            if not total[0] or not total[1] or (conditions and total[0] / sum(total) >= 0.998):
                break
            best, best_gain = None, 0.0
            for feature, bins in sorted(sums.items()):
                below = [0, 0]
                for cut in range(1, len(cuts[names[feature]]) + 1):
                    below = [below[i] + bins.get(cut - 1, (0, 0))[i] for i in (0, 1)]
                    for at_least, part in ((True, [total[0] - below[0], total[1] - below[1]]), (False, below)):
                        if part[0] >= min_support and (gain := _gain(*part, *total)) > best_gain + 1e-9:
                            best, best_gain = (names[feature], at_least, cut), gain
            if best is None:
                break
            conditions.append(best)
            inside = inside.filter(_holds(best))
        if not conditions:
            break
        prefixes = [reduce(lambda a, b: a & b, map(_holds, conditions[:i + 1])) for i in range(len(conditions))]
        tests = cells.filter("not grow").agg(*[
            F.coalesce(F.sum(F.when(prefix & (F.col("bad") == is_bad), F.col("count"))), F.lit(0)) for prefix in prefixes for is_bad in (True, False)]).first()
        scores = [(tests[2 * i] - tests[2 * i + 1]) / max(1, tests[2 * i] + tests[2 * i + 1]) for i in range(len(prefixes))]
        length = max(range(len(scores)), key=lambda i: (scores[i], tests[2 * i], -i))
        right, wrong = tests[2 * length], tests[2 * length + 1]
        if right < min_support / 2 or right / (right + wrong) < min_precision:
            break
        rules.append(Rule(tuple(Condition(name, up, float(cuts[name][cut - 1])) for name, up, cut in conditions[:length + 1]), right, wrong))
        cells = cells.filter(~prefixes[length])
    return DecisionList(tuple(rules))


@own_names
def judge(statistics: DataFrame, rules: DecisionList) -> DataFrame:
    """`statistics` with base_failed, rule (number of the first that holds) and kept."""
    kept = without_columns(statistics, "base_failed", "rule", "kept")
    return statistics.select(*kept, base_failed().alias("base_failed"), rules.first_rule().alias("rule")).withColumn(
        "kept", ~F.col("base_failed") & F.col("rule").isNull())


def quality_report(docs: DataFrame, labels: DataFrame, options: Mapping[str, float] | None = None) -> DataFrame:
    """Learn from the labelled documents and judge all."""
    statistics = stored(text_statistics(docs.select("doc_id", "text")).drop("text"), "statistics")
    labelled = statistics.join(labels.select("doc_id", "quality"), "doc_id")
    rules = learn(labelled, F.col("quality") == 0, **(options or {}))
    return judge(statistics, rules).select("doc_id", *COUNTS, "base_failed", "kept", "rule")
