"""Personal data: fixed patterns, and bootstrapped contextual extraction. DataFrame functions only.

Base entities are found by regular expressions with a check each. They are the seeds. A
candidate is a token with a digit; its lexical patterns are the word before it, the two words
before it, and the words before and after it, each with the token's shape (runs of letters, of
digits, and of ten or more digits); the word next to it must have a letter, so that separators of tables teach nothing. Patterns and the
instances they match form a graph that is scored in rounds: a pattern's confidence in
a kind is the mean score of its distinct instances, an instance's score is the chance
that not all of its patterns err. Seeds keep score 1. In the end patterns with enough
confidence and seeds name candidates that no base entity covers.

Places count code points. The expressions start only where a run of their first
characters starts, or where the last match ended, which finds the same matches in time
linear in the text. Counts run over all documents; pattern counts are summed before the
shuffle, and frequent patterns and instances are looked up by broadcast, so neither makes a hot group.

Defined cases: a null text counts as empty and has no spans. Rows are answered one by one,
whether or not ids repeat or are null. Result columns replace input columns of the same
name. Ties between kinds go to the first as listed. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillframe.llm.common import looked_up, own_names, stored, without_columns

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "A-Za-z0-9._%+-"
#: The base expressions, each bound to the start of a run or the end of the last match.
EXPRESSIONS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?:(?<![0-9])|\G)[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"
_EDGE = "!\"#$%&'()*,-./:;<=>?[\\]^_`{|}~"
_SPAN = "array<struct<start:int,end:int,found:string>>"
_RUN = 128
#: Code points in a bucket of places, for joining candidates and entities that touch.
_BUCKET = 64


@dataclass(frozen=True)
class Bootstrap:
    """Rounds of scoring, and what a pattern needs to name new identifiers."""

    rounds: int = 3
    min_confidence: float = 0.9
    min_seeds: int = 5


def matches(text: str, expression: str) -> Column:
    """All matches in order, each with the text before it; the last has only the text after all matches."""
    pattern = "'" + expression.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return F.expr(f"""if(regexp_like({text}, {pattern}),
        zip_with(regexp_extract_all({text}, {pattern}, 0), split({text}, {pattern}, -1),
            (found, before) -> named_struct('found', found, 'before', before)),
        cast(array() as array<struct<found:string,before:string>>))""")


def placed(parts: str) -> Column:
    """(start, end, found) of the matches in a column of `matches`.

    Places are summed over runs of _RUN matches, so that the work is linear in the matches.
    """
    return F.expr(f"""flatten(transform(aggregate(
        if(size({parts}) = 0, cast(array() as array<int>), sequence(0, cast((size({parts}) - 1) div {_RUN} as int))),
        cast(array() as array<struct<at:int,spans:{_SPAN}>>),
        (runs, run) -> array_append(runs, aggregate(
            slice({parts}, run * {_RUN} + 1, {_RUN}),
            named_struct('at', coalesce(get(runs, size(runs) - 1).at, 0), 'spans', cast(array() as {_SPAN})),
            (seen, x) -> if(x.found is null, seen, named_struct(
                'at', seen.at + length(x.before) + length(x.found),
                'spans', array_append(seen.spans, named_struct(
                    'start', seen.at + length(x.before), 'end', seen.at + length(x.before) + length(x.found), 'found', x.found))))))),
        run -> run.spans))""")


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a digit text passes Luhn's check."""
    def twice(digit: Column) -> Column:
        return F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)

    places = F.transform(F.split(F.reverse(digits), ""), lambda digit, i: F.when(
        i % 2 == 1, twice(F.try_to_number(digit, F.lit("9")).cast("int"))).otherwise(F.try_to_number(digit, F.lit("9")).cast("int")))
    return F.aggregate(places, F.lit(0), lambda total, digit: total + F.coalesce(digit, F.lit(0))) % 10 == 0


def _small(part: Column) -> Column:
    """Whether a digit text is at most 255."""
    trimmed = F.regexp_replace(part, "^0+(?=[0-9])", "")
    return (F.length(trimmed) < 3) | ((F.length(trimmed) == 3) & (trimmed <= "255"))


CHECKS = {
    "email": lambda found: F.lit(True),
    "ip": lambda found: F.forall(F.split(found, r"\."), _small),
    "card": lambda found: F.length(_digits(found)).between(14, 19) & _luhn(_digits(found)),
    "phone": lambda found: F.length(_digits(found)).between(10, 15),
}


def _spans(kind: str) -> Column:
    return F.transform(
        F.filter(f"__{kind}", lambda span: CHECKS[kind](span["found"])),
        lambda span: F.struct(span["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), span["end"].alias("end")))


def base_entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with `base` (start, rank of the kind, end; in order) and `candidates` (start, end, found, word, words, next)."""
    kept = without_columns(docs, "base", "candidates")
    df = docs.select(*kept, F.when(F.regexp_like(F.col(text), F.lit("[0-9@]")), F.col(text)).otherwise(F.lit("")).alias("__text"))
    df = df.select(*kept, *[matches("__text", expression).alias(f"__parts_{kind}") for kind, expression in EXPRESSIONS.items()],
                   matches("__text", _TOKEN).alias("__parts_tokens"))
    df = df.select(*kept, *[placed(f"__parts_{kind}").alias(f"__{kind}") for kind in (*KINDS, "tokens")], "__parts_tokens")
    df = df.withColumn("__around", F.zip_with("__parts_tokens", F.expr("slice(__parts_tokens, 2, size(__parts_tokens))"), lambda part, after: F.struct(
        part["before"].alias("before"), F.coalesce(after["before"], F.lit("")).alias("after"))))
    found = F.zip_with("__tokens", "__around", lambda token, gaps: F.when(token.isNotNull(), _candidate(token, gaps)))
    return df.select(*kept, F.sort_array(F.concat(*map(_spans, KINDS))).alias("base"),
                     F.filter(found, lambda token: token.isNotNull()).alias("candidates"))


def _flat(gap: Column) -> Column:
    return F.lower(F.btrim(F.translate(gap, "\t\n\x0b\f\r", "     ")))


def _candidate(token: Column, gaps: Column) -> Column:
    """The token without punctuation at its ends, the words before it, and the word after it."""
    core = F.btrim(token["found"], F.lit(_EDGE))
    start = token["start"] + F.length(token["found"]) - F.length(F.ltrim(token["found"], F.lit(_EDGE)))
    flat = _flat(gaps["before"])
    return F.struct(start.alias("start"), (start + F.length(core)).alias("end"), core.alias("found"),
                    F.substring_index(flat, " ", -1).alias("word"), F.substring_index(flat, " ", -2).alias("words"),
                    F.substring_index(_flat(gaps["after"]), " ", 1).alias("next"))


def shape(token: Column) -> Column:
    letters = F.regexp_replace(token, "[A-Za-z]+", "a")
    return F.regexp_replace(F.regexp_replace(letters, "[0-9]{10,}", "L"), "[0-9]+", "9")


def _buckets(start: Column, end: Column) -> Column:
    return F.sequence(F.floor(F.greatest(start, F.lit(0)) / _BUCKET), F.floor(end / _BUCKET))


def occurrences(entities: DataFrame, row: str) -> DataFrame:
    """(row, start, end, instance, rank, pattern): rank of the base entity that starts in the candidate, null where none
    touches it; candidates inside an entity are left out. Up to three patterns for each occurrence."""
    one = entities.select(row, F.explode("candidates").alias("c"))
    places = entities.select(F.col(row).alias("__of"), F.explode("base").alias("b")).select(
        "__of", "b", F.explode(_buckets(F.col("b.start"), F.col("b.end"))).alias("__place"))
    near = one.select(row, "c", F.explode(_buckets(F.col("c.start") - 1, F.col("c.end"))).alias("__bucket")).join(
        places, (F.col(row) == F.col("__of")) & (F.col("__bucket") == F.col("__place")))
    starts = (F.col("b.start") >= F.col("c.start") - 1) & (F.col("b.start") < F.col("c.end"))
    touches = (F.col("b.start") < F.col("c.end")) & (F.col("b.end") > F.col("c.start"))
    met = near.groupBy(F.col(row).alias("__of"), F.col("c.start").alias("__at")).agg(
        F.max(touches).alias("__touched"), F.min(F.when(starts, F.struct(F.col("b.start").alias("start"), F.col("b.rank").alias("rank"))))["rank"].alias("rank"))
    one = one.join(met, (F.col(row) == F.col("__of")) & (F.col("c.start") == F.col("__at")), "left")
    one = one.select(row, F.col("c.start").alias("start"), F.col("c.end").alias("end"), F.lower("c.found").alias("instance"),
                     "rank", F.coalesce("__touched", F.lit(False)).alias("__touched"), shape(F.col("c.found")).alias("__shape"),
                     F.col("c.word").alias("__word"), F.col("c.words").alias("__words"), F.col("c.next").alias("__next"))
    one = one.filter(F.expr("rank is not null or not __touched") & F.regexp_like("__word", F.lit(r"\p{L}")))
    between = F.when(F.regexp_like("__next", F.lit(r"\p{L}")), F.concat_ws("\t", "__word", "__shape", "__next"))
    contexts = F.array_compact(F.array_distinct(F.array(F.concat_ws("\t", "__word", "__shape"), F.concat_ws("\t", "__words", "__shape"), between)))
    return one.select(row, "start", "end", "instance", "rank", F.explode(contexts).alias("pattern"))


def confident_patterns(found: DataFrame, settings: Bootstrap = Bootstrap()) -> DataFrame:
    """(pattern, rank, confidence, seeds, n) of the patterns that may name identifiers: the best kind of each, and
    how many occurrences there are that no base entity starts in."""
    edges = stored(found.groupBy("pattern", "instance").agg(*[
        F.max(F.coalesce((F.col("rank") == i).cast("double"), F.lit(0.0))).alias(f"seed_{i}") for i in range(len(KINDS))],
        F.sum(F.col("rank").isNull().cast("bigint")).alias("free")), "edges")
    rows, pairs = edges.count(), edges.select("pattern", "instance")
    names = [f"score_{i}" for i in range(len(KINDS))]
    seeds = stored(edges.groupBy("instance").agg(F.count(F.lit(1)).alias("n"), *[F.max(f"seed_{i}").alias(f"seed_{i}") for i in range(len(KINDS))]), "seeds")
    scores = seeds.select("instance", "n", *[F.col(f"seed_{i}").alias(names[i]) for i in range(len(KINDS))])
    patterns = None
    for _ in range(settings.rounds):
        patterns = stored(looked_up(pairs, scores, "instance", rows).groupBy("pattern").agg(
            F.count(F.lit(1)).alias("instances"), *[F.sum(name).alias(name) for name in names]).select(
            "pattern", "instances", *[(F.col(name) / F.col("instances")).alias(f"trust_{i}") for i, name in enumerate(names)], *names), "patterns")
        trusted = [F.when(F.col(name) >= settings.min_seeds, F.col(f"trust_{i}")).otherwise(0.0) for i, name in enumerate(names)]
        errs = looked_up(pairs, patterns.select("pattern", F.col("instances").alias("n"), *[t.alias(f"t_{i}") for i, t in enumerate(trusted)]), "pattern", rows)
        gained = errs.groupBy("instance").agg(*[
            (1 - F.exp(F.sum(F.log1p(-F.least(F.col(f"t_{i}"), F.lit(0.999)))))).alias(f"gain_{i}") for i in range(len(KINDS))])
        scores = gained.join(seeds, "instance").select("instance", "n", *[
            F.when(F.greatest(*[F.col(f"seed_{j}") for j in range(len(KINDS))]) > 0, F.col(f"seed_{i}")).otherwise(F.col(f"gain_{i}")).alias(names[i])
            for i in range(len(KINDS))])
    direct = edges.groupBy("pattern").agg(F.sum("free").alias("n"), *[F.sum(f"seed_{i}").alias(f"seeds_{i}") for i in range(len(KINDS))])
    best = F.greatest(*[F.col(f"trust_{i}") for i in range(len(KINDS))])
    rank = reduce(lambda chain, i: chain.when(F.col(f"trust_{i}") == best, i), range(1, len(KINDS)), F.when(F.col("trust_0") == best, 0))
    seeds_of = F.array(*[F.col(f"seeds_{i}") for i in range(len(KINDS))])
    return patterns.join(direct, "pattern").select("pattern", rank.alias("rank"), best.alias("confidence"), seeds_of.alias("__seeds"), "n").select(
        "pattern", "rank", "confidence", F.get("__seeds", F.col("rank")).cast("bigint").alias("seeds"), "n").filter(
        (F.col("confidence") >= settings.min_confidence) & (F.col("seeds") >= settings.min_seeds))


@own_names
def find_entities(docs: DataFrame, text: str = "text", settings: Bootstrap = Bootstrap()) -> DataFrame:
    """`docs` without its text, with `base` and `spans`: arrays of (start, rank, end), spans holding base and the discovered ones."""
    entities = stored(base_entities(docs, text).drop(text).withColumn("__row", F.monotonically_increasing_id()), "entities")
    found = stored(occurrences(entities, "__row"), "occurrences")
    patterns, free = confident_patterns(found, settings), found.filter("rank is null").drop("rank")
    new = looked_up(free, patterns.select("pattern", "rank", "n"), "pattern", free.count()).groupBy("__row", "start", "end").agg(
        F.min("rank").alias("rank")).groupBy("__row").agg(F.collect_list(F.struct("start", "rank", "end")).alias("__new"))
    joined = entities.join(new, "__row", "left")
    spans = F.sort_array(F.concat("base", F.coalesce("__new", F.array().cast("array<struct<start:int,rank:int,end:int>>"))))
    return joined.select(*without_columns(entities, "__row", "candidates", "spans"), spans.alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda span: F.concat_ws(":", F.get(kinds, span["rank"]), span["start"], span["end"])), ",")


def entity_report(docs: DataFrame) -> DataFrame:
    found = find_entities(docs.select("doc_id", "text"))
    counts = [F.size(F.filter("base", _is_rank(i))).cast("bigint").alias(f"n_{kind}") for i, kind in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(span_text(F.col("base")), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"),
                        F.size("spans").cast("bigint").alias("n_spans"))


def _is_rank(i: int):
    return lambda span: span["rank"] == i
