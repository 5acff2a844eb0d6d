"""Odd rows, clashing names and empty tables, for every operator and every stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm.conftest import ODD
from tillframe.llm import decontaminate, jaccard, langid, lm, mixing, packing, pii, resharding, rules, tokens

WORDS = "the cat sat on the mat and looked at the dog that slept by the door"


@pytest.fixture
def benchmark(spark):
    return spark.createDataFrame([(0, WORDS), (1, None), (None, "x y"), (2, ""), (2, "!?")], "item_id bigint, text string")


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 0), (99, 0, 1), (None, 0, 0), (3, None, 0)], "doc_id bigint, quality int, toxic int")


def operators(benchmark, labels):
    return {
        "mixing": mixing.mix,
        "decontamination": lambda docs: decontaminate.find_contamination(docs, benchmark),
        "removal": lambda docs: decontaminate.remove_contamination(docs, benchmark),
        "resharding": lambda docs: resharding.reshard(docs, resharding.old_layout()).rows,
        "rules": lambda docs: rules.judge(rules.text_statistics(docs), rules.learn(
            rules.text_statistics(docs.select("doc_id", "text")).join(labels, "doc_id"), F.col("quality") == 0)),
        "tokens": tokens.with_token_counts,
        "jaccard": jaccard.near_copies,
        "packing": packing.pack,
        "pii": pii.find_entities,
        "lm": lambda docs: lm.score(docs)[0],
        "language": lambda docs: langid.identify(docs, langid.train(docs)),
    }


#: Rows that come back for the odd rows: all, but for texts cut to nothing and packed rows.
ROWS = {"removal": len(ODD) - 2}


@pytest.mark.parametrize("name", operators(None, None))
def test_odd_rows_and_clashing_names(odd, clashing, benchmark, labels, name):
    apply = operators(benchmark, labels)[name]
    for docs in (odd, clashing):
        found = apply(docs)
        assert len(set(found.columns)) == len(found.columns)
        got = found.collect()
        if name != "packing":
            assert len(got) == ROWS.get(name, len(ODD))


@pytest.mark.parametrize("name", operators(None, None))
def test_empty_tables(odd, benchmark, labels, name):
    assert operators(benchmark.limit(0), labels.limit(0))[name](odd.limit(0)).collect() == []
    if name in ("decontamination", "removal", "rules"):  # nothing to test against, nothing to learn from
        assert operators(benchmark.limit(0), labels.limit(0))[name](odd).count() == len(ODD)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_odd_rows(spark, odd, clashing, name, stage):
    for docs in (odd, clashing, odd.limit(0)):
        found = stage(spark, docs, SMALL)
        if name == "sharding":
            assert {"shard", "slot"} <= set(found.columns)
        else:
            assert found.columns == docs.columns and found.dtypes == docs.dtypes
        assert found.count() <= docs.count()


def test_language_stage_drops_only_what_has_no_language(spark, odd):
    kept = corpus_pipeline.STAGES[0][1](spark, odd, SMALL)
    assert kept.filter("text is null or trim(text) in ('', '... !!! ###')").count() == 0
    assert kept.filter("text like '%cat sat%'").count() == 2


def test_near_copy_stage_keeps_one_of_each_group(spark, odd):
    kept = corpus_pipeline.STAGES[1][1](spark, odd, SMALL)
    assert kept.count() == len(ODD) - 1  # the repeated row
    assert kept.filter("doc_id = 1").count() == 1


def test_sharding_stage_keeps_every_row(spark, odd):
    found = corpus_pipeline.STAGES[-1][1](spark, odd, SMALL)
    assert found.count() == len(ODD)
    slots = found.groupBy("shard").agg(F.count("*").alias("n"), F.min("slot").alias("a"), F.max("slot").alias("b"), F.countDistinct("slot").alias("d"))
    assert slots.filter("a <> 0 or b <> n - 1 or d <> n").count() == 0
