"""The corpus pipeline: language, near copies, test passages, mixture, shards.

Each stage takes and returns the columns of `documents`; the last adds shard and slot.
The result of a stage is written to the shared scratch folder and read by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillframe.llm import decontaminate, jaccard, langid, mixing, resharding
from tillframe.llm.common import read, stored


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model accepts."""
    return langid.keep_identified(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard.one_of_each(docs)


def without_test_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages they share with the benchmark."""
    return decontaminate.remove_contamination(docs, read(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens follow the targets for source, language and kind of text."""
    return mixing.sampled(docs)


def placed_in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their new shard and slot."""
    return resharding.resharded(docs)


STAGES = [
    ("language ID", known_language),
    ("near copies", without_near_copies),
    ("decontamination", without_test_passages),
    ("mixture", mixed_sources),
    ("sharding", placed_in_shards),
]

#: A trained model decides the first stage, so SQL cannot give the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
