"""Scores and mixture weights are functions of the table: no chunk, file or order has a part in them."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tillframe.llm import lm
from tillframe.llm.common import read


def test_layout_changes_nothing(spark):
    docs = read(spark, SMALL, "documents")
    found = []
    for parts, chunk_tokens in ((1, lm.CHUNK_TOKENS), (8, lm.CHUNK_TOKENS), (5, 20_000)):
        scores, mixture = lm.score(docs.repartition(parts), chunk_tokens=chunk_tokens)
        found.append(({row.doc_id: row.score for row in scores.collect()}, mixture.weights))
    for scores, weights in found[1:]:
        assert np.abs(weights - found[0][1]).max() < 1e-9
        assert scores == pytest.approx(found[0][0], rel=1e-9)


def test_weights_equal_a_plain_deletion(spark):
    rows = read(spark, SMALL, "documents").select("doc_id", "text", lm.fold_of("doc_id", "text").alias("fold")).collect()
    one, two = ([Counter() for _ in range(lm.DELETED_FOLDS)] for _ in range(2))
    for row in rows:
        if row.fold >= 0:
            stream = [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), row.text or "")), None]
            one[row.fold].update(stream)
            two[row.fold].update(zip([None, *stream], stream))
    words, pairs = sum(one, Counter()), sum(two, Counter())
    tokens, distinct, cells = sum(words.values()), len(words), Counter()
    for fold in range(lm.DELETED_FOLDS):
        rest = tokens - sum(one[fold].values())
        for (left, right), n in two[fold].items():
            context = words[left] - one[fold][left]
            ratios = ((pairs[left, right] - two[fold][left, right]) / context * (distinct + 1) if context else 0.0,
                      (words[right] - one[fold][right]) / rest * (distinct + 1))
            steps = [round(math.log2(x) * lm.STEPS_PER_POWER) if x > 0 else lm._NONE for x in ratios]
            cells[int(math.log2(context + 1)), *steps] += n
    mixture = lm.score(read(spark, SMALL, "documents"))[1]
    assert (mixture.tokens, mixture.distinct) == (tokens, distinct)
    assert np.abs(mixture.weights - lm.learned_weights([(*cell, n) for cell, n in cells.items()])).max() < 1e-9


def test_equal_texts_share_a_fold(documents):
    folds = documents(*[(i, f"text {i % 3}") for i in range(60)], (100, None)).select("text", lm.fold_of("doc_id", "text").alias("fold")).filter("fold >= 0")
    assert folds.groupBy("text").agg(F.countDistinct("fold").alias("n")).filter("n > 1").count() == 0
