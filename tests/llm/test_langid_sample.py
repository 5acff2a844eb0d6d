"""The training sample of the language model, prediction against plain Python, and word hashes."""

import math
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tillframe.llm import langid
from tillframe.llm.common import LETTERS, hash_words, read


@pytest.mark.parametrize("change", [
    lambda docs: docs.withColumn("doc_id", F.lit(None).cast("bigint")), lambda docs: docs.withColumn("doc_id", F.lit(5).cast("bigint")),
    lambda docs: docs.union(docs).union(docs)], ids=["null ids", "one id", "repeated rows"])
def test_ids_and_repetitions_do_not_starve_a_language(spark, change):
    docs = read(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "lang")
    model = langid.train(change(docs), sample_rows=400)
    found = langid.identify(docs, model).select((F.col("lang") == F.col("lang_pred")).alias("right"), "lang").filter("lang is not null")
    assert set(model.languages) == {row[0] for row in docs.select("lang").distinct().collect() if row[0]}
    assert found.agg(F.avg(F.col("right").cast("int"))).first()[0] > 0.95


def test_the_sample_is_bounded_and_layout_free(spark, monkeypatch):
    docs = read(spark, SMALL, "documents").select("doc_id", "text", "lang")
    sizes, fit = [], langid._fit
    monkeypatch.setattr(langid, "_fit", lambda samples, *rest: (sizes.append(len(samples)), fit(samples, *rest))[1])
    one, two = langid.train(docs.repartition(1), sample_rows=80), langid.train(docs.union(docs).repartition(7), sample_rows=80)
    assert sizes[0] == sizes[1] <= 80
    assert np.array_equal(one.scores, two.scores) and (one.temperature, one.threshold) == (two.temperature, two.threshold)


def test_the_driver_holds_the_sample_once(spark):
    """The least that training needs in Python is the received counts; the model equals one fitted on counts made here."""
    draw = np.random.default_rng(5)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz    "))
    texts = [(i, "".join(draw.choice(letters, 40_000)), ("xx", "yy")[i % 2]) for i in range(160)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, lang string").localCheckpoint()
    plain = sorted((lang, *[part.astype(np.int32).tobytes() for change in (bytes, langid.garbled) for part in langid.bucket_counts(change(text.encode()), 16)])
                   for _, text, lang in texts)
    size, counts = sum(len(part) for row in plain for part in row[1:]), [(row[0], *[np.frombuffer(part, np.int32) for part in row[1:]]) for row in plain]
    expected = langid._fit([(b.astype(np.int64), c, lang) for lang, b, c, *_ in counts], [(b.astype(np.int64), c) for *_, b, c in counts], 16, 2, 1, 1.0, 0.001, 7)
    tracemalloc.start()
    try:
        model = langid.train(docs, sample_rows=400, epochs=1, width=2)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert size > 15_000_000 and peak < 1.8 * size
    assert np.array_equal(model.scores, expected.scores) and (model.temperature, model.threshold) == (expected.temperature, expected.threshold)


def test_short_texts_are_looked_up_in_small_runs():
    long = b"four five " * 40_000
    runs = list(langid._runs([b"one two three " * 100, b""] * 900 + [long]))
    assert max(len(data) for first, last, data, _ in runs if last > first + 1) <= 1 << 18
    assert [first for first, *_ in runs[1:]] == [last for _, last, *_ in runs[:-1]] and runs[-1][:3] == (1800, 1801, long)


def test_only_the_text_goes_through_python(spark):
    """And it goes once, also where the result is filtered and used again."""
    rows = [(i, "the water was there and the house was old " * 9, "xx" if i % 2 else "yy", i / 2, "a") for i in range(60)]
    docs = spark.createDataFrame([*rows, (60, None, None, None, None)], "doc_id bigint, text string, lang string, score double, Rejected string").localCheckpoint()
    model = langid.train(docs)
    identified = langid.identify(docs, model)
    for found in (langid.keep_identified(docs), identified, identified.filter("not rejected and score > 0.2").select("doc_id", "text", "score")):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" not in plan and re.findall(r"ArrowEvalPython \[(.*?)#\d+\)", plan) == ["label(text"]
    assert identified.columns == ["doc_id", "text", "lang", "lang_pred", "score", "rejected"]
    kept = {row["doc_id"] for row in identified.filter("not rejected").collect()}
    assert 60 not in kept and {tuple(row) for row in langid.keep_identified(docs).collect()} == {row for row in rows if row[0] in kept}
    assert langid.keep_identified(docs).schema == docs.schema


def test_prediction_equals_a_plain_sum(spark):
    docs = read(spark, SMALL, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs, sample_rows=200)
    for row in langid.identify(docs, model).limit(60).collect():
        letters = [b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in (row.text or "").encode()]
        grams = Counter()
        padded = [32, *letters, 32]
        for size in langid.SIZES:
            for i in range(len(padded) - size + 1):
                gram = padded[i:i + size]
                if (32 in gram[1:-1]) or (size == 2 and gram == [32, 32]):
                    continue
                value = sum(b << 8 * k for k, b in enumerate(gram)) ^ (size * 0x3C6EF372 & 0xFFFFFFFF)
                value = value * 2654435761 & 0xFFFFFFFF
                value = (value ^ value >> 15) * 2246822519 & 0xFFFFFFFF
                grams[value >> 32 - model.bits] += 1
        n = sum(grams.values())
        if not n or not any(c.isalpha() for c in row.text or ""):
            assert (row.lang_pred, row.score) == ("und", 0.0)
            continue
        logits = [(sum(k * float(model.scores[g, j]) for g, k in grams.items()) / n + model.bias[j]) / model.temperature for j in range(len(model.languages))]
        chances = [math.exp(x - max(logits)) for x in logits]
        best = max(range(len(chances)), key=lambda j: chances[j])
        assert row.lang_pred == model.languages[best]
        assert row.score == pytest.approx(chances[best] / sum(chances), rel=1e-3)


@pytest.mark.parametrize("power", [8, 10, 11, 12])
def test_thue_morse_words_have_different_hashes(power):
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1 << power))
    two = one.translate(str.maketrans("ab", "ba"))
    hashes, *_ = hash_words(f"{one} {two} {one}".encode(), LETTERS)
    assert hashes[0] != hashes[1] and hashes[0] == hashes[2]
