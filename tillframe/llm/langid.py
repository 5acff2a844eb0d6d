"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the mean of the embeddings of its hashed byte n-grams (within words, with
word borders), fed to a softmax. Training is plain stochastic gradient descent in numpy
on a bounded sample of labelled rows: of each language, the `sample_rows` / languages different rows whose
hash of id and text is smallest, so neither repeated nor missing ids change who may be drawn, nor does the
sample grow with the table. A part of the sample sets the temperature and the threshold for rejection.

Beside the languages the softmax has one class for texts of none: garbled versions of the sample, with letters
shuffled, letters exchanged for others of their kind (vowels, consonants), or hexadecimal digits in their place. A text is rejected if that class
leads the best language by more than a threshold, set between held-out texts of the languages, long and short, and held-out
garbled ones; the model carries both error rates. Scores are chances among the languages alone.

Prediction is linear in the n-grams, so the embedding table times the softmax matrix is
one table of a fixed size (2**bits rows, a column per language); tasks add its rows over
whole texts. The table is all that is sent to the executors.

Defined cases: a null text, or one without a letter, is `und` with score 0 and is
rejected. Without labelled rows every text is. Nulls elsewhere, repeated rows and ties
change nothing; a tie between languages goes to the first in alphabetical order. Result
columns replace input columns of the same name. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillframe.llm.common import BLOCK_BYTES, crc32_of_id, importable, own_names, utf8, without_columns

UNKNOWN = "und"
SIZES = (2, 3, 4)
FOLDS, HELD_OUT = 4, 2
#: Bytes of texts whose n-grams are looked up in one go, at which a task's memory stays small beside the rest of it.
RUN_BYTES = 1 << 18
#: Parts in which the driver receives the sample.
FETCHES = 8
_VOWELS = np.frombuffer(b"aeiouy", np.uint8)
_CONSONANTS = np.frombuffer(b"bcdfghjklmnpqrstvwxz", np.uint8)
_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)
_SPACE = 32
_LETTERS = np.full(256, _SPACE, dtype=np.uint8)
_LETTERS[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTERS[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTERS[0x80:] = np.arange(0x80, 0x100)


@dataclass(frozen=True)
class LanguageModel:
    """Scores of each bucket for each language and, last, for no language; the calibration; and rejection.

    `threshold` is the lead over the best language that rejects; `false_rejections` and `caught` are the shares
    of held-out texts, and of garbled ones, that it rejects.
    """

    languages: tuple[str, ...]
    bits: int
    scores: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float
    false_rejections: float = 0.0
    caught: float = 0.0


def _grams(data: bytes, begins: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of the n-grams of texts laid end to end, and where each text's begin; one pair a size."""
    letters = np.concatenate(([_SPACE], _LETTERS[np.frombuffer(data, np.uint8)], [_SPACE] * max(SIZES))).astype(np.uint8)
    blank, n = letters == _SPACE, len(data) + 1
    wide = letters.astype(np.uint32)
    packed = wide[:n].copy()
    for size in range(2, max(SIZES) + 1):
        packed |= wide[size - 1:size - 1 + n] << np.uint32(8 * (size - 1))
        if size in SIZES:
            good = ~(blank[:n] & blank[1:1 + n]) if size == 2 else ~blank[1:1 + n]
            for inner in range(2, size - 1):
                good &= ~blank[inner:inner + n]
            at = np.flatnonzero(good)
            hashed = (packed[at] ^ np.uint32(size * 0x3C6EF372)) * np.uint32(2654435761)
            hashed = (hashed ^ (hashed >> np.uint32(15))) * np.uint32(2246822519)
            yield (hashed >> np.uint32(32 - bits)).astype(np.int64), np.searchsorted(at, begins)


def _runs(texts: list[bytes]) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """Texts laid end to end with blanks between, about RUN_BYTES at once; a text longer than BLOCK_BYTES comes in parts."""
    first = 0
    while first < len(texts):
        text = texts[first]
        if len(text) > BLOCK_BYTES:
            start = 0
            while start < len(text):
                end = min(start + BLOCK_BYTES, len(text))
                while end < len(text) and _LETTERS[text[end]] != _SPACE:
                    end += 1
                yield first, first + 1, text[start:end], np.array([0, end - start + 1])
                start = end
            first += 1
            continue
        last, size = first + 1, len(text)
        while last < len(texts) and size + len(texts[last]) < RUN_BYTES:
            size += len(texts[last]) + 1
            last += 1
        yield first, last, b" ".join(texts[first:last]), np.cumsum([0, *(len(x) + 1 for x in texts[first:last])])
        first = last


def _has_letter(text: bytes) -> bool:
    return any(character.isalpha() for character in text.decode("utf-8", "replace"))


def bucket_counts(text: bytes, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a whole text and how often each occurs."""
    found = [buckets for *_, data, begins in _runs([text]) for buckets, _ in _grams(data, begins, bits)]
    return np.unique(np.concatenate(found) if found else np.empty(0, np.int64), return_counts=True)


def garbled(text: bytes) -> bytes:
    """The text made into one of no language, in one of three ways; a function of the text."""
    seed = zlib.crc32(text)
    draw = np.random.default_rng(seed)
    letters = _LETTERS[np.frombuffer(text, np.uint8)]
    at = np.flatnonzero(letters != _SPACE)
    if seed % 3 == 0:
        letters[at] = draw.permutation(letters[at])
    elif seed % 3 == 1:
        names = np.arange(256, dtype=np.uint8)
        for kind in (_VOWELS, _CONSONANTS):
            names[kind] = draw.permutation(kind)
        letters = names[letters]
    else:
        letters[at] = draw.choice(_HEX, len(at))
    return letters.tobytes()


def predict(texts: list[bytes], model: LanguageModel) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, calibrated probability and rejection of each text."""
    sums = np.zeros((len(texts), model.scores.shape[1]))
    counts = np.zeros(len(texts))
    for first, last, data, begins in _runs(texts):
        for buckets, offsets in _grams(data, begins, model.bits):
            each = np.diff(offsets)
            some = np.flatnonzero(each)
            if len(some) and len(model.languages):
                sums[first + some] += np.add.reduceat(model.scores[buckets], offsets[some], axis=0)
            counts[first:last] += each
    known = [bool(len(model.languages)) and count > 0 and _has_letter(text) for text, count in zip(texts, counts)]
    if not any(known):
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
    logits = sums / np.maximum(counts, 1)[:, None] + model.bias
    chances = softmax(logits[:, :-1] / model.temperature)
    best = chances.argmax(axis=1)
    score = np.where(known, chances[np.arange(len(texts)), best], 0.0)
    return ([model.languages[i] if k else UNKNOWN for i, k in zip(best, known)], score,
            ~np.array(known) | (_lead(logits) > model.threshold))


def _lead(logits: np.ndarray) -> np.ndarray:
    """By how much the class of no language leads the best language."""
    return logits[:, -1] - logits[:, :-1].max(axis=1)


def softmax(logits: np.ndarray) -> np.ndarray:
    powers = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return powers / powers.sum(axis=-1, keepdims=True)


def _descend(rows: list[tuple[np.ndarray, np.ndarray, int]], n_languages: int, bits: int, width: int,
             epochs: int, rate: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Embeddings times softmax matrix, and bias, after SGD over (buckets, counts, language)."""
    draw = np.random.default_rng(seed)
    table = draw.uniform(-1 / width, 1 / width, (1 << bits, width)).astype(np.float32)
    matrix = draw.normal(0, 0.1, (width, n_languages)).astype(np.float32)
    bias = np.zeros(n_languages, np.float32)
    steps, total = 0, epochs * len(rows)
    for _ in range(epochs):
        for i in draw.permutation(len(rows)):
            buckets, counts, language = rows[i]
            buckets, shares = buckets.astype(np.int64), _shares(counts)
            pace = np.float32(rate * (1 - steps / total))
            mean = shares @ table[buckets]
            error = softmax(mean @ matrix + bias).astype(np.float32)
            error[language] -= 1
            back = matrix @ error
            matrix -= pace * np.outer(mean, error)
            bias -= pace * 0.1 * error
            table[buckets] -= (pace * len(buckets) ** 0.5) * np.outer(shares, back)
            steps += 1
    return table @ matrix, bias


def _thinned(row: tuple[np.ndarray, np.ndarray, int], seed: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """The row as if its text were short, so that calibration covers short texts as well."""
    buckets, counts, language = row
    draw = np.random.default_rng(seed + len(buckets))
    for grams in (6, 24, 96):
        drawn = draw.multinomial(grams, (wide := _shares(counts).astype(np.float64)) / wide.sum())
        some = drawn > 0
        yield buckets[some], drawn[some], language


def fit(texts: list[bytes], labels: list[str], *, bits: int = 16, width: int = 12, epochs: int = 6,
        rate: float = 1.0, false_rejections: float = 0.001, seed: int = 7) -> LanguageModel:
    """Train on labelled texts; every fifth of them, dealt by a fixed draw, calibrates."""
    return _fit([(*bucket_counts(text, bits), label) for text, label in zip(texts, labels)],
                [bucket_counts(garbled(text), bits) for text in texts], bits, width, epochs, rate, false_rejections, seed)


def _shares(counts: np.ndarray) -> np.ndarray:
    return (counts / counts.sum()).astype(np.float32)


def _fit(samples: list[tuple[np.ndarray, np.ndarray, str]], noise: list[tuple[np.ndarray, np.ndarray]], bits: int, width: int,
         epochs: int, rate: float, false_rejections: float, seed: int) -> LanguageModel:
    samples = [sample for sample in samples if len(sample[0])]
    languages = tuple(sorted({label for *_, label in samples}))
    if not languages:
        return LanguageModel((), bits, np.zeros((1 << bits, 1), np.float32), np.zeros(1), 1.0, 0.0)
    rows = [(buckets, counts, languages.index(label)) for buckets, counts, label in samples]
    rows += [(buckets, counts, len(languages)) for buckets, counts in noise if len(buckets)]
    apart = np.random.default_rng(seed + 1).random(len(rows)) < 0.2
    scores, bias = _descend([row for row, out in zip(rows, apart) if not out] or rows, len(languages) + 1, bits, width, epochs, rate, seed)

    def logits_of(checks: list[tuple[np.ndarray, np.ndarray, int]]) -> np.ndarray:
        return np.array([_shares(counts) @ scores[buckets] + bias for buckets, counts, _ in checks], dtype=np.float64).reshape(-1, len(languages) + 1)

    def held_out_rows(noise: bool) -> list[tuple[np.ndarray, np.ndarray, int]]:
        every = [(row, out) for row, out in zip(rows, apart) if (row[2] == len(languages)) == noise]
        return [row for row, out in every if out] or [row for row, _ in every]

    checks = held_out_rows(False)
    short = [list(_thinned(row, seed)) for row in checks]
    logits = logits_of(checks + [row for some in short for row in some])[:, :-1]
    truth = np.array([language for *_, language in checks] + [row[2] for some in short for row in some])

    def loss(temperature: float) -> float:
        chances = softmax(logits / temperature)[np.arange(len(truth)), truth]
        return float(-np.log(np.maximum(chances, 1e-12)).mean())

    temperature = min(np.geomspace(0.05, 20, 60), key=loss)
    own = _lead(logits_of(checks + [row for some in short for row in some[1:]]))
    others = held_out_rows(True)
    alien = _lead(logits_of(others + [row for some in others for row in list(_thinned(some, seed))[1:]]))
    threshold = float(np.quantile(own, 1 - false_rejections))
    if len(alien):
        threshold = max(threshold, (threshold + float(np.quantile(alien, 0.02))) / 2)
    return LanguageModel(languages, bits, scores.astype(np.float32), bias.astype(np.float64), float(temperature), threshold,
                         float((own > threshold).mean()), float((alien > threshold).mean()) if len(alien) else 0.0)


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", *, key: str = "doc_id", sample_rows: int = 2400, most_languages: int = 400,
          bits: int = 16, width: int = 12, epochs: int = 6, rate: float = 1.0, false_rejections: float = 0.001,
          seed: int = 7) -> LanguageModel:
    """Train on at most `sample_rows` different labelled rows, as many of each of the `most_languages` commonest languages.

    Executors turn whole texts into bucket counts (2**bits at most a text), so the
    driver receives a bounded number of bounded rows. They come in FETCHES parts one after another, and the training
    reads the bytes that were received, so that the driver holds the sample once.
    """
    importable(labelled.sparkSession)
    draw = F.xxhash64(F.col(key), F.col(text), F.lit(seed)).alias("draw")
    rows = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"), draw)
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_languages).collect()
    if not sizes:
        return _fit([], [], bits, width, epochs, rate, false_rejections, seed)
    each = max(1, sample_rows // len(sizes))
    # the draws alone, cut to `each` of a language in each of 64 deals, of 8, and of all: no task holds more than eight times `each`
    first = rows.select("lang", "draw").distinct()
    for deals in (64, 8, 1):
        window = Window.partitionBy("lang", F.pmod("draw", F.lit(deals))).orderBy("draw")
        first = first.withColumn("nth", F.row_number().over(window)).filter(F.col("nth") <= each).drop("nth")
    last = first.filter(F.col("lang").isin([row["lang"] for row in sizes])).groupBy("lang").agg(F.max("draw").alias("last"))
    drawn = rows.join(F.broadcast(last), "lang").filter(F.col("draw") <= F.col("last")).groupBy("lang", "draw").agg(F.first("text").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(0)]
            for change in (bytes, garbled):
                found = [bucket_counts(change(value), bits) for value in utf8(batch.column(1))]
                columns += [pa.array([part[i].astype(np.int32).tobytes() for part in found], pa.binary()) for i in range(2)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "buckets", "counts", "noise", "noise_counts"])

    sample = drawn.select("lang", "text").mapInArrow(count, "lang string, buckets binary, counts binary, noise binary, noise_counts binary")
    found = sorted((row[0], *map(bytes, row[1:])) for row in sample.repartition(FETCHES).toLocalIterator())
    numbers = [(label, *[np.frombuffer(part, np.int32) for part in parts]) for label, *parts in found]
    return _fit([(b, c, label) for label, b, c, *_ in numbers], [(b, c) for *_, b, c in numbers], bits, width, epochs, rate, false_rejections, seed)


def _found(model: LanguageModel, docs: DataFrame, text: str) -> Column:
    """A struct of lang_pred, score and rejected. Only the text goes to Python and only the struct comes back."""
    importable(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def label(column: pa.Array) -> pa.Array:
        languages, score, rejected = predict(utf8(column), shared.value)
        return pa.StructArray.from_arrays([pa.array(languages, pa.string()), pa.array(score), pa.array(rejected)], ["lang_pred", "score", "rejected"])

    # taken as not deterministic, so that no filter on the result is moved below it and predicts a second time
    return F.arrow_udf(label, "lang_pred string, score double, rejected boolean").asNondeterministic()(F.col(text))


@own_names
def identify(docs: DataFrame, model: LanguageModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns named in `keep` (default all) with lang_pred, score and rejected."""
    kept = without_columns(docs, "lang_pred", "score", "rejected") if keep is None else keep
    return docs.select(*kept, _found(model, docs, text).alias("__found")).select(*kept, "__found.*")


def held_out(key: str = "doc_id") -> Column:
    return crc32_of_id(key) % FOLDS == HELD_OUT


def predicted_languages(docs: DataFrame) -> DataFrame:
    """Train on the rows outside the held-out fold and predict all rows."""
    model = train(docs.filter(~held_out()).select("doc_id", "text", "lang"))
    return identify(docs.select("doc_id", "text"), model, keep=["doc_id"]).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


@own_names
def keep_identified(docs: DataFrame) -> DataFrame:
    """Rows of `docs`, all columns as they are, whose language is not rejected."""
    model = train(docs.filter(~held_out()).select("doc_id", "text", "lang"))
    return docs.filter(~_found(model, docs, "text")["rejected"])
