"""LM scoring: a bigram model by deleted interpolation, counted over the whole corpus.

    P(w | v) = a_b * c(v, w) / c(v) + b_b * c(w) / N + d_b / (V + 1)

with one set of mixture weights for each bucket b of the context's frequency, floor(log2(c(v) + 1)).

1. Each task turns its texts into chunks of about CHUNK_TOKENS tokens: distinct words as
   64-bit hashes, and the texts as places among them. The chunks are a bucketed table in the
   shared scratch folder. A text longer than a chunk goes on in the next one.
2. A chunk asks for the counts of its distinct words and bigrams: sorted keys with its own
   training counts, in one piece per key range. So a frequent word is one key per chunk, and
   no key is hot. A task that owns a range adds the counts and answers every chunk in the
   order asked.
3. Chunks meet their answers by the bucketing, without moving again. All counts are kept for four folds of the
   corpus apart, by a hash of the whole text, so that equal texts share a fold. In a first pass the counts of a whole
   fold are deleted: what remains are held-out counts for the training tokens of that fold. They go into a histogram of
   a bounded number of cells (bucket, and both likelihood ratios in quarter powers of two), on which
   expectation-maximisation learns the weights. A second pass scores every text with the full counts.
   Neither chunks nor the order of rows or files have a part in counts, weights or scores.

All counts cover all training rows; the driver holds the histogram and the weights. Words and
bigrams are told apart by 64-bit hashes.

Defined cases: a null text counts as empty: one token, its end. A null id is no training
row of fold 1, as crc32 of an empty text is 0. Rows that repeat an id are scored one by
one. Without training rows every word has chance 1 / (V + 1) = 1. Result columns replace
input columns of the same name. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tillframe.llm.common import NOT_SPACE, crc32_of_id, gram_hashes, importable, own_names, stored, utf8, words_of
from tillframe.sources.files import scratch_path

FOLDS, HELD_OUT = 5, 1
CHUNK_TOKENS = 1 << 20
BUCKETS = 48
DELETED_FOLDS = 4
STEPS_PER_POWER = 4
_END = np.uint64(0x9AE16A3B2F90404F)
_NONE = -(1 << 12)


# --- compact columns -------------------------------------------------------------------

def packed(values: np.ndarray) -> bytes:
    """Whole numbers by planes of bytes, compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(data: bytes, kind: type) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], decompressed_size=size, codec="zstd", asbytes=True), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(kind).ravel()


def packed_sorted(keys: np.ndarray) -> bytes:
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, np.uint64), dtype=np.uint64)


# --- chunks ----------------------------------------------------------------------------

@dataclass(frozen=True)
class Chunk:
    """Sorted distinct words (the end included), tokens and contexts as places in them, and each token's part and fold, -1 outside training."""

    words: np.ndarray
    tokens: np.ndarray
    contexts: np.ndarray
    part: np.ndarray
    fold: np.ndarray

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct keys of the bigrams, the pair (context * words + token) of each, and each token's place in them."""
        codes, inverse = np.unique(self.contexts * len(self.words) + self.tokens, return_inverse=True)
        left, right = self.words[codes // len(self.words)], self.words[codes % len(self.words)]
        both = np.empty(2 * len(codes), np.uint64)
        both[0::2], both[1::2] = left, right
        keys = gram_hashes(both, 2)[0::2]
        order = np.argsort(keys, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return keys[order], codes[order], place[inverse]


def _part_column(kind: str) -> str:
    return f"chunk bigint, ids array<{kind}>, rows array<bigint>, trained binary, lengths binary, firsts binary, words binary, tokens binary"


def fold_of(key: str, text: str) -> Column:
    """The deleted fold of a training row, -1 for others."""
    fold = F.pmod(F.xxhash64(F.coalesce(text, F.lit(""))), F.lit(DELETED_FOLDS)).cast("int")
    return F.when(crc32_of_id(key) % FOLDS != HELD_OUT, fold).otherwise(-1)


def _chunks(docs: DataFrame, key: str, text: str, chunk_tokens: int) -> DataFrame:
    """One row for each chunk."""
    names = ["chunk", "ids", "rows", "trained", "lengths", "firsts", "words", "tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        held: list[tuple[object, int, int, np.uint64, np.ndarray]] = []
        size = made = row = 0

        def done() -> pa.RecordBatch:
            words, tokens = np.unique(np.concatenate([[_END], *(part[4] for part in held)]), return_inverse=True)
            firsts = np.array([part[3] for part in held], np.uint64)
            return pa.RecordBatch.from_arrays(
                [pa.array([base + made], pa.int64()), pa.array([[part[0] for part in held]], pa.list_(id_type)),
                 pa.array([[base + part[1] for part in held]], pa.list_(pa.int64())),
                 pa.array([packed(np.array([part[2] for part in held], np.int8))], pa.binary()),
                 pa.array([packed(np.array([len(part[4]) for part in held], np.int64))], pa.binary()),
                 pa.array([packed(firsts)], pa.binary()), pa.array([packed_sorted(words)], pa.binary()),
                 pa.array([packed(tokens[1:].astype(np.uint32))], pa.binary())], names)

        id_type = pa.null()
        for batch in batches:
            id_type = batch.schema.field(0).type
            ids, trained = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, last, hashes, begins in words_of(utf8(batch.column(2)), NOT_SPACE):
                for i in range(first, last):
                    stream = np.append(hashes[begins[i - first]:begins[i - first + 1]], _END)
                    before = _END
                    for start in range(0, len(stream), chunk_tokens):
                        piece = stream[start:start + chunk_tokens]
                        held.append((ids[i], row, trained[i], before, piece))
                        before = piece[-1]
                        size += len(piece)
                        if size >= chunk_tokens:
                            yield done()
                            held, size, made = [], 0, made + 1
                    row += 1
        if held:
            yield done()

    return docs.select(F.col(key).alias("id"), fold_of(key, text).alias("trained"), F.col(text).alias("text")).mapInArrow(
        run, _part_column(docs.schema[key].dataType.simpleString()))


def _open(row: dict) -> Chunk:
    words, tokens = unpacked_sorted(row["words"]), unpacked(row["tokens"], np.uint32).astype(np.int64)
    lengths = unpacked(row["lengths"], np.int64)
    begins = np.cumsum(lengths) - lengths
    part = np.repeat(np.arange(len(lengths)), lengths)
    contexts = np.concatenate(([0], tokens[:-1]))
    # the word before a part may be in no chunk but the last one: then it is put among the words
    firsts = unpacked(row["firsts"], np.uint64)
    if (firsts != _END).any():
        all_words = np.unique(np.concatenate((words, firsts)))
        moved = np.searchsorted(all_words, words)
        words, tokens, contexts = all_words, moved[tokens], moved[contexts]
    contexts[begins] = np.searchsorted(words, firsts)
    return Chunk(words, tokens, contexts, part, unpacked(row["trained"], np.int8)[part])


# --- counts ----------------------------------------------------------------------------

def _ranges(keys: np.ndarray, n: int) -> np.ndarray:
    """Where the keys of each of n equal ranges begin, and the end."""
    edges = [(i << 64) // n for i in range(1, n)]
    return np.concatenate(([0], np.searchsorted(keys, np.array(edges, np.uint64)), [len(keys)]))


def _by_fold(chunk: Chunk, places: np.ndarray, size: int) -> np.ndarray:
    """How often each place is met in training, one row per fold."""
    return np.stack([np.bincount(places[chunk.fold == fold], minlength=size) for fold in range(DELETED_FOLDS)]).astype(np.uint32)


def _requests(chunks: DataFrame, n: int) -> DataFrame:
    """(part, chunk, words, word_counts, pairs, pair_counts): keys of a chunk in each of n ranges, and its own training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = _open(row)
                keys, _, place = chunk.pairs()
                own, own_pairs = _by_fold(chunk, chunk.tokens, len(chunk.words)), _by_fold(chunk, place, len(keys))
                a, b = _ranges(chunk.words, n), _ranges(keys, n)
                columns: list[list] = [[], [], [], []]
                for i in range(n):
                    for column, (values, packing) in zip(columns, (
                            (chunk.words[a[i]:a[i + 1]], packed_sorted), (own[:, a[i]:a[i + 1]].ravel(), packed),
                            (keys[b[i]:b[i + 1]], packed_sorted), (own_pairs[:, b[i]:b[i + 1]].ravel(), packed))):
                        column.append(packing(values))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(n), pa.int32()), pa.array([row["chunk"]] * n, pa.int64()), *[pa.array(c, pa.binary()) for c in columns]],
                    ["part", "chunk", "words", "word_counts", "pairs", "pair_counts"])

    return chunks.mapInArrow(run, "part int, chunk bigint, words binary, word_counts binary, pairs binary, pair_counts binary")


def _added(keys: list[np.ndarray], counts: list[bytes]) -> tuple[list[list[bytes]], int, list[int]]:
    """For each list of keys the packed counts over all lists, fold by fold; the distinct keys that were counted, and each fold's sum."""
    distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    borders = np.cumsum([len(x) for x in keys])[:-1]
    found: list[list[bytes]] = [[] for _ in keys]
    met, sums = np.zeros(len(distinct), bool), []
    for fold in range(DELETED_FOLDS):  # one at a time, which bounds the memory
        own = np.concatenate([unpacked(x, np.uint32).reshape(DELETED_FOLDS, -1)[fold] for x in counts])
        total = np.bincount(inverse, own, minlength=len(distinct)).astype(np.int64)
        met |= total > 0
        sums.append(int(total.sum()))
        for answer, part in zip(found, np.split(total[inverse], borders)):
            answer.append(packed(part))
    return found, int(met.sum()), sums


def _answers(requests: DataFrame, n: int) -> DataFrame:
    """(chunk, part, words, pairs): counts over the corpus by fold, in the order asked; chunk -1 has distinct words and each fold's training tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and row["part"] != held[-1]["part"]:
                    yield done(held)
                    held = []
                held.append(row)
        if held:
            yield done(held)

    def done(held: list[dict]) -> pa.RecordBatch:
        words, distinct, tokens = _added([unpacked_sorted(row["words"]) for row in held], [row["word_counts"] for row in held])
        pairs, *_ = _added([unpacked_sorted(row["pairs"]) for row in held], [row["pair_counts"] for row in held])
        part = held[0]["part"]
        return pa.RecordBatch.from_arrays(
            [pa.array([*[row["chunk"] for row in held], -1], pa.int64()), pa.array([part] * (len(held) + 1), pa.int32()),
             pa.array([*words, None], pa.list_(pa.binary())), pa.array([*pairs, None], pa.list_(pa.binary())),
             pa.array([*[None] * len(held), distinct], pa.int64()), pa.array([*[None] * len(held), tokens], pa.list_(pa.int64()))],
            ["chunk", "part", "words", "pairs", "distinct", "tokens"])

    sent = requests.repartition(n, "part").sortWithinPartitions("part", "chunk")
    return sent.mapInArrow(run, "chunk bigint, part int, words array<binary>, pairs array<binary>, distinct bigint, tokens array<bigint>")


# --- the model -------------------------------------------------------------------------

@dataclass(frozen=True)
class Mixture:
    """Training tokens, distinct training tokens, and per bucket the weights of bigrams, words, and an even share."""

    tokens: int
    distinct: int
    weights: np.ndarray


def bucket(context_counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.floor(np.log2(context_counts + 1.0)).astype(np.int64), BUCKETS - 1)


def expectation_maximisation(buckets: np.ndarray, ratios: np.ndarray, mass: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Weights per bucket for cells of held-out tokens: likelihood of the bigram and the word part over the even share."""
    weights = np.full((BUCKETS, 3), 1 / 3)
    parts = np.column_stack((ratios, np.ones(len(mass))))
    for _ in range(rounds):
        shares = weights[buckets] * parts
        shares *= (mass / shares.sum(axis=1))[:, None]
        sums = np.stack([np.bincount(buckets, shares[:, i], BUCKETS) for i in range(3)], axis=1)
        seen = sums.sum(axis=1) > 0
        new = np.where(seen[:, None], sums / np.maximum(sums.sum(axis=1), 1e-300)[:, None], [0.0, 0.0, 1.0])
        if np.abs(new - weights).max() < 1e-6:
            return new
        weights = new
    return weights


def learned_weights(cells: list[tuple[int, int, int, int]]) -> np.ndarray:
    if not cells:
        return np.tile([0.0, 0.0, 1.0], (BUCKETS, 1))
    found = np.array(sorted(cells), np.int64)
    ratios = np.where(found[:, 1:3] == _NONE, 0.0, 2.0 ** (found[:, 1:3] / STEPS_PER_POWER))
    return expectation_maximisation(found[:, 0], ratios, found[:, 3].astype(float))


def _counts(row: dict, fold: int | None = None) -> list[np.ndarray]:
    """Counts of words and of bigrams over the corpus, or over one fold of it."""
    parts = sorted(row["answers"], key=lambda answer: answer["part"])
    folds = range(DELETED_FOLDS) if fold is None else (fold,)
    return [sum(np.concatenate([unpacked(part[name][i], np.int64) for part in parts]) for i in folds) for name in ("words", "pairs")]


def cells_of(own_pairs: np.ndarray, pairs: np.ndarray, contexts: np.ndarray, words: np.ndarray, tokens: int, distinct: int) -> np.ndarray:
    """Bucket, step of the bigram ratio, step of the word ratio and tokens, from held-out counts of bigrams that the fold has."""
    with np.errstate(divide="ignore", invalid="ignore"):
        two = np.nan_to_num(pairs / contexts) * (distinct + 1)
        one = words / max(1, tokens) * (distinct + 1)
        steps = [np.where(x > 0, np.rint(np.log2(x) * STEPS_PER_POWER), _NONE).astype(np.int64) for x in (two, one)]
    cells, at = np.unique(np.stack((bucket(contexts), *steps)), axis=1, return_inverse=True)
    return np.vstack((cells, np.bincount(at.ravel(), own_pairs, cells.shape[1]).astype(np.int64)))


def _held_out_cells(joined: DataFrame, tokens: list[int], distinct: int) -> list[tuple[int, int, int, int]]:
    """(bucket, step of the bigram ratio, step of the word ratio, training tokens), from counts without the whole fold of the token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = _open(row)
                words, pairs = _counts(row)
                keys, codes, place = chunk.pairs()
                for fold in range(DELETED_FOLDS):
                    own_pairs = np.bincount(place[chunk.fold == fold], minlength=len(pairs))
                    some = np.flatnonzero(own_pairs)
                    left, right = codes[some] // len(words), codes[some] % len(words)
                    deleted_words, deleted_pairs = _counts(row, fold)
                    rest_words = words - deleted_words
                    found = cells_of(own_pairs[some], (pairs - deleted_pairs)[some], rest_words[left], rest_words[right], sum(tokens) - tokens[fold], distinct)
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], ["bucket", "two", "one", "mass"])

    found = joined.mapInArrow(run, "bucket bigint, two bigint, one bigint, mass bigint")
    return [tuple(row) for row in found.groupBy("bucket", "two", "one").agg(F.sum("mass")).collect()]


def _scored(joined: DataFrame, mixture: Mixture, id_kind: str) -> DataFrame:
    """(id, row, n_tokens, n_known, base_score, score) of each part of a text."""
    shared = joined.sparkSession.sparkContext.broadcast(mixture)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        share = 1 / (model.distinct + 1)
        for batch in batches:
            id_type = batch.schema.field("ids").type
            for row in batch.to_pylist():
                chunk = _open(row)
                words, pairs = _counts(row)
                place = chunk.pairs()[2]
                seen, context, both = words[chunk.tokens], words[chunk.contexts], pairs[place]
                n = len(row["rows"])
                base = np.log10((words + 0.5) / (model.tokens + 0.5 * (model.distinct + 1)))
                weights = model.weights[bucket(context)]
                chance = (weights[:, 0] * both / np.maximum(context, 1) + weights[:, 1] * seen / max(1, model.tokens) + weights[:, 2] * share)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["ids"]], id_type).flatten(), pa.array(row["rows"], pa.int64()),
                     pa.array(np.bincount(chunk.part, minlength=n)), pa.array(np.bincount(chunk.part, seen > 0, n).astype(np.int64)),
                     pa.array(np.bincount(chunk.part, base[chunk.tokens], n)), pa.array(np.bincount(chunk.part, np.log10(chance), n))],
                    ["id", "row", "n_tokens", "n_known", "base_score", "score"])

    return joined.mapInArrow(run, f"id {id_kind}, row bigint, n_tokens bigint, n_known bigint, base_score double, score double")


@own_names
def score(docs: DataFrame, *, key: str = "doc_id", text: str = "text", chunk_tokens: int = CHUNK_TOKENS) -> tuple[DataFrame, Mixture]:
    """One row for each row of `docs` (key, n_tokens, n_known, train_tokens, base_score, score), and the learned mixture."""
    spark = docs.sparkSession
    importable(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"chunks_{uuid.uuid4().hex}"
    _chunks(docs, key, text, chunk_tokens).write.bucketBy(parts, "chunk").option("path", scratch_path(spark, "chunks")).saveAsTable(table)
    try:
        chunks = spark.table(table)
        answers = stored(_answers(_requests(chunks, parts), parts), "answers")
        sums = answers.filter("chunk = -1").agg(F.sum("distinct"), *[F.sum(F.get("tokens", F.lit(fold))) for fold in range(DELETED_FOLDS)]).first()
        distinct, *by_fold = [int(x or 0) for x in sums]
        tokens = sum(by_fold)
        by_chunk = answers.filter("chunk >= 0").groupBy("chunk").agg(F.collect_list(F.struct("part", "words", "pairs")).alias("answers"))
        joined = chunks.join(by_chunk, "chunk")
        cells = _held_out_cells(joined, by_fold, distinct)
        mixture = Mixture(tokens, distinct, learned_weights(cells))
        pieces = stored(_scored(joined, mixture, docs.schema[key].dataType.simpleString()), "scores")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    whole = pieces.groupBy("row").agg(F.first("id").alias(key), *[F.sum(name).alias(name) for name in ("n_tokens", "n_known", "base_score", "score")])
    return whole.select(key, "n_tokens", "n_known", F.lit(tokens).cast("bigint").alias("train_tokens"), "base_score", "score"), mixture


def score_report(docs: DataFrame) -> DataFrame:
    found, _ = score(docs)
    return found.select("doc_id", (crc32_of_id("doc_id") % FOLDS == HELD_OUT).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                        "base_score", "score")
