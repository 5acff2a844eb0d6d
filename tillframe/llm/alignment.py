"""Alignment of two tokenizers: groups of tokens between shared cuts, and how often ids end together.

Tokenizer A (byte-level BPE, a `tokenizers` file) reads a space and the text; tokenizer B (a `sentencepiece` model)
reads the text and puts that space before it itself. Both give bytes that must equal space + text. All tokens of
many texts then lie on one line of bytes. Every token points to the farthest-right token that overlaps it,
one of B before one of A where they end together, and successors are doubled until
nothing changes: each token then points to the last token of its component, which is the group between two
shared cuts. Each group has one link, its last A and last B token.

Texts are encoded chunk by chunk, cut before single spaces, where neither tokenizer has a token across; a bounded cache in
each worker holds the ids of chunks it has met.

The links of each text are kept once, as 32-bit codes of id pairs, in a table in the shared scratch folder, so nothing is
encoded twice. Counts of pairs are summed per task before the shuffle. For the way back,
pairs at least as frequent as a threshold, which a histogram of their counts (64 rows) sets so that at most `table_rows`
pass, are broadcast with their counts; the links they leave are summed per text and pair and joined
with the counts by pair. The highest count of each B id is bounded by the vocabulary and broadcast.

Defined cases: null and empty texts, and texts whose tokens give other bytes (B reads U+2581 as a space), have no tokens:
zeros, and an empty groups_sha256. Special tokens in a text are plain text. Ties for the highest count all count as highest. Rows are answered
one by one, repeated or null ids notwithstanding. Long texts are aligned in
pieces that are cut only where both tokenizers cut.
Result columns replace input columns of the same name, whatever their case. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from tillframe.llm.common import map_batches, own_names, stored, without_columns

FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
TABLE_ROWS = 1 << 20
#: Pairs are one number, a * 2**SHIFT + b.
SHIFT = 15
#: Characters of texts, and rows, that are aligned in one go.
RUN, ROWS = 1 << 18, 1 << 9
#: Chunks whose tokens a worker keeps, and those encoded in one call.
CHUNKS, AT_ONCE = 1 << 18, 1 << 11
#: Links that a task sorts at once when it counts pairs.
LINKS = 1 << 20
#: A space beside other white space (U+180E is white space to some), and the places where chunks begin.
_WIDE = re.compile("[\\s\u180e] | [\\s\u180e]")
_CUT = re.compile("(?<=[^\\s\u180e])(?= [^\\s\u180e])")
RESULTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def default_files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(FILE_A), public_tokenizers.path(FILE_B)


def byte_values() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones stand for themselves, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [byte for byte in range(256) if byte not in set(plain)]
    return {chr(byte): byte for byte in plain} | {chr(256 + i): byte for i, byte in enumerate(rest)}


def chunks(text: str) -> list[str]:
    """Space + text in chunks that each begin with a space, which is left out here.

    Neither tokenizer has a token across the start of a chunk: it is a single space between two characters that are no white space.
    """
    if _WIDE.search(text) is None and text[:1] != " " and text[-1:] != " ":
        return text.split(" ")
    return [chunk[1:] for chunk in _CUT.split(" " + text)]


class Pair:
    """Both tokenizers, the bytes of their tokens, and the text of their ids; one per worker process and pair of files."""

    _open: dict[tuple[str, str], Pair] = {}

    def __init__(self, file_a: str, file_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(file_a), sentencepiece.SentencePieceProcessor(model_file=file_b)
        self.a.encode_special_tokens = True
        values = byte_values()
        entries = json.loads(self.a.to_str())["model"]["vocab"]
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for entry, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(map(values.__getitem__, entry)) if entry in entries and all(c in values for c in entry) else entry.encode()
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
            self.bytes_b.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
        if len(self.bytes_b) > 1 << SHIFT or len(self.bytes_a) > 1 << 31 - SHIFT:
            raise ValueError("a vocabulary is too large for pairs of 31 bits")
        if not all(self.bytes_a) or not all(self.bytes_b):
            raise ValueError("a vocabulary has an entry without bytes")
        self.length_a, self.length_b = (np.array([len(x) for x in table], np.int64) for table in (self.bytes_a, self.bytes_b))
        # the text of an id with what follows it: "," inside a side; "|" between the sides, ";" between groups
        self.forget()
        self.written = [f"{i}{end}" for size, end in ((len(self.bytes_a), ","), (len(self.bytes_a), "|"),
                                                      (len(self.bytes_b), ","), (len(self.bytes_b), ";")) for i in range(size)]

    @classmethod
    def at(cls, files: tuple[str, str]) -> Pair:
        if files not in cls._open:
            cls._open[files] = cls(*files)
        return cls._open[files]

    def forget(self) -> None:
        """Start the cache of chunks anew: their places, and ids of both sides one after the other."""
        self.place: dict[str, int] = {}
        self.ids = [np.empty(0, np.int32), np.empty(0, np.int32)]
        self.ends = [np.zeros(1, np.int64), np.zeros(1, np.int64)]
        self.faithful = np.empty(0, bool)

    def learn(self, keys: list[str]) -> None:
        """Encode the chunks that the cache lacks."""
        new = [key for key in dict.fromkeys(keys) if key not in self.place]
        if len(self.place) + len(new) > CHUNKS or len(self.ids[0]) > 4 * CHUNKS:
            self.forget()
            new = list(dict.fromkeys(keys))
        if not new:
            return
        sides, sizes, same = (array("i"), array("i")), ([], []), []
        for first in range(0, len(new), AT_ONCE):
            some = new[first:first + AT_ONCE]
            of_a = self.a.encode_batch_fast([" " + key for key in some], add_special_tokens=False)
            for key, x, b in zip(some, of_a, self.b.encode(some, num_threads=1)):
                a = x.ids
                same.append(self.spelled(a, b, b" " + key.encode()))
                for side, size, found in zip(sides, sizes, (a, b)):
                    side.extend(found)
                    size.append(len(found))
        for i in (0, 1):
            self.ids[i] = np.concatenate([self.ids[i], np.frombuffer(sides[i], np.int32)])
            self.ends[i] = np.concatenate([self.ends[i], self.ends[i][-1] + np.cumsum(sizes[i])])
        self.faithful = np.append(self.faithful, same)
        first = len(self.place)
        self.place.update((key, first + i) for i, key in enumerate(new))

    def spelled(self, a: list[int], b: list[int], whole: bytes) -> bool:
        return b"".join(map(self.bytes_a.__getitem__, a)) == whole and b"".join(map(self.bytes_b.__getitem__, b)) == whole

    def encode(self, pieces: list[list[str]]) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray], np.ndarray]:
        """For lists of chunks: ids of A and how many for each list, the same of B, and whether all bytes are those of the chunks."""
        keys = list(chain.from_iterable(pieces))
        self.learn(keys)
        at = np.fromiter(map(self.place.__getitem__, keys), np.int64, len(keys))
        bounds = np.cumsum([0, *map(len, pieces)])
        sides = []
        for ids, ends in zip(self.ids, self.ends):
            sizes = ends[at + 1] - ends[at]
            until = np.cumsum(sizes)
            flat = ids[np.repeat(ends[at] - until + sizes, sizes) + np.arange(until[-1] if len(until) else 0)]
            sides.append((flat, np.diff(np.append(0, until)[bounds])))
        wrong = np.append(0, np.cumsum(~self.faithful[at]))
        return *sides, np.diff(wrong[bounds]) == 0


def terminal_tokens(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token of A and of B: the B token (by place) that ends its group. Both lines of tokens cover the same bytes.

    Tokens of A are numbered first, then those of B. Each points to the farthest-right token that overlaps it.
    """
    n = len(ends_a)
    over_a = np.searchsorted(ends_b, ends_a)  # the B token that holds the last byte of each A token
    over_b = np.searchsorted(ends_a, ends_b)
    own = n + np.arange(len(ends_b))
    successor = np.concatenate([n + over_a, np.where(ends_a[over_b] > ends_b, over_b, own)])
    while True:
        doubled = successor[successor]
        if np.array_equal(doubled, successor):
            return successor[:n] - n, successor[n:] - n
        successor = doubled


def aligned(pair: Pair, pieces: list[list[str]]) -> list[tuple[int, int, str, np.ndarray] | None]:
    """(n_a, n_b, groups as text, links) of each list of chunks, all on one line of bytes; None where bytes differ."""
    (a, counts_a), (b, counts_b), same = pair.encode(pieces)
    if not same.all():  # leave out what is not on the line
        right = iter(aligned(pair, [piece for piece, good in zip(pieces, same) if good]))
        return [next(right) if good else None for good in same]
    if not len(a):
        return []
    ends_a, ends_b = np.cumsum(pair.length_a[a]), np.cumsum(pair.length_b[b])
    of_a, of_b = terminal_tokens(ends_a, ends_b)
    last_b = np.flatnonzero(of_b == np.arange(len(b)))  # the B tokens that end groups, in order: one link each
    last_a = np.searchsorted(of_a, last_b, "right") - 1
    links = (a[last_a] << SHIFT | b[last_b]).astype(np.int32)
    group_a, group_b = np.searchsorted(last_b, of_a), np.searchsorted(last_b, of_b)
    size_a, size_b = len(pair.bytes_a), len(pair.bytes_b)
    code_a, code_b = a.copy(), b + 2 * size_a
    code_a[last_a] += size_a
    code_b[last_b] += size_b
    order = np.empty(len(a) + len(b), np.int64)
    groups = np.arange(len(last_b))
    before_b, until_a = np.searchsorted(group_b, groups), np.searchsorted(group_a, groups, "right")
    order[np.arange(len(a)) + before_b[group_a]] = code_a
    order[np.arange(len(b)) + until_a[group_b]] = code_b
    first_a, first_b = (np.cumsum(np.append(0, counts)) for counts in (counts_a, counts_b))
    groups_at = np.searchsorted(last_b, first_b)
    return [(int(counts_a[i]), int(counts_b[i]),
             "".join(map(pair.written.__getitem__, order[first_a[i] + first_b[i]:first_a[i + 1] + first_b[i + 1]].tolist())),
             links[groups_at[i]:groups_at[i + 1]]) for i in range(len(pieces))]


class Alignment:
    """The result of one text, from those of its pieces."""

    def __init__(self):
        self.n_a = self.n_b = 0
        self.hash, self.last, self.links, self.whole = hashlib.sha256(), "", [], True

    def add(self, found: tuple[int, int, str, np.ndarray] | None) -> None:
        if found is None:
            self.whole = False
        if not self.whole:
            self.links = []
            return
        self.n_a, self.n_b = self.n_a + found[0], self.n_b + found[1]
        self.hash.update((self.last + found[2][:-1]).encode())  # without the mark after the last group
        self.last = found[2][-1]
        self.links.append(found[3])

    def result(self) -> tuple[int, int, str, np.ndarray]:
        if not self.whole or not self.links:
            return 0, 0, "", np.empty(0, np.int32)
        return self.n_a, self.n_b, self.hash.hexdigest(), np.concatenate(self.links)


def align_texts(pair: Pair, texts: Iterable[str]) -> Iterator[tuple[int, int, str, np.ndarray]]:
    """(n_a, n_b, groups_sha256, links) of each text. Texts are aligned together in runs of about RUN characters, long ones in pieces."""
    run: list[tuple[Alignment, list[str]]] = []
    waiting, size = [], 0

    def flush() -> None:
        for (alignment, _), found in zip(run, aligned(pair, [piece for _, piece in run])):
            alignment.add(found)
        run.clear()

    for text in texts:
        now, piece = Alignment(), []
        waiting.append(now)
        for key in chunks(text) if text else ():
            piece.append(key)
            size += len(key) + 1
            if size >= RUN:
                run.append((now, piece))
                flush()
                piece, size = [], 0
        if piece:
            run.append((now, piece))
        if not run:
            yield from (x.result() for x in waiting)
            waiting = []
    flush()
    yield from (x.result() for x in waiting)


def _list_of(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int32), *arrays]), pa.int32()))


def alignments(docs: DataFrame, files: tuple[str, str] | None = None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (default all) with n_a, n_b, n_groups, groups_sha256, and `links`: the id pairs of each text as numbers."""
    files = files or default_files()
    kept = without_columns(docs, *RESULTS, "links") if keep is None else list(keep)
    columns = [*kept, *[name for name in (text,) if name not in kept]]
    schema = StructType([docs.schema[name] for name in kept]).add("n_a", LongType()).add("n_b", LongType()).add("n_groups", LongType()).add(
        "groups_sha256", StringType()).add("links", ArrayType(IntegerType()))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair.at(files)
        for rows in _slices(batches, ROWS):
            n_a, n_b, digests, links = zip(*align_texts(pair, (value or "" for value in rows.column(columns.index(text)).to_pylist())))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[:len(kept)], *[pa.array(x, pa.int64()) for x in (n_a, n_b, [len(x) for x in links])],
                 pa.array(digests, pa.string()), _list_of(links)], schema.names)

    return map_batches(docs.select(*[docs[f"`{name}`"] for name in columns]), align, schema)


def _slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, len(batch), rows):
            yield batch.slice(first, rows)


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, n): how many links hold each id pair, from a column `links`; summed in the tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, waiting, size = np.empty(0, np.int32), np.empty(0, np.int64), [], 0
        out = ["pair", "n"]

        def merged() -> tuple[np.ndarray, np.ndarray]:
            new, n = np.unique(np.concatenate([np.empty(0, np.int32), *waiting]), return_counts=True)
            both, where = np.unique(np.concatenate([pairs, new]), return_inverse=True)
            return both, np.bincount(where, np.concatenate([counts, n]), len(both)).astype(np.int64)

        for batch in _slices(batches, ROWS):
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            waiting.append(values)
            size += len(values)
            if size >= LINKS:
                pairs, counts = merged()
                waiting, size = [], 0
            if len(pairs) >= LINKS:
                yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], out)
                pairs, counts = pairs[:0], counts[:0]
        pairs, counts = merged()
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], out)

    return map_batches(links.select("links"), count, "pair int, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


def frequent_from(counts: DataFrame, table_rows: int) -> int:
    """The smallest power of two that at most `table_rows` pairs reach."""
    histogram = sorted(counts.groupBy(F.floor(F.log2("n")).alias("power")).count().collect(), reverse=True)
    taken, power = 0, 62
    for found, n in histogram:
        if taken + n > table_rows:
            break
        taken, power = taken + n, int(found)
    return 1 << power


def with_pair_counts(found: DataFrame, table_rows: int = TABLE_ROWS) -> DataFrame:
    """`found`, as `alignments` gives it, with n_links, n_best and count_sum in place of `links`."""
    spark = found.sparkSession
    found = stored(found.withColumn("__row", F.monotonically_increasing_id()), "alignments")
    counts = stored(pair_counts(found), "pair-counts")
    best = np.zeros(1 << SHIFT, np.int64)  # the highest count of each B id
    for b, n in counts.groupBy((F.col("pair") % (1 << SHIFT)).alias("b")).agg(F.max("n")).collect():
        best[b] = n
    least = frequent_from(counts, table_rows)
    table = counts.filter(F.col("n") >= least).toArrow()
    pairs, numbers = (table.column(name).to_numpy() for name in ("pair", "n"))
    order = np.argsort(pairs)
    shared = spark.sparkContext.broadcast((pairs[order], numbers[order], best))
    kept = [name for name in found.columns if name != "links"]
    schema = StructType([found.schema[name] for name in kept]).add("n_links", LongType()).add("n_best", LongType()).add(
        "count_sum", LongType()).add("rare", ArrayType(IntegerType()))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, numbers, best = shared.value
        for batch in _slices(batches, ROWS):
            lists = batch.column(len(kept))
            sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
            links = lists.flatten().to_numpy(zero_copy_only=False)
            of = np.repeat(np.arange(len(sizes)), sizes)
            at = np.minimum(np.searchsorted(pairs, links), max(0, len(pairs) - 1))
            known = pairs[at] == links if len(pairs) else np.zeros(len(links), bool)
            n = np.where(known, numbers[at], 0) if len(pairs) else np.zeros(len(links), np.int64)
            highest = known & (n == best[links & (1 << SHIFT) - 1])
            total = np.zeros(len(sizes), np.int64)
            np.add.at(total, of, n)
            rare = np.bincount(of[~known], minlength=len(sizes))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(kept)], pa.array(sizes), pa.array(np.bincount(of[highest], minlength=len(sizes)).astype(np.int64)),
                 pa.array(total), _list_of(np.split(links[~known], np.cumsum(rare)[:-1]) if len(sizes) else [])], schema.names)

    met = map_batches(found.select(*kept, "links"), look_up, schema)
    if counts.filter(F.col("n") < least).isEmpty():
        return met.drop("__row", "rare")
    met = stored(met, "alignments-met")
    few = met.select("__row", F.explode("rare").alias("pair")).groupBy("__row", "pair").agg(F.count(F.lit(1)).alias("times"))
    others = counts.filter(F.col("n") < least).withColumn("b", F.col("pair") % (1 << SHIFT))
    highest = counts.groupBy((F.col("pair") % (1 << SHIFT)).alias("b")).agg(F.max("n").alias("highest"))
    others = others.join(F.broadcast(highest), "b").select("pair", "n", (F.col("n") == F.col("highest")).alias("is_best"))
    rest = few.join(others, "pair").groupBy("__row").agg(
        F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("__best"), F.sum(F.col("times") * F.col("n")).alias("__sum"))
    return met.drop("rare").join(rest, "__row", "left").withColumns({
        "n_best": F.col("n_best") + F.coalesce("__best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("__sum", F.lit(0))}).drop(
        "__row", "__best", "__sum")


@own_names
def align_tokenizers(docs: DataFrame, files: tuple[str, str] | None = None, text: str = "text", keep: list[str] | None = None,
                     table_rows: int = TABLE_ROWS) -> DataFrame:
    """The columns `keep` (default all) with the seven result columns."""
    return with_pair_counts(alignments(docs, files, text, keep), table_rows)


def alignment_report(docs: DataFrame) -> DataFrame:
    return align_tokenizers(docs.select("doc_id", "text"), keep=["doc_id"]).select("doc_id", *RESULTS)
