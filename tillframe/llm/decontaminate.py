"""Benchmark decontamination by an FM-index per training shard.

A shard is a run of documents within one task, about SHARD_WORDS words. Its words become
symbols: words of the benchmark by number, and every gap of other words, as well as every
border between documents, one separator; a smallest symbol ends it. The shard's suffix array gives its
Burrows-Wheeler transform, held as a wavelet matrix with ranks; every SAMPLE-th text
position of the suffix array is kept. All test phrases are searched backward at once;
rows of the suffix array that match walk back to a sampled position, which gives the word
where the phrase occurs. Occurrences are merged to spans of words per document.

No text is cut and nothing is shuffled. The phrases are broadcast: their size is that of the
benchmark and is checked against `max_phrase_bytes`; a larger benchmark must be given in
parts. Words are compared by 64-bit hashes.

Defined cases: null and empty texts have no words and no hits; an item without words has
no phrase and occurs nowhere; items that repeat an id or a text all count, each distinct id
once; a null item_id is ignored. Documents that repeat are answered row by row. Result
columns replace input columns of the same name. An empty benchmark hits nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from tillframe.llm.common import LETTERS, importable, own_names, utf8, without_columns, words_of

WINDOW = 10
SHARD_WORDS = 1 << 20
SAMPLE = 16
MAX_PHRASE_BYTES = 256 << 20
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


# --- the index -------------------------------------------------------------------------

def suffix_array(symbols: np.ndarray, bits: int) -> np.ndarray:
    """Order of all suffixes of `symbols` (each below 2**bits), by prefix doubling.

    The first order is by as many symbols as fit 62 bits; later rounds sort only the
    suffixes that are still tied. The end of the text counts as smaller than any symbol.
    """
    n = len(symbols)
    wide = symbols.astype(np.int64) + 1
    bits += 1
    depth = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for i in range(depth):
        key <<= bits
        key[:max(0, n - i)] |= wide[i:]
    order = np.argsort(key)
    ordered = key[order]
    rank = np.empty(n, np.int64)
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    sizes = np.diff(np.append(starts, n))
    rank[order] = np.repeat(starts, sizes)
    tied = np.flatnonzero(np.repeat(sizes > 1, sizes))
    while len(tied):
        suffixes = order[tied]
        after = suffixes + depth
        second = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        first = rank[suffixes]
        by = np.argsort(first * (n + 1) + second, kind="stable")
        suffixes, first, second = suffixes[by], first[by], second[by]
        order[tied] = suffixes
        new = np.concatenate(([True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])))
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(tied)))
        rank[suffixes] = np.repeat(tied[starts], sizes)
        tied = tied[np.repeat(sizes > 1, sizes)]
        depth *= 2
    return order


class WaveletRanks:
    """Ranks and single symbols of a sequence, one bit level at a time, for many places at once."""

    def __init__(self, values: np.ndarray, bits: int):
        self.zeros, self.bits = [], bits
        for level in reversed(range(bits)):
            bit = (values >> level) & 1
            self.zeros.append(np.concatenate(([0], np.cumsum(bit == 0))).astype(np.int32))
            values = np.concatenate((values[bit == 0], values[bit == 1]))

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before the place beside it."""
        low, high = np.zeros(len(symbols), np.int64), places.astype(np.int64)
        for level, zeros in zip(reversed(range(self.bits)), self.zeros):
            one = ((symbols >> level) & 1).astype(bool)
            before_low, before_high = zeros[low], zeros[high]
            low = np.where(one, zeros[-1] + low - before_low, before_low)
            high = np.where(one, zeros[-1] + high - before_high, before_high)
        return high - low

    def at(self, places: np.ndarray) -> np.ndarray:
        symbols, places = np.zeros(len(places), np.int64), places.astype(np.int64)
        for zeros in self.zeros:
            one = zeros[places + 1] == zeros[places]
            places = np.where(one, zeros[-1] + places - zeros[places], zeros[places])
            symbols = symbols * 2 + one
        return symbols


class FMIndex:
    """Backward search and location in a sequence of symbols that ends with its only 0."""

    def __init__(self, symbols: np.ndarray, bits: int):
        order = suffix_array(symbols, bits)
        self.ranks = WaveletRanks(symbols[order - 1], bits)
        counts = np.bincount(symbols, minlength=1 << bits)
        self.begins = np.cumsum(counts) - counts
        self.counts = counts
        self.marked = order % SAMPLE == 0
        self.before = np.cumsum(self.marked) - self.marked
        self.samples = order[self.marked]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last (exclusive) row of each phrase; phrases are right-aligned."""
        width = phrases.shape[1]
        low, high = np.zeros(len(phrases), np.int64), np.zeros(len(phrases), np.int64)
        last = phrases[:, -1]
        low[:], high[:] = self.begins[last], self.begins[last] + self.counts[last]
        live = np.flatnonzero(high > low)
        for step in range(1, width):
            moving = live[lengths[live] > step]
            if not len(moving):
                break
            symbols = phrases[moving, width - 1 - step]
            low[moving] = self.begins[symbols] + self.ranks.rank(symbols, low[moving])
            high[moving] = self.begins[symbols] + self.ranks.rank(symbols, high[moving])
            live = live[high[live] > low[live]]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row: steps back to a sampled one, and the steps taken."""
        found, rows, steps = np.empty(len(rows), np.int64), rows.copy(), 0
        waiting = np.arange(len(rows))
        while len(waiting):
            there = self.marked[rows]
            found[waiting[there]] = self.samples[self.before[rows[there]]] + steps
            waiting, rows = waiting[~there], rows[~there]
            symbols = self.ranks.at(rows)
            rows = self.begins[symbols] + self.ranks.rank(symbols, rows)
            steps += 1
        return found


# --- test phrases ----------------------------------------------------------------------

@dataclass(frozen=True)
class Phrases:
    """Distinct windows as numbered words, and the items of each window."""

    vocabulary: np.ndarray
    bits: int
    windows: np.ndarray
    lengths: np.ndarray
    items: list[list[str]]


def phrases(items: list[tuple[object, bytes]], window: int = WINDOW) -> Phrases:
    found: dict[bytes, set[str]] = {}
    texts = [text for _, text in items]
    for first, last, hashes, begins in words_of(texts, LETTERS):
        for (item, _), a, b in zip(items[first:last], begins[:-1], begins[1:]):
            for start in range(a, max(a + 1, b - window + 1)) if b > a else ():
                found.setdefault(hashes[start:min(start + window, b)].tobytes(), set()).add(str(item))
    keys = [np.frombuffer(key, np.uint64) for key in found]
    vocabulary = np.unique(np.concatenate(keys)) if keys else np.empty(0, np.uint64)
    windows = np.zeros((len(keys), window), np.int64)
    for row, key in zip(windows, keys):
        row[window - len(key):] = np.searchsorted(vocabulary, key) + 2
    return Phrases(vocabulary, (len(vocabulary) + 1).bit_length(), windows, np.array([len(key) for key in keys], np.int64),
                   [sorted(value) for value in found.values()])


def occurrences(hashes: np.ndarray, begins: np.ndarray, tests: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(window, first word) of all occurrences in a shard: word hashes, and each text's first word with the end."""
    if not len(tests.windows) or not len(hashes):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(tests.vocabulary, hashes), len(tests.vocabulary) - 1)
    symbols = np.where(tests.vocabulary[at] == hashes, at + 2, 1)
    borders = begins[1:]
    symbols = np.insert(symbols, borders, 1)
    words = np.insert(np.arange(len(hashes)), borders, -1)
    keep = symbols != 1
    keep |= np.concatenate(([False], keep[:-1]))
    symbols, words = np.append(symbols[keep], 0), words[keep]
    index = FMIndex(symbols, tests.bits)
    low, high = index.search(tests.windows, tests.lengths)
    sizes = np.maximum(high - low, 0)
    which = np.repeat(np.arange(len(sizes)), sizes)
    rows = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[which]
    return which, words[index.locate(rows)]


def scan_shard(hashes: np.ndarray, begins: np.ndarray, tests: Phrases) -> list[tuple[int, int, list[str], list[tuple[int, int]]]]:
    """(words, words hit, items, merged spans of words) of each text of a shard."""
    which, words = occurrences(hashes, begins, tests)
    out = [(int(n), 0, [], []) for n in np.diff(begins)]
    if not len(which):
        return out
    order = np.argsort(words, kind="stable")
    which, words = which[order], words[order]
    reach = np.maximum.accumulate(words + tests.lengths[which])
    owner = np.searchsorted(begins, words, side="right") - 1
    # a span opens where nothing before it, in its text, reaches it
    opens = np.concatenate(([True], (words[1:] > reach[:-1]) | (owner[1:] != owner[:-1])))
    first = np.flatnonzero(opens)
    starts, ends, texts = words[first], reach[np.append(first[1:], len(words)) - 1], owner[first]
    borders = np.flatnonzero(np.concatenate(([True], texts[1:] != texts[:-1], [True])))
    edges = np.append(first, len(words))[borders]
    for a, b, low, high in zip(borders[:-1], borders[1:], edges[:-1], edges[1:]):
        text = int(texts[a])
        base = int(begins[text])
        items = sorted({item for window in set(which[low:high].tolist()) for item in tests.items[window]})
        spans = list(zip((starts[a:b] - base).tolist(), (ends[a:b] - base).tolist()))
        out[text] = (out[text][0], int((ends[a:b] - starts[a:b]).sum()), items, spans)
    return out


def _shards(texts: list[bytes]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Texts with their word hashes, in runs of about SHARD_WORDS words."""
    held: list[np.ndarray] = []
    borders, first, size = [0], 0, 0
    for start, last, hashes, begins in words_of(texts, LETTERS):
        if size and size + len(hashes) > SHARD_WORDS:
            yield first, start, np.concatenate(held), np.array(borders)
            held, borders, first, size = [], [0], start, 0
        held.append(hashes)
        borders += (begins[1:] + size).tolist()
        size += len(hashes)
    if held:
        yield first, len(texts), np.concatenate(held), np.array(borders)


# --- the operator ----------------------------------------------------------------------

FOUND = StructType([StructField("n_words", LongType()), StructField("n_hit", LongType()),
                    StructField("items", ArrayType(StringType())),
                    StructField("spans", ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())])))])
_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])


def _tests(docs: DataFrame, benchmark: DataFrame, item: str, text: str, window: int, max_phrase_bytes: int):
    rows = benchmark.filter(F.col(item).isNotNull() & F.col(text).isNotNull())
    size = rows.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    if size > max_phrase_bytes:
        raise ValueError(f"the benchmark has {size} bytes of text, over {max_phrase_bytes}; give it in parts")
    items = sorted((row[0], row[1].encode()) for row in rows.select(F.col(item), F.col(text)).collect())
    return docs.sparkSession.sparkContext.broadcast(phrases(items, window))


def _scan(docs: DataFrame, tests, text: str, kept: list[str], clean) -> DataFrame:
    """The kept columns with FOUND's; `clean` turns (text, tests, result) into the text to keep, or is None."""
    importable(docs.sparkSession)
    columns = list(dict.fromkeys([*kept, text]))
    schema = StructType([*[docs.schema[name] for name in kept], *FOUND.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= 6 * SHARD_WORDS:
                yield from done(held)
                held, size = [], 0
        if held:
            yield from done(held)

    def done(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        texts = utf8(table.column(columns.index(text)).combine_chunks() if table.num_rows else pa.array([], pa.string()))
        for first, last, hashes, begins in _shards(texts):
            found = scan_shard(hashes, begins, tests.value)
            part = table.slice(first, last - first)
            arrays = {name: part.column(columns.index(name)).combine_chunks() for name in kept}
            if clean and any(row[1] for row in found):
                arrays[text] = pa.array([
                    clean(body, tests.value, row[3]).decode() if row[1] else value
                    for body, value, row in zip(texts[first:last], arrays[text].to_pylist(), found)], pa.string())
            yield pa.RecordBatch.from_arrays(
                [*arrays.values(), pa.array([row[0] for row in found], pa.int64()), pa.array([row[1] for row in found], pa.int64()),
                 pa.array([row[2] for row in found], pa.list_(pa.string())),
                 pa.array([[{"start": a, "end": b} for a, b in row[3]] for row in found], pa.list_(_SPAN))], schema.names)

    return docs.select(*columns).mapInArrow(run, schema)


@own_names
def find_contamination(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", keep: list[str] | None = None,
                       item: str = "item_id", item_text: str = "text", window: int = WINDOW,
                       max_phrase_bytes: int = MAX_PHRASE_BYTES) -> DataFrame:
    """The columns `keep` (default all) with n_words, n_hit, items (sorted as text) and merged spans of words."""
    kept = without_columns(docs, *FOUND.names) if keep is None else keep
    return _scan(docs, _tests(docs, benchmark, item, item_text, window, max_phrase_bytes), text, kept, None)


def cut_spans(text: bytes, tests: Phrases, spans: list[tuple[int, int]]) -> bytes:
    """The text without the spans; again while joining what is left makes a new occurrence."""
    while spans:
        words = [match.span() for match in _WORD.finditer(text.translate(LETTERS.fold.tobytes()))]
        parts, at = [], 0
        for start, end in spans:
            parts.append(text[at:words[start][0]])
            at = words[end - 1][1]
        text = b"".join([*parts, text[at:]])
        hashes = [x[2] for x in words_of([text], LETTERS)][0]
        spans = scan_shard(hashes, np.array([0, len(hashes)]), tests)[0][3]
    return text


@own_names
def remove_contamination(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", length: str | None = "n_chars",
                         item: str = "item_id", item_text: str = "text", window: int = WINDOW,
                         max_phrase_bytes: int = MAX_PHRASE_BYTES) -> DataFrame:
    """The rows of `docs` with all spans cut from the text and the column `length` brought in line.

    Rows that lose all their words go; rows without a hit stay exactly as they are,
    whatever their columns are called.
    """
    tests = _tests(docs, benchmark, item, item_text, window, max_phrase_bytes)
    rows = docs.select(F.struct(*docs.columns).alias("__row"), F.col(text).alias("__text"))
    found = _scan(rows, tests, "__text", ["__row", "__text"], cut_spans)
    hit = F.col("n_hit") > 0
    wordless = ~F.regexp_like("__text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"))
    changed = {text: F.col("__text")}
    if length in docs.columns:
        changed[length] = F.when(hit, F.length("__text")).otherwise(F.col("__row")[length]).cast(docs.schema[length].dataType)
    return found.filter(~(hit & wordless)).select(*[changed.get(name, F.col("__row")[name]).alias(name) for name in docs.columns])


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = find_contamination(docs.select("doc_id", "text"), benchmark, keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
