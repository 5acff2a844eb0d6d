"""Token counts by a two-tier lookup in the map tasks.

A text is cut into pre-tokens where the tokenizer can never join across: before a run of
spaces and before each newline (`Pieces` proves this from the vocabulary, or raises). The
lengths of frequent pre-tokens come from one broadcast table of at most `table_rows`
short entries, filled from about `sample_rows` documents; it decides speed, not results.
What it lacks is encoded by the library, once per worker: each Python worker process keeps
a bounded cache between its tasks. No pre-token is shuffled.

Defined cases: a null text counts as empty, and an empty text has no tokens. Nulls in other
columns, repeated rows and ties change nothing. Result columns replace input columns of the
same name. An empty table gives an empty result. Texts are never cut short.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from tillframe.llm.common import importable, own_names, without_columns

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
SAMPLE_ROWS, TABLE_ROWS = 2_000, 50_000
#: Pre-tokens longer than this are neither in the table nor kept in a cache.
LONGEST_KEPT = 40
CACHE_ROWS = 400_000
_SPACE_PIECE = "▁"
_PRE_TOKEN = re.compile(r"(?: +|\n)[^ \n]*")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def pre_tokens(text: str) -> list[str]:
    """The text, with the space that the tokenizer puts before it, in parts that are encoded apart."""
    return _PRE_TOKEN.findall(" " + text.replace(_SPACE_PIECE, " ")) if text else []


class Pieces:
    """Ids of pre-tokens by a sentencepiece model, with a bounded cache; one per worker process and path."""

    _open: dict[str, Pieces] = {}

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(_SPACE_PIECE in piece.lstrip(_SPACE_PIECE) or "\n" in piece for piece in pieces):
            raise ValueError("this vocabulary has pieces that reach over a space or a newline")
        if self.model.encode("a\tb  c") != [*self.model.encode("a\tb"), *self.model.encode(" c")]:
            raise ValueError("this model changes white space before it encodes")
        self.space = self.model.piece_to_id(_SPACE_PIECE)
        self.end = self.model.eos_id()
        self.size = len(pieces)
        self.known: dict[str, bytes] = {}

    @classmethod
    def at(cls, path: str) -> Pieces:
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def ids(self, pre_token: str) -> list[int]:
        if pre_token[0] == "\n":
            return self.model.encode(pre_token)[1:]  # without the space put before it
        return self.model.encode(pre_token[1:]) if len(pre_token) > 1 else [self.space]

    def packed(self, pre_token: str) -> bytes:
        """Ids as 32-bit numbers, from the cache where it has them."""
        found = self.known.get(pre_token)
        if found is None:
            found = np.array(self.ids(pre_token), np.uint32).tobytes()
            if len(pre_token) <= LONGEST_KEPT:
                if len(self.known) >= CACHE_ROWS:
                    self.known.clear()
                self.known[pre_token] = found
        return found


class Lengths(dict):
    """Tokens of a pre-token: the broadcast table first, then the worker's cache."""

    def __init__(self, table: dict[str, int], pieces: Pieces):
        super().__init__(table)
        self.pieces = pieces

    def __missing__(self, pre_token: str) -> int:
        return len(self.pieces.packed(pre_token)) // 4


def count_tokens(text: str, lengths: Lengths) -> int:
    return sum(map(lengths.__getitem__, pre_tokens(text)))


def frequent_lengths(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", sample_rows: int = SAMPLE_ROWS,
                     table_rows: int = TABLE_ROWS) -> dict[str, int]:
    """Pre-tokens that are most frequent in a sample of about `sample_rows` rows, drawn by a hash of the key."""
    importable(docs.sparkSession)
    draw = F.pmod(F.xxhash64(F.col(key), F.lit(5)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = docs.filter(F.col(text).isNotNull() & (draw < min(1.0, sample_rows / max(1, docs.count())))).select(text)

    def most(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for value in batch.column(0).to_pylist():
                counts.update(pre_tokens(value))
        pieces = Pieces.at(path)
        best = sorted((x for x in counts.items() if x[1] > 1 and len(x[0]) <= LONGEST_KEPT), key=lambda x: (-x[1], x[0]))[:table_rows]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in best], pa.string()),
                                          pa.array([len(pieces.ids(x)) for x, _ in best], pa.int64())], ["pre_token", "n"])

    return {row.pre_token: row.n for row in sample.repartition(1).mapInArrow(most, "pre_token string, n bigint").collect()}


@own_names
def with_token_counts(docs: DataFrame, path: str | None = None, *, text: str = "text", key: str = "doc_id", limit: int = LIMIT,
                      keep: list[str] | None = None, table: dict[str, int] | None = None) -> DataFrame:
    """The columns `keep` (default all) with n_bytes, n_tokens and over_limit."""
    path = path or default_model()
    importable(docs.sparkSession)
    kept = without_columns(docs, "n_bytes", "n_tokens", "over_limit") if keep is None else keep
    columns = list(dict.fromkeys([*kept, text]))
    table = frequent_lengths(docs, path, text, key) if table is None else table
    shared = docs.sparkSession.sparkContext.broadcast(table)
    schema = StructType([*[docs.schema[name] for name in kept], StructField("n_bytes", LongType()),
                         StructField("n_tokens", LongType()), StructField("over_limit", BooleanType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = Lengths(shared.value, Pieces.at(path))
        for batch in batches:
            column = batch.column(columns.index(text))
            tokens = [count_tokens(value or "", lengths) for value in column.to_pylist()]
            sizes = [len(value or b"") for value in column.cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(columns.index(name)) for name in kept], pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array([n > limit for n in tokens], pa.bool_())], schema.names)

    return docs.select(*columns).mapInArrow(count, schema)


def token_report(docs: DataFrame) -> DataFrame:
    return with_token_counts(docs.select("doc_id", "text"), keep=["doc_id"])
