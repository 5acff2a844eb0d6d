"""What the operators share: reading tables, scratch tables, and words of whole texts as 64-bit hashes.

Words are found on the UTF-8 bytes of many texts at once. Both word classes in use
contain every byte from 0x80 on, so splitting bytes is the same as splitting code points.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, replace
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tillframe.sources.files import scratch_path

#: Bytes of text whose words are found in one go; bounds the memory of a task.
BLOCK_BYTES = 1 << 21
#: Keys with more than one in so many rows are looked up by broadcast, so there are fewer of them than this.
HOT_KEYS = 1000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows, written once to the shared scratch folder and read from there.

    This cuts the lineage: a lost executor costs its running tasks and no stage behind them.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)


def crc32_of_id(name: str = "doc_id"):
    """crc32 of the id as text, 0 for a null id; decides training and held-out rows."""
    return F.coalesce(F.crc32(F.col(name).cast("string").cast("binary")), F.lit(0))


def without_columns(df: DataFrame, *results: str) -> list[str]:
    """The columns of `df` but for those that carry a result's name in any case."""
    taken = {name.lower() for name in results}
    return [name for name in df.columns if name.lower() not in taken]


def own_names(operator: Callable) -> Callable:
    """Let an operator, which uses names beginning with `__` inside, take a table that has such columns.

    They are renamed for the operator and get their names back in its result (the first part of one that has several, or its
    `rows`). Arguments may name them as text, not in expressions.
    """
    @wraps(operator)
    def apply(docs: DataFrame, *args, **kwargs):
        away, taken = {}, {name.lower() for name in docs.columns}
        for name in docs.columns:
            if name.startswith("__"):
                new = f"own_{name[2:]}"
                while new.lower() in taken:
                    new = f"own_{new}"
                taken.add(new.lower())
                away[name] = new
        if not away:
            return operator(docs, *args, **kwargs)

        def renamed(value):
            return away.get(value, value) if isinstance(value, str) else [*map(renamed, value)] if isinstance(value, list) else value

        found = operator(docs.withColumnsRenamed(away), *map(renamed, args), **{name: renamed(value) for name, value in kwargs.items()})
        back = {new: name for name, new in away.items()}
        if isinstance(found, tuple):
            return found[0].withColumnsRenamed(back), *found[1:]
        if not isinstance(found, DataFrame):
            return replace(found, rows=found.rows.withColumnsRenamed(back))
        return found.withColumnsRenamed(back)

    return apply


def looked_up(df: DataFrame, values: DataFrame, key: str, rows: int) -> DataFrame:
    """`df` with the other columns of `values`: one row a key, and in `n` how many of the `rows` rows of `df` have it.

    Keys with more than one in HOT_KEYS of the rows, fewer than that many, are answered by broadcast, so no task meets all rows of one.
    """
    names = [name for name in values.columns if name not in (key, "n")]
    values = values.select(key, "n", F.struct(*names).alias("__value"))
    frequent = F.col("n") > rows // HOT_KEYS
    marked = df.join(F.broadcast(values.filter(frequent).select(key, F.col("__value").alias("__hot"))), key, "left")
    rare = marked.filter("__hot is null").drop("__hot").join(values.filter(~frequent).select(key, "__value"), key)
    return marked.filter("__hot is not null").withColumnRenamed("__hot", "__value").unionByName(rare).select(*df.columns, "__value.*")


def map_batches(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str | StructType) -> DataFrame:
    importable(df.sparkSession)
    return df.mapInArrow(function, schema)


@dataclass(frozen=True)
class WordClass:
    """Which bytes belong to words, and what each byte counts as."""

    member: np.ndarray
    fold: np.ndarray


def _fold() -> np.ndarray:
    fold = np.arange(256, dtype=np.uint8)
    fold[ord("A"):ord("Z") + 1] += 32
    return fold


def _members(separators: Iterable[int]) -> np.ndarray:
    member = np.ones(256, dtype=bool)
    member[list(separators)] = False
    return member


#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z.
LETTERS = WordClass(_members([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]), _fold())
#: `[^\x20\x09-\x0D]+` after lower-casing A-Z.
NOT_SPACE = WordClass(_members([0x20, *range(9, 14)]), _fold())

_VALUES = np.random.default_rng(20240601).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(values: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values (the finalizer of SplitMix64)."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))


def _factors(n: int) -> np.ndarray:
    """A factor for each place of a word. They follow no power law, under which some pairs of long words meet by construction."""
    with np.errstate(over="ignore"):
        return mixed(np.arange(1, n + 1, dtype=np.uint64) * _BASE)


_SHORT_FACTORS = _factors(256)


def hash_words(data: bytes, kind: WordClass) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, byte starts and byte ends of the words in `data`."""
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = kind.member[raw]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    starts, ends = edges[0::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), starts, ends
    lengths = ends - starts
    at = np.cumsum(lengths) - lengths
    place = np.arange(at[-1] + lengths[-1]) - np.repeat(at, lengths)
    longest = int(lengths.max())
    factors = _SHORT_FACTORS if longest <= len(_SHORT_FACTORS) else _factors(longest)
    with np.errstate(over="ignore"):
        values = _VALUES[kind.fold[raw[inside]]] * factors[place]
        return mixed(np.add.reduceat(values, at) + lengths.astype(np.uint64)), starts, ends


def _pieces(data: bytes, kind: WordClass) -> Iterator[bytes]:
    """A text in parts of about BLOCK_BYTES, cut where no word is cut."""
    start = 0
    while len(data) - start > BLOCK_BYTES:
        end = start + BLOCK_BYTES
        while end < len(data) and kind.member[data[end]]:
            end += 1
        yield data[start:end]
        start = end
    yield data[start:]


def words_of(texts: list[bytes], kind: WordClass) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For runs of texts: first and last (exclusive) text, all word hashes, and each text's first word.

    The last array has one more entry than the run has texts. Separators between texts
    are never part of a word, so no word crosses from one text into the next.
    """
    first = 0
    while first < len(texts):
        last, size = first + 1, len(texts[first])
        while last < len(texts) and size + len(texts[last]) < BLOCK_BYTES:
            size += len(texts[last]) + 1
            last += 1
        if last == first + 1 and len(texts[first]) > BLOCK_BYTES:
            hashes = np.concatenate([hash_words(piece, kind)[0] for piece in _pieces(texts[first], kind)])
            yield first, last, hashes, np.array([0, len(hashes)])
        else:
            run = texts[first:last]
            hashes, starts, _ = hash_words(b"\n".join(run), kind)
            begins = np.cumsum([0, *(len(text) + 1 for text in run)])
            yield first, last, hashes, np.searchsorted(starts, begins)
        first = last


def utf8(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; null counts as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n words, by where it starts."""
    with np.errstate(over="ignore"):
        total = words[:len(words) - n + 1].copy()
        for i in range(1, n):
            total = total * _BASE + words[i:len(words) - n + 1 + i]
        return mixed(total + np.uint64(n))
