"""Token-id output: documents packed into rows of fixed length by best-fit decreasing.

Each task encodes whole texts (an end id after each), cuts documents longer than a row into
segments without losing an id, and packs the segments of about `group_tokens` ids at a
time: longest first, each into the row with the least room that still fits it. A segment
tree over the possible rooms finds that row. Packing within tasks needs no shuffle, and a
hot source or a huge document is spread over many rows; what is left empty is about the
last rows of each group.

A row of the table is one row of the id matrix (`ids`: `length` little-endian numbers,
padded), with the cumulative lengths of its segments, the places where positions start again at
0 (segments, and the padding), and the documents and segment numbers in order. `matrix`
and `positions` give the arrays.

Defined cases: a null or empty text is the end id alone. Nulls in ids are kept, repeated
rows are packed one by one. Other input columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tillframe.llm.common import importable, own_names
from tillframe.llm.tokens import Pieces, default_model, pre_tokens
from tillframe.sources.files import scratch_path

LENGTH = 2048
GROUP_TOKENS = 1 << 22
PAD = 0


class Rooms:
    """Rows by the room they have left; a segment tree finds the least room that is enough."""

    def __init__(self, length: int):
        self.leaves = 1 << length.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def _add(self, room: int, change: int) -> None:
        node = room + self.leaves
        while node:
            self.counts[node] += change
            node >>= 1

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """(room, row) of the row with the least room of at least `size`, taken out; None if there is none."""
        node = size + self.leaves
        while not self.counts[node] or node < self.leaves:
            if self.counts[node]:  # an inner node to the right: its leftmost leaf with a row
                node = 2 * node if self.counts[2 * node] else 2 * node + 1
                continue
            while node & 1:  # up from right children
                node >>= 1
            if not node:
                return None
            node += 1
        room = node - self.leaves
        self._add(room, -1)
        return room, self.rows[room].pop()


def best_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """Which sizes go into each row, in the order they were put."""
    rows: list[list[int]] = []
    rooms = Rooms(length)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = rooms.take(sizes[i])
        if found is None:
            found = (length, len(rows))
            rows.append([])
        room, row = found
        rows[row].append(i)
        rooms.put(room - sizes[i], row)
    return rows


def id_type(vocabulary: int) -> np.dtype:
    return np.dtype("<u2") if vocabulary <= 1 << 16 else np.dtype("<u4")


@own_names
def pack(docs: DataFrame, path: str | None = None, *, out: str | None = None, key: str = "doc_id", text: str = "text",
         length: int = LENGTH, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Write the packed rows to `out` (default: the scratch folder), and read them: shard, row, n_tokens, doc_ids,
    segments, cu_seqlens, position_resets, ids."""
    model = path or default_model()
    spark = docs.sparkSession
    importable(spark)
    kind = docs.schema[key].dataType.simpleString()
    schema = (f"shard int, row bigint, n_tokens int, doc_ids array<{kind}>, segments array<int>, cu_seqlens array<int>, "
              "position_resets array<int>, ids binary")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.at(model)
        numbers = id_type(pieces.size)
        end, shard = np.array([pieces.end], np.uint32).tobytes(), TaskContext.get().partitionId()
        held: list[tuple[object, int, np.ndarray]] = []
        size = done = 0
        for batch in batches:
            keys = batch.column(0)
            for key_value, value in zip(keys.to_pylist(), batch.column(1).to_pylist()):
                ids = np.frombuffer(b"".join([*map(pieces.packed, pre_tokens(value or "")), end]), np.uint32).astype(numbers)
                for segment, start in enumerate(range(0, len(ids), length)):
                    held.append((key_value, segment, ids[start:start + length]))
                    size += len(held[-1][2])
                    if size >= group_tokens:
                        packed = best_fit_decreasing([len(x[2]) for x in held], length)
                        yield batch_of(packed, held, keys.type, shard, done, numbers)
                        done += len(packed)
                        held, size = [], 0
        if held:
            packed = best_fit_decreasing([len(x[2]) for x in held], length)
            yield batch_of(packed, held, pa.null() if not held else keys.type, shard, done, numbers)

    def batch_of(packed: list[list[int]], held: list, key_type: pa.DataType, shard: int, done: int, numbers: np.dtype) -> pa.RecordBatch:
        matrix = np.full((len(packed), length), PAD, numbers)
        sums = []
        for row, members in zip(matrix, packed):
            flat = np.concatenate([held[i][2] for i in members])
            row[:len(flat)] = flat
            sums.append(np.cumsum([0, *(len(held[i][2]) for i in members)]).tolist())
        ints = pa.list_(pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array([shard] * len(packed), pa.int32()), pa.array(range(done, done + len(packed)), pa.int64()),
             pa.array([x[-1] for x in sums], pa.int32()), pa.array([[held[i][0] for i in members] for members in packed], pa.list_(key_type)),
             pa.array([[held[i][1] for i in members] for members in packed], ints), pa.array(sums, ints),
             pa.array([x if x[-1] < length else x[:-1] for x in sums], ints),
             pa.array([row.tobytes() for row in matrix], pa.binary())],
            ["shard", "row", "n_tokens", "doc_ids", "segments", "cu_seqlens", "position_resets", "ids"])

    out = out or scratch_path(spark, "packed")
    made = docs.select(F.col(key), F.col(text)).mapInArrow(rows, schema)
    made.write.parquet(out)
    return spark.read.schema(made.schema).parquet(out)


def matrix(ids: list[bytes], vocabulary: int) -> np.ndarray:
    """The id matrix of packed rows."""
    return np.stack([np.frombuffer(row, id_type(vocabulary)) for row in ids])


def positions(resets: list[int], length: int = LENGTH) -> np.ndarray:
    """Position ids of a row, which start at 0 at each reset."""
    starts = np.zeros(length, np.int64)
    starts[resets] = resets
    return np.arange(length) - np.maximum.accumulate(starts)


def packing_report(docs: DataFrame) -> DataFrame:
    return pack(docs.select("doc_id", "text")).select(
        "shard", "row", "n_tokens", F.size("cu_seqlens").cast("bigint").alias("n_borders"), "doc_ids", "segments", "cu_seqlens",
        "position_resets", F.sha2("ids", 256).alias("ids_sha256"))
