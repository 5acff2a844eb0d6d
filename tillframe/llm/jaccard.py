"""N-gram Jaccard join: MinHash bands find candidates, full n-gram sets decide.

1. Each text becomes the set of hashes of its word n-grams (a text of fewer words is one
   n-gram; a text without words has none and links to nothing). Texts with equal sets form
   a class, found by a 128-bit digest of the sorted set; a digest is hashed from the set
   alone, so copies never reach the join. The hashes of a set are 64-bit.
2. One MinHash signature per class, cut into bands; `choose_bands` picks the fewest hashes
   that reach the target recall at the threshold. Classes are shuffled on band hashes, and
   each bucket gives one edge per member, to the bucket's smallest member: as many rows as
   members, not as pairs. Connected buckets make a candidate group.
3. A candidate group is cut into blocks of about BLOCK classes and at most about BLOCK_GRAMS
   n-grams, dealt by a hash. A task holds one pair of blocks, intersects the full sets of all their classes by matrix
   products over slices of the n-grams, and emits per class the number of linked rows and
   classes, and a spanning forest of the links. So no group is held whole by a task, and
   pairs are counted exactly without being emitted. Pairs inside a candidate group are all
   verified, whether or not they share a band.
4. Spanning links are joined into groups by label propagation with pointer jumping.

Defined cases: null, empty and wordless texts are classes of their own with no links. Rows
that share a doc_id stay separate rows. A null doc_id is kept, its class gets the smallest
id of its copies, or null. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillframe.llm.common import LETTERS, gram_hashes, map_batches, mixed, own_names, stored, utf8, words_of
from tillframe.llm.components import components

N, THRESHOLD, RECALL, MAX_HASHES = 5, 0.8, 0.9999, 192
#: Classes, and n-grams, in a block; a task holds two.
BLOCK, BLOCK_GRAMS = 512, 1 << 21
_SLICE = 4096


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows, then the fewest bands, whose recall at the threshold is reached within max_hashes."""
    best = None
    for rows in range(1, max_hashes + 1):
        bands = 1 if threshold >= 1 else int(np.ceil(np.log(1 - recall) / np.log1p(-threshold**rows)))
        if bands * rows <= max_hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError(f"{max_hashes} hashes do not reach recall {recall} at {threshold}")
    return best


def gram_set(words: np.ndarray, n: int = N) -> np.ndarray:
    """Sorted distinct n-gram hashes of a text's words."""
    if not len(words):
        return words
    return np.unique(gram_hashes(words, min(n, len(words))))


def signatures(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """Band hashes of non-empty sets, one row a set."""
    draw = np.random.default_rng(97)
    n = bands * rows
    factors = draw.integers(1, 2**32, n, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    shifts = draw.integers(0, 2**32, n, dtype=np.uint64).astype(np.uint32)
    flat = np.concatenate(sets)
    flat = (flat ^ (flat >> np.uint64(32))).astype(np.uint32)
    begins = np.cumsum([0, *map(len, sets)])[:-1]
    out = np.empty((len(sets), n), np.uint32)
    for i in range(n):
        values = flat * factors[i] + shifts[i]
        values ^= values >> np.uint32(15)
        values *= np.uint32(0x2C1B3C6D)
        out[:, i] = np.minimum.reduceat(values, begins)
    folded = np.zeros((len(sets), bands), np.uint64)
    for row in range(rows):
        folded = mixed(folded ^ out[:, row::rows].astype(np.uint64)) + np.uint64(0x9E3779B97F4A7C15)
    return mixed(folded + np.arange(bands, dtype=np.uint64))


def _digest(grams: np.ndarray) -> bytes | None:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None


def _sketches(docs: DataFrame, text: str, n: int, bands: int, rows: int) -> DataFrame:
    """(id, row, class, node, size, bands) of every row of (id, row, text); size counts n-grams, bands is null where there is no word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(2))
            classes: list[bytes | None] = []
            sizes: list[int] = []
            marks: list[bytes | None] = []
            for first, last, hashes, begins in words_of(texts, LETTERS):
                sets = [gram_set(hashes[a:b], n) for a, b in zip(begins[:-1], begins[1:])]
                classes += [_digest(grams) or _digest(np.frombuffer(text, np.uint8)) for grams, text in zip(sets, texts[first:last])]
                sizes += map(len, sets)
                full = [grams for grams in sets if len(grams)]
                folded = iter(signatures(full, bands, rows)) if full else iter(())
                marks += [next(folded).tobytes() if len(grams) else None for grams in sets]
            offsets = np.cumsum([0, *(0 if mark is None else bands for mark in marks)]).astype(np.int32)
            values = np.frombuffer(b"".join(mark for mark in marks if mark is not None), np.int64)
            nodes = [None if c is None else int.from_bytes(c[:8], "little", signed=True) for c in classes]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(classes, pa.binary()), pa.array(nodes, pa.int64()),
                 pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))],
                ["id", "row", "class", "node", "size", "bands"])

    return map_batches(docs.select("id", "row", F.col(text).alias("text")), run,
                       f"id {docs.schema['id'].dataType.simpleString()}, row bigint, class binary, node bigint, size bigint, bands array<bigint>")


def _grams(docs: DataFrame, n: int) -> DataFrame:
    """(node, rows, root, blocks, block, class, grams) of (node, rows, root, blocks, block, class, text), where the class is the text's own."""
    kept = ["node", "rows", "root", "blocks", "block"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for *_, hashes, begins in words_of(utf8(batch.column("text")), LETTERS):
                found += [gram_set(hashes[a:b], n) for a, b in zip(begins[:-1], begins[1:])]
            own = [_digest(grams) == name for grams, name in zip(found, batch.column("class").to_pylist())]
            made = pa.RecordBatch.from_arrays(
                [*[batch.column(name) for name in kept], pa.array([grams.tobytes() for grams in found], pa.binary())], [*kept, "grams"])
            yield made.filter(pa.array(own))

    return map_batches(docs.select(*kept, "class", "text"), run,
                       "node bigint, rows bigint, root bigint, blocks int, block int, grams binary")


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Common n-grams of every set on the left with every set on the right, by slices of the n-grams they share."""
    flat = np.concatenate([*left, *right])
    sizes = np.array([len(x) for x in (*left, *right)])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate(([True], flat[1:] != flat[:-1]))
    column = np.cumsum(new) - 1
    on_right = owner >= len(left)
    shared = (np.bincount(column, ~on_right) > 0) & (np.bincount(column, on_right) > 0)
    keep = shared[column]
    column, owner, on_right = (np.cumsum(shared) - 1)[column[keep]], owner[keep], on_right[keep]
    total = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, int(shared.sum()), _SLICE):
        a, b = np.searchsorted(column, [start, start + _SLICE])
        width = min(_SLICE, int(column[b - 1]) + 1 - start)
        dense = np.zeros((len(left) + len(right), width), np.float32)
        dense[owner[a:b], column[a:b] - start] = 1
        total += dense[:len(left)] @ dense[len(left):].T
    return total


def _verify(nodes: np.ndarray, rows: np.ndarray, sides: np.ndarray, grams: list[np.ndarray], threshold: float,
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Linked rows, linked classes and a root for each class of a pair of blocks (or of one block: sides all equal)."""
    one, two = np.flatnonzero(sides == sides.min()), np.flatnonzero(sides == sides.max())
    alone = sides.min() == sides.max()
    left, right = [grams[i] for i in one], [grams[i] for i in two]
    common = _overlaps(left, right).astype(np.float64)
    linked = common / (np.array([*map(len, left)])[:, None] + np.array([*map(len, right)])[None, :] - common) >= threshold
    if alone:
        np.fill_diagonal(linked, False)
    sums, counts = np.zeros(len(nodes), np.int64), np.zeros(len(nodes), np.int64)
    roots = nodes.copy()
    sums[one], counts[one] = linked @ rows[two], linked.sum(axis=1)
    if not alone:
        sums[two], counts[two] = linked.T @ rows[one], linked.sum(axis=0)
    if linked.any():
        top = np.iinfo(np.int64).max
        while True:
            before = roots.copy()
            for a, b, mask in ((one, two, linked), (two, one, linked.T)):
                roots[a] = np.minimum(roots[a], np.where(mask, roots[b][None, :], top).min(axis=1))
            if (before == roots).all():
                break
    return sums, counts, roots


def _verified(parts: DataFrame, threshold: float) -> DataFrame:
    """(node, linked_rows, linked_classes, root) for each class and pair of blocks; parts is sorted by (root, one, two)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        last = None

        def done() -> Iterator[pa.RecordBatch]:
            nodes, rows, sides = (np.array([row[i] for row in held], np.int64) for i in range(3))
            if last[1] != last[2] and sides.min() == sides.max():
                return  # the other block of the pair is empty
            sums, counts, roots = _verify(nodes, rows, sides, [np.frombuffer(row[3], np.uint64) for row in held], threshold)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (nodes, sums, counts, roots)],
                                             ["node", "linked_rows", "linked_classes", "root"])

        for batch in batches:
            for *key, node, rows, block, grams in zip(*[column.to_pylist() for column in batch.columns]):
                if key != last and held:
                    yield from done()
                    held = []
                last = key
                held.append((node, rows, block, grams))
        if held:
            yield from done()

    return map_batches(parts.select("root", "one", "two", "node", "rows", "block", "grams"), run,
                       "node bigint, linked_rows bigint, linked_classes bigint, root bigint")


@own_names
def near_copies(docs: DataFrame, *, key: str = "doc_id", text: str = "text", n: int = N, threshold: float = THRESHOLD,
                recall: float = RECALL, max_hashes: int = MAX_HASHES) -> DataFrame:
    """One row per row of `docs`: id, row (hash of the whole row), copy_id, class_id, n_links, n_linked_classes, leader.

    copy_id is the smallest id with the same n-gram set, class_id the smallest id of all
    rows joined by links of Jaccard similarity `threshold` or more, n_links the number of other rows
    linked to the row (its copies included), n_linked_classes the number of other classes.
    leader is (id, row) of the first row of the class_id's group, null for a text without a class.
    """
    bands, rows = choose_bands(threshold, recall, max_hashes)
    whole = docs.select(F.col(key).alias("id"), F.xxhash64(*docs.columns).alias("row"), F.col(text).alias("text"))
    sketches = stored(_sketches(whole, "text", n, bands, rows), "sketches")
    classes = stored(
        sketches.filter("class is not null").groupBy("class", "node").agg(
            F.count(F.lit(1)).alias("rows"), F.min(F.struct("id", "row")).alias("first"), F.min("id").alias("copy_id"),
            F.first("size").alias("size"), F.first("bands").alias("bands")), "classes")
    member = classes.filter("bands is not null").select("node", F.explode("bands").alias("bucket"))
    hubs = member.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("top")).filter("hub < top")
    edges = member.join(hubs.select("bucket", "hub"), "bucket").filter("node <> hub").select(
        F.col("node").alias("child"), F.col("hub").alias("parent")).distinct()
    groups = stored(components(edges, "candidates"), "groups")
    weight = F.greatest(F.count(F.lit(1)) / F.lit(BLOCK), F.sum("size") / F.lit(BLOCK_GRAMS))
    blocks = classes.select("node", "size").join(groups, "node").groupBy("root").agg(F.ceil(weight).cast("int").alias("blocks"))
    wanted = classes.select("node", "class", "rows", "first").join(groups, "node").join(blocks, "root").select(
        "node", "class", "rows", "root", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"),
        F.col("first.id").alias("__id"), F.col("first.row").alias("__row"))
    texts = whole.join(wanted, whole["id"].eqNullSafe(wanted["__id"]) & (whole["row"] == wanted["__row"])).drop("id", "row")
    sets = _grams(texts, n).dropDuplicates(["node"])
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    parts = sets.withColumn("other", other).select(
        "root", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "node", "rows", "block", "grams")
    checked = stored(_verified(parts.repartition("root", "one", "two").sortWithinPartitions("root", "one", "two"), threshold), "links")
    counts = checked.groupBy("node").agg(F.sum("linked_rows").alias("linked_rows"), F.sum("linked_classes").alias("linked_classes"))
    joined = components(checked.filter("node <> root").select(F.col("node").alias("child"), F.col("root").alias("parent")), "joined")
    labelled = classes.drop("bands", "size").join(joined, "node", "left").join(counts, "node", "left").withColumn("root", F.coalesce("root", "node"))
    leaders = labelled.groupBy("root").agg(F.min("first").alias("leader"), F.min("copy_id").alias("class_id"))
    found = labelled.join(leaders, "root").select(
        "class", "copy_id", "class_id", "leader", (F.col("rows") - 1 + F.coalesce("linked_rows", F.lit(0))).alias("n_links"),
        F.coalesce("linked_classes", F.lit(0)).alias("n_linked_classes"))
    none = F.col("class").isNull()
    return sketches.select("id", "row", "class").join(found, "class", "left").select(
        F.col("id").alias(key), "row", F.when(none, F.col("id")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.when(none, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("n_linked_classes", F.lit(0)).cast("bigint").alias("n_linked_classes"), "leader")


@own_names
def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs`, columns as they are, without those that another row of their group leads.

    Of rows that are equal in every column one stays. Rows without words and text stay.
    """
    found = near_copies(docs, **options)
    key = options.get("key", "doc_id")
    stay = found.filter(F.col("leader").isNull() | (F.col("leader.id").eqNullSafe(F.col(key)) & (F.col("leader.row") == F.col("row"))))
    stay = stay.groupBy(F.col(key).alias("__id"), F.col("row").alias("__row")).agg(
        F.max(F.col("leader").isNotNull()).alias("__led"), F.count(F.lit(1)).alias("__n"))
    hashed = docs.withColumn("__hash", F.xxhash64(*docs.columns))
    joined = hashed.join(stay, hashed[key].eqNullSafe(stay["__id"]) & (hashed["__hash"] == stay["__row"]))
    first = joined.filter("__led and __n > 1").dropDuplicates(["__hash", "__id"])
    return joined.filter("not (__led and __n > 1)").unionByName(first).select(*docs.columns)
