"""A Merkle manifest of a data set: a leaf per row, a tree of 16-fold runs per source, one tree over the sources.

Leaves get their places without sorting a source. The ids of a source form a bitmap that is
kept in words of 64 ids, only words with an id being stored; each word carries its bits and how
many rows it holds. Sums over words, over spans of 2**16 words, and over spans of 2**32 and 2**48 words make
the directory: the rank of an id is what its directory entry says, plus the set bits below it. Where
ids repeat (`bits` count fewer rows than there are), the rows of that word are ranked by
id and leaf from counts of ids, of leading digits and of leaves, so that not even one id
held by a third of all rows meets in a task.

Rows then go to slot arrays: 256 consecutive places of a tree form a block, which one task
reduces by two levels. The nodes of one pass are the rows of the next, until each tree has one node; the number of
passes follows from the largest count. On the way back each block receives the siblings above it as one
header row, and hands them on with its own.

A node is the lowercase hex sha256 of its children's hex digests in order. Every run of 16 has a node, the last run
with fewer, even one, as well; a tree of one leaf is that leaf.

Defined cases: rows order by doc_id, null first, then by leaf; equal rows are distinct leaves with equal digests.
Null and empty values differ (`-` and `0:`). A null source is its own tree and comes first. Very long texts are
hashed whole. Result columns replace input columns of the same name, whatever their case. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillframe.llm.common import map_batches, own_names, stored, without_columns

FAN = 16
#: Levels that one pass reduces, and places of a block.
LEVELS = 2
BLOCK = FAN**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RESULTS = ("leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
#: Binary digits of a word's number that each step of the directory sums over.
_SPAN_BITS = 16
_SALTS = 1024
#: Words with more than this share of all rows are looked up by broadcast, so that no join task meets them.
_HOT_WORDS = 10_000


def _hash(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field_text(column: Column) -> Column:
    """`-` for null, else the UTF-8 byte count, a colon and the value."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def tree_key(source: Column) -> Column:
    """A text that keeps the order of sources, null first."""
    return F.coalesce(F.concat(F.lit(":"), source), F.lit(""))


def is_checked(doc_id: Column) -> Column:
    """Rows that are checked against a changed text: 5 divides the crc32 of the id as text."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def leaves(docs: DataFrame, keep: Iterable[str] = ("doc_id",)) -> DataFrame:
    """The columns `keep` with tree, id, leaf, and `changed`: the leaf of the tampered row, null if the row is not tampered with."""
    first = F.concat(*[field_text(docs[name]) for name in FIELDS[:-1]])
    lower = F.translate(docs["text"], "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return docs.select(
        F.struct(*[docs[f"`{name}`"] for name in keep]).alias("kept"), tree_key(docs["source"]).alias("tree"),
        docs["doc_id"].cast("bigint").alias("id"), _hash(first, field_text(docs["text"])).alias("leaf"),
        F.when(is_checked(docs["doc_id"]), _hash(first, field_text(lower))).alias("changed"), F.spark_partition_id().alias("part"))


def _running(df: DataFrame, keys: list[str], order: str, result: str) -> DataFrame:
    """`df` with the sum of n over the rows before, within `keys`."""
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(result, F.coalesce(F.sum("n").over(before), F.lit(0).cast("bigint")))


def _looked_up(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join on keys that may be null; the keys come back once."""
    renamed = right.withColumnsRenamed({key: f"__{key}" for key in keys})
    same = reduce(and_, [F.col(key).eqNullSafe(F.col(f"__{key}")) for key in keys])
    return left.join(renamed, same, how).drop(*[f"__{key}" for key in keys])


def directory(rows: DataFrame) -> DataFrame:
    """(tree, word, bits, n, base, size): the bitmap's words, the rows in each, those of the tree before it, and all of the tree.

    `rows` has tree and id; a null id is in the word null, before all others. Bits are numbered from the smallest id.
    """
    words = rows.select("tree", F.shiftright("id", 6).alias("word"), F.expr("shiftleft(1L, cast(id & 63 as int))").alias("bit")).groupBy(
        "tree", "word").agg(F.bit_or("bit").alias("bits"), F.count(F.lit(1)).alias("n"))
    spans = [f"span_{i}" for i in range(1, 4)]
    words = stored(words, "merkle-words").withColumns({name: F.shiftright("word", _SPAN_BITS * i) for i, name in enumerate(spans, 1)})
    levels = [words]
    for i in range(3):  # sums over ever longer spans; no window holds more than 2**16 words or spans and the null word
        levels.append(levels[-1].groupBy("tree", *spans[i:]).agg(F.sum("n").alias("n")))
    base = _running(levels[3].withColumn("size", F.sum("n").over(Window.partitionBy("tree"))), ["tree"], spans[2], "base").drop("n")
    for i in (2, 1, 0):
        keys = ["tree", *spans[i:]]
        inner = _running(levels[i], keys, spans[i - 1] if i else "word", "before")
        base = _looked_up(inner if not i else inner.drop("n"), base, keys).withColumn("base", F.col("before") + F.col("base")).drop("before")
    return base.select("tree", "word", "bits", "n", "base", "size")


def _repeated_ranks(rows: DataFrame) -> DataFrame:
    """Places of rows in words where ids repeat: by id and leaf, from counts of ids, of leading digits of leaves, and of leaves."""
    rows = rows.drop("n").withColumns({"head": F.substring("leaf", 1, 4), "salt": F.pmod(F.xxhash64("part"), F.lit(_SALTS))})
    leaf = ["tree", "word", "id", "head", "leaf"]
    by_salt = stored(rows.groupBy(*leaf, "salt").agg(F.count(F.lit(1)).alias("n")), "merkle-copies")
    counts = [by_salt]
    for depth in (5, 4, 3):
        counts.append(counts[-1].groupBy(*leaf[:depth]).agg(F.sum("n").alias("n")))
    above = _running(counts[3], leaf[:2], "id", "above").drop("n")
    for counted, keys, order in ((counts[2], leaf[:3], "head"), (counts[1], leaf[:4], "leaf"), (counts[0], leaf, "salt")):
        above = _looked_up(_running(counted, keys, order, "before").drop("n"), above, keys).withColumn(
            "above", F.col("above") + F.col("before")).drop("before")
    own = rows.withColumn("nth", F.row_number().over(Window.partitionBy(*leaf, "salt").orderBy("part")) - 1)
    return _looked_up(own, above, [*leaf, "salt"]).withColumn("place", F.col("base") + F.col("nth") + F.col("above")).drop(
        "head", "salt", "nth", "above")


def placed(rows: DataFrame) -> DataFrame:
    """`rows` (tree, id, leaf, part and others) with place and size of the tree."""
    words = stored(directory(rows), "merkle-directory")
    total = words.agg(F.sum("n")).first()[0] or 0
    here, keys = rows.withColumn("word", F.shiftright("id", 6)), ["tree", "word"]
    hot = F.col("n") > max(BLOCK, total // _HOT_WORDS)  # holds for fewer than _HOT_WORDS words
    hottest = words.filter(hot)
    if hottest.isEmpty():
        met = _looked_up(here, words, keys)
    else:
        met = _looked_up(here, F.broadcast(hottest), keys).unionByName(
            _looked_up(_looked_up(here, F.broadcast(hottest.select(*keys)), keys, "left_anti"), words.filter(~hot), keys))
    plain = F.coalesce(F.bit_count("bits") == F.col("n"), F.lit(False))
    ranked = met.filter(plain).drop("n").withColumn("place", F.col("base") + F.expr("bit_count(bits & ~shiftleft(-1L, cast(id & 63 as int)))"))
    if not words.filter(~plain).isEmpty():
        ranked = ranked.unionByName(_repeated_ranks(met.filter(~plain)))
    return ranked.drop("word", "bits", "base")


def node(children: Iterable[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def next_size(size: int) -> int:
    """Nodes that are left of `size` after one pass."""
    for _ in range(LEVELS):
        if size > 1:
            size = -(-size // FAN)
    return size


def block_levels(digests: list[str], size: int) -> list[list[str]]:
    """The nodes of a block, level by level, in a tree of `size` nodes at its lowest level."""
    levels = [digests]
    for _ in range(LEVELS):
        if size > 1:
            levels.append([node(levels[-1][i:i + FAN]) for i in range(0, len(levels[-1]), FAN)])
            size = -(-size // FAN)
    return levels


def siblings(levels: list[list[str]], slot: int) -> list[tuple[int, list[str]]]:
    """For each level below the block's top: the place in its run, and the others of the run."""
    found = []
    for nodes in levels[:-1]:
        first = slot - slot % FAN
        found.append((slot - first, nodes[first:slot] + nodes[slot + 1:first + FAN]))
        slot //= FAN
    return found


def path_text(path: list[tuple[int, list[str]]]) -> str:
    return "|".join(f"{at}:{''.join(others)}" for at, others in path)


def path_steps(text: str) -> list[tuple[int, str]]:
    return [(int(at), others) for at, _, others in (step.partition(":") for step in text.split("|") if step)]


def fold(digest: str, steps: list[tuple[int, str]]) -> str:
    """The root that follows from a leaf and the siblings on its path."""
    for at, others in steps:
        cut = at * 64
        digest = hashlib.sha256((others[:cut] + digest + others[cut:]).encode()).hexdigest()
    return digest


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of one (tree, block) at a time; they arrive together."""
    now, group = None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = (row["tree"], row["block"])
            if key != now and group:
                yield group
                group = []
            now = key
            group.append(row)
    if group:
        yield group


def _slots(group: list[dict]) -> list[dict]:
    """The rows of a block in an array by slot."""
    array: list = [None] * len(group)
    for row in group:
        array[row["slot"]] = row
    return array


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


def _together(df: DataFrame) -> DataFrame:
    return df.repartition("tree", "block").sortWithinPartitions("tree", "block")


def _in_blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumns({"block": F.expr(f"place div {BLOCK}"), "slot": (F.col("place") % BLOCK).cast("int")})


def rise(nodes: DataFrame) -> DataFrame:
    """The nodes one pass further up: (tree, place, size, digest) of every block."""
    schema = pa.schema([("tree", pa.string()), ("place", pa.int64()), ("size", pa.int64()), ("digest", pa.string())])

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = []
        for group in _blocks(batches):
            size = group[0]["size"]
            top = block_levels([row["digest"] for row in _slots(group)], size)[-1]
            done.append({"tree": group[0]["tree"], "place": group[0]["block"], "size": next_size(size), "digest": top[0]})
            if len(done) >= 4096:
                yield _batch(done, schema)
                done = []
        yield _batch(done, schema)

    return map_batches(_together(_in_blocks(nodes).select("tree", "block", "slot", "size", "digest")), reduced,
                       "tree string, place bigint, size bigint, digest string")


def descend(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """(tree, place, digest, path): the siblings from each node to the root.

    `above` has the same for the nodes of the pass above, which are the blocks of this one.
    """
    schema = pa.schema([("tree", pa.string()), ("place", pa.int64()), ("digest", pa.string()), ("path", pa.string())])

    def hand_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _blocks(batches):
            path = next(row["path"] for row in group if row["path"] is not None)
            rows = _slots([row for row in group if row["path"] is None])
            levels = block_levels([row["digest"] for row in rows], rows[0]["size"])
            yield _batch([{"tree": row["tree"], "place": row["block"] * BLOCK + row["slot"], "digest": row["digest"],
                           "path": "|".join(filter(None, (path_text(siblings(levels, row["slot"])), path)))} for row in rows], schema)

    members = _in_blocks(nodes).select("tree", "block", "slot", "size", "digest", F.lit(None).cast("string").alias("path"))
    headers = above.select("tree", F.col("place").alias("block"), F.lit(None).cast("int").alias("slot"), F.lit(None).cast("bigint").alias("size"),
                           F.lit(None).cast("string").alias("digest"), "path")
    return map_batches(_together(members.unionByName(headers)), hand_down, "tree string, place bigint, digest string, path string")


def _passes(nodes: DataFrame, label: str) -> list[DataFrame]:
    """The nodes of every pass, from `nodes` to one node for each tree."""
    levels = [nodes]
    most = nodes.agg(F.max("size")).first()[0] or 0
    while most > 1:
        levels.append(stored(rise(levels[-1]), label))
        most = next_size(most)
    return levels


def source_order(subroots: DataFrame) -> DataFrame:
    """(tree, place, size, digest) of the subroots as leaves of one tree, in bytewise order of the sources.

    Ranks are the place within a sorted part plus the rows of the parts before it; only counts of parts reach the driver.
    """
    parts = stored(subroots.select("tree", "digest").repartitionByRange("tree").withColumn("part", F.spark_partition_id()), "merkle-sources")
    counts = sorted((row.part, row["count"]) for row in parts.groupBy("part").count().collect())
    before, total = [], 0
    for part, n in counts:
        before.append((part, total))
        total += n
    starts = parts.sparkSession.createDataFrame(before, "part int, start bigint")
    nth = F.row_number().over(Window.partitionBy("part").orderBy("tree")) - 1
    return parts.withColumn("nth", nth).join(starts, "part").select(
        F.lit("").alias("tree"), (F.col("start") + F.col("nth")).alias("place"), F.lit(total).cast("bigint").alias("size"), "digest",
        F.col("tree").alias("source_tree"))


@own_names
def manifest(docs: DataFrame, keep: Iterable[str] | None = None) -> DataFrame:
    """The columns `keep` (default all) with leaf, subroot, root, proof_sha256, folded_root and verified."""
    keep = without_columns(docs, *RESULTS) if keep is None else list(keep)
    rows = stored(leaves(docs, keep), "merkle-leaves")
    rows = stored(placed(rows), "merkle-places")
    passes = _passes(rows.select("tree", "place", "size", F.col("leaf").alias("digest")), "merkle-nodes")
    tops = stored(source_order(passes[-1]), "merkle-subroots")
    over = _passes(tops.drop("source_tree"), "merkle-root")
    root = over[-1].select("digest").first()
    root = root[0] if root else None
    down = over[-1].select("tree", "place", "digest", F.lit("").alias("path"))
    for nodes in reversed(over[:-1]):
        down = descend(nodes, down)
    headers = down.join(tops.select("place", "source_tree"), "place").select(
        F.col("source_tree").alias("tree"), F.lit(0).cast("bigint").alias("place"), "digest", "path")
    heads = stored(headers.withColumn("subroot", F.col("digest")), "merkle-headers")
    down = heads.drop("subroot")
    for nodes in reversed(passes[1:-1]):
        down = stored(descend(nodes, down), "merkle-paths")
    return _proved(rows, down, heads, root)


def _proved(rows: DataFrame, above: DataFrame, heads: DataFrame, root: str | None) -> DataFrame:
    """Every row with its proof, folded from its own leaf or the changed one."""
    kept = rows.schema["kept"].dataType
    result = f"kept {kept.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    members = _in_blocks(rows).select(
        "tree", "block", "slot", "size", F.col("leaf").alias("digest"), "changed", "kept", F.lit(None).cast("string").alias("path"),
        F.lit(None).cast("string").alias("subroot"))
    headers = above.join(heads.select("tree", "subroot"), "tree").select("tree", F.col("place").alias("block"), F.lit(None).cast("int").alias("slot"), F.lit(None).cast("bigint").alias("size"),
                           F.lit(None).cast("string").alias("digest"), F.lit(None).cast("string").alias("changed"),
                           F.lit(None).cast(kept).alias("kept"), "path", "subroot")

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("leaf", "subroot", "root", "proof_sha256", "folded_root")
        kind = None

        def batch_of(done: list) -> pa.RecordBatch:
            columns = list(zip(*done)) or [()] * 7
            return pa.RecordBatch.from_arrays([pa.array(columns[0], kind), *[pa.array(x, pa.string()) for x in columns[1:6]],
                                               pa.array(columns[6], pa.bool_())], ["kept", *names, "verified"])

        def watched() -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field("kept").type
                yield batch

        done = []
        for group in _blocks(watched()):
            header = next(row for row in group if row["path"] is not None)
            own = _slots([row for row in group if row["path"] is None])
            levels = block_levels([row["digest"] for row in own], own[0]["size"])
            upper = path_steps(header["path"])
            for row in own:
                steps = [(at, "".join(others)) for at, others in siblings(levels, row["slot"])] + upper
                proof = hashlib.sha256("".join(others for _, others in steps).encode()).hexdigest()
                folded = fold(row["digest"] if row["changed"] is None else row["changed"], steps)
                done.append((row["kept"], row["digest"], header["subroot"], root, proof, folded, folded == root))
            if len(done) >= BLOCK:
                yield batch_of(done)
                done = []
        if done:
            yield batch_of(done)

    return map_batches(_together(members.unionByName(headers)), prove, result).select("kept.*", *RESULTS)


def manifest_report(docs: DataFrame) -> DataFrame:
    return manifest(docs, keep=["doc_id"])
