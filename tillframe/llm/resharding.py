"""Minimum-cost-flow resharding: move the fewest bytes from old shard sizes to new capacities.

Rows fall into blocks, a hash of id and size within the old shard; a fixed number of blocks
per shard, so that the plan has a bounded size however many rows there are. A flow network
leads from old shards (their bytes) to new shards (their capacities); staying costs
nothing, each moved byte costs one, or what the caller's cost matrix says. Successive
shortest paths give the cheapest flow, blocks are dealt out to follow it, and only shards
that lose or gain a block are written again. A slot is the block's offset in its shard,
known from the counts of blocks, plus the row's place in its block, so no task sees a shard.

Defined cases: the size of a null text is its row overhead. A null old shard, or one
outside the new range, has no place to stay, so its rows all move. Null ids are allowed;
rows that are equal in id and size share a block and are told apart by their place in it.
Result columns replace input columns of the same name. An empty table gives an empty
result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tillframe.llm.common import own_names, without_columns
from tillframe.sources.files import scratch_path

OLD_SHARDS, NEW_SHARDS, BLOCKS = 16, 24, 2048
ROW_BYTES = 8
FILE_BYTES = 128 << 20
RESULTS = ["old_shard", "shard", "slot", "size"]


@dataclass(frozen=True)
class Block:
    shard: int | None
    block: int
    size: int
    rows: int


def cheapest_flow(supplies: list[int], capacities: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Amount from each supply to each capacity, all supplies sent, at least total cost."""
    if sum(supplies) > sum(capacities):
        raise ValueError(f"{sum(supplies)} bytes exceed the capacities of {sum(capacities)}")
    n, m = len(supplies), len(capacities)
    flow = [[0] * m for _ in range(n)]
    left, room = list(supplies), list(capacities)
    price = [0] * (n + m)
    while any(left):
        # Dijkstra on reduced costs over the residual network, from all supplies that have some left
        distance = [0 if left[i] else None for i in range(n)] + [None] * m
        parent: list[int | None] = [None] * (n + m)
        done = [False] * (n + m)
        while True:
            at = min((v for v in range(n + m) if distance[v] is not None and not done[v]), key=lambda v: distance[v], default=None)
            if at is None:
                break
            done[at] = True
            if at < n:
                steps = [(n + j, cost[at][j]) for j in range(m)]
            else:
                steps = [(i, -cost[i][at - n]) for i in range(n) if flow[i][at - n]]
            for to, step in steps:
                far = distance[at] + step + price[at] - price[to]
                if not done[to] and (distance[to] is None or far < distance[to]):
                    distance[to], parent[to] = far, at
        most = max(x for x in distance if x is not None)
        price = [p + (most if d is None else d) for p, d in zip(price, distance)]
        end = min((n + j for j in range(m) if room[j] and distance[n + j] is not None), key=lambda v: price[v])
        path = [end]
        while parent[path[-1]] is not None:
            path.append(parent[path[-1]])
        path.reverse()
        amount = min([left[path[0]], room[end - n], *(flow[b][a - n] for a, b in zip(path, path[1:]) if a >= n)])
        for a, b in zip(path, path[1:]):
            if a < n:
                flow[a][b - n] += amount
            else:
                flow[b][a - n] -= amount
        left[path[0]] -= amount
        room[end - n] -= amount
    return flow


def plan_blocks(blocks: list[Block], capacities: list[int], cost: list[list[int]] | None = None) -> list[int]:
    """The new shard of each block: follows the cheapest flow, then evens out what whole blocks leave uneven."""
    old = sorted({block.shard for block in blocks}, key=lambda x: (x is None, x))
    supplies = [sum(block.size for block in blocks if block.shard == shard) for shard in old]
    if cost is None:
        cost = [[int(shard != j) for j in range(len(capacities))] for shard in old]
    flow = cheapest_flow(supplies, capacities, cost)
    order = sorted(range(len(blocks)), key=lambda i: (-blocks[i].size, old.index(blocks[i].shard), blocks[i].block))
    target, filled = [0] * len(blocks), [0] * len(capacities)
    row = {shard: i for i, shard in enumerate(old)}
    for i in order:
        due = flow[row[blocks[i].shard]]
        j = max(range(len(due)), key=lambda j: (due[j], -filled[j], -j))
        due[j] -= blocks[i].size
        target[i] = j
        filled[j] += blocks[i].size
    inside: list[list[int]] = [[] for _ in capacities]
    for i, j in enumerate(target):
        inside[j].append(i)
    over = [f - c for f, c in zip(filled, capacities)]
    for _ in range(len(blocks)):
        high, low = max(range(len(over)), key=over.__getitem__), min(range(len(over)), key=over.__getitem__)
        gap = over[high] - over[low]
        some = [i for i in inside[high] if 0 < blocks[i].size < gap]
        if not some:
            break
        i = min(some, key=lambda i: (abs(2 * blocks[i].size - gap), blocks[i].shard == high, i))
        inside[high].remove(i)
        inside[low].append(i)
        target[i] = low
        over[high] -= blocks[i].size
        over[low] += blocks[i].size
    return target


@dataclass(frozen=True)
class Resharding:
    """The written shards' path, the shards written and left as they were, bytes moved, and all rows."""

    path: str
    written: tuple[int, ...]
    untouched: tuple[int, ...]
    moved_bytes: int
    rows: DataFrame


@own_names
def reshard(docs: DataFrame, old_shard: Column, capacities: list[int] | int = NEW_SHARDS, *, path: str | None = None,
            key: str = "doc_id", text: str = "text", blocks: int = BLOCKS, cost: list[list[int]] | None = None,
            file_bytes: int = FILE_BYTES) -> Resharding:
    """Place all rows of `docs` and write the shards that change to `path`/shard=N (default: the scratch folder).

    `capacities` are bytes per new shard, or a number of shards of equal capacity. Rows are
    those of `docs` with old_shard, shard, slot and size.
    """
    spark = docs.sparkSession
    kept = without_columns(docs, *RESULTS)
    docs = docs.select(*kept, old_shard.cast("int").alias("old_shard"))
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("bigint")
    rows = docs.withColumn("size", size).withColumn(
        "__block", F.pmod(F.xxhash64(F.col(key), F.col("size"), F.col(text)), F.lit(blocks)).cast("int"))
    # at most `blocks` rows for each old shard
    found = [Block(*row) for row in rows.groupBy("old_shard", "__block").agg(F.sum("size"), F.count(F.lit(1))).collect()]
    found.sort(key=lambda block: (block.shard is None, block.shard or 0, block.block))
    total = sum(block.size for block in found)
    if isinstance(capacities, int):
        capacities = [-(-total // capacities)] * capacities
    target = plan_blocks(found, capacities, cost)
    offsets, plan = [0] * len(capacities), []
    for block, shard in zip(found, target):
        plan.append((block.shard, block.block, shard, offsets[shard]))
        offsets[shard] += block.rows
    changed = {block.shard for block, shard in zip(found, target) if block.shard != shard} | {
        shard for block, shard in zip(found, target) if block.shard != shard}
    written = tuple(j for j in range(len(capacities)) if j in changed)
    untouched = tuple(j for j in range(len(capacities)) if j not in changed and offsets[j])
    files = max(4, -(-total // (len(capacities) * file_bytes)))
    moves = F.broadcast(spark.createDataFrame(plan, "__old int, __part int, shard int, __offset bigint"))
    placed = rows.join(moves, rows["old_shard"].eqNullSafe(moves["__old"]) & (rows["__block"] == moves["__part"])).withColumn(
        "__file", (F.col("shard") * files + F.pmod(F.col("__block"), F.lit(files))).cast("int"))
    place = F.row_number().over(Window.partitionBy("__file", "old_shard", "__block").orderBy(key, F.xxhash64(*kept)))
    placed = placed.repartitionById(len(capacities) * files, "__file").withColumn("slot", F.col("__offset") + place - 1)
    placed = placed.select(*kept, "old_shard", "slot", "size", "shard")
    path = path or scratch_path(spark, "shards")
    (placed.filter(F.col("shard").isin(list(written))) if untouched else placed).write.partitionBy("shard").parquet(path)
    back = spark.read.schema(placed.schema).parquet(path).select(*placed.columns)
    if untouched:
        back = back.unionByName(placed.filter(F.col("shard").isin(list(untouched))))
    moved = sum(block.size for block, shard in zip(found, target) if block.shard != shard)
    return Resharding(path, written, untouched, moved, back)


def old_layout(source: str = "source") -> Column:
    """The layout to move from: OLD_SHARDS shards by a hash of the source; a source holds one shard."""
    return F.pmod(F.xxhash64(F.col(source)), F.lit(OLD_SHARDS))


def shard_report(docs: DataFrame) -> DataFrame:
    found = reshard(docs, old_layout()).rows
    return found.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "old_shard")


@own_names
def resharded(docs: DataFrame) -> DataFrame:
    """The rows of `docs` with shard and slot, read from the written shards."""
    return reshard(docs, old_layout()).rows.drop("old_shard", "size")
