"""Sharding of indivisible groups by best-fit-decreasing bin packing.

Rows with one text are a group and go to one shard. Groups, largest first, enter the
bin with the tightest remaining capacity that holds them, found through a balanced
tree. In the first step tasks pack the groups of a bucket into blocks of
1 / (shards * BLOCKS) of all bytes, taking them from a sort and holding only the tree.
The number of buckets follows that of groups; where there are many, their blocks are packed again as
groups were. In the last step the driver packs the blocks, whose number is bounded by the parameters,
into the shards. Where their number is fixed, the smallest capacity that is enough is
found by bisection. Groups larger than an equal share get a shard of their own first.

Cases: a missing text is an empty one. Missing ids and repeated rows are rows like
any other. With fewer groups than shards some shards stay empty; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered, placed, stored

SHARDS = 16
# Blocks that a shard's worth of bytes is packed into.
BLOCKS = 64
# Groups of a bucket, and by how many blocks the driver may take more than it must.
GROUPS_PER_BUCKET = 2_000
BUCKETS = 256
BUCKETS_PER_TASK = 50


class Tree:
    """Remaining capacities and their bins in order, as a treap."""

    def __init__(self):
        self._root = None
        self._seed = 1

    def add(self, room: int, name: int) -> None:
        # Any sequence of priorities without a pattern keeps the tree balanced.
        self._seed = self._seed * 6364136223846793005 + 1442695040888963407 & (1 << 64) - 1
        low, high = self._split(self._root, (room, name))
        self._root = self._merge(self._merge(low, [(room, name), self._seed >> 32, None, None]), high)

    def take(self, size: int) -> tuple[int, int] | None:
        """The tightest bin with at least this room, which leaves the tree."""
        low, high = self._split(self._root, (size, -1))
        if high is None:
            self._root = low
            return None
        node, parent = high, None
        while node[2] is not None:
            node, parent = node[2], node
        if parent is None:
            high = node[3]
        else:
            parent[2] = node[3]
        self._root = self._merge(low, high)
        return node[0]

    def _split(self, node, key):
        """What lies below the key, and the rest."""
        if node is None:
            return None, None
        if node[0] < key:
            low, high = self._split(node[3], key)
            node[3] = low
            return node, high
        low, high = self._split(node[2], key)
        node[2] = high
        return low, node

    def _merge(self, low, high):
        if low is None or high is None:
            return high if low is None else low
        if low[1] > high[1]:
            low[3] = self._merge(low[3], high)
            return low
        high[2] = self._merge(low, high[2])
        return high


def best_fit(sizes: Iterable[int], capacity: int) -> Iterator[int]:
    """The bin of each size; sizes come largest first. One above the capacity fills a bin alone."""
    tree, bins = Tree(), 0
    for size in sizes:
        found = tree.take(size) if size <= capacity else None
        if found is None:
            room, name = max(0, capacity - size), bins
            bins += 1
        else:
            room, name = found[0] - size, found[1]
        if room:
            tree.add(room, name)
        yield name


def fixed_number(sizes: list[int], shards: int) -> list[int]:
    """The shard of each size, largest first, with shards as equal as best-fit-decreasing makes them."""
    alone = 0
    left = sum(sizes)
    while alone < min(len(sizes), shards - 1) and sizes[alone] * (shards - alone) > left:
        left -= sizes[alone]
        alone += 1
    rest, bins = sizes[alone:], shards - alone
    low = max(-(-left // bins), rest[0] if rest else 0)
    high = 2 * low + 1  # enough: any two of more bins than that would fit into one
    while low < high:
        middle = (low + high) // 2
        if max(best_fit(rest, middle), default=0) < bins:
            high = middle
        else:
            low = middle + 1
    return [*range(alone), *[alone + b for b in best_fit(rest, high)]]


def group_blocks(groups: DataFrame, capacity: int, buckets: int) -> DataFrame:
    """``key, bucket, block, bytes`` of groups given as ``key, bytes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[int | None, Tree, int] = (None, Tree(), 0)
        for batch in batches:
            blocks = []
            for bucket, size in zip(batch.column("bucket").to_pylist(), batch.column("bytes").to_pylist(), strict=True):
                if bucket != held[0]:
                    held = (bucket, Tree(), 0)
                _, tree, count = held
                found = tree.take(size) if size <= capacity else None
                room, name = (found[0] - size, found[1]) if found else (max(0, capacity - size), count)
                if room:
                    tree.add(room, name)
                held = (bucket, tree, max(count, name + 1))
                blocks.append(name)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("bucket"), pa.array(blocks, pa.int64()), batch.column("bytes")],
                ["key", "bucket", "block", "bytes"],
            )

    dealt = groups.select("key", F.pmod(F.xxhash64("key"), buckets).cast("int").alias("bucket"), "bytes")
    tasks = max(min(buckets, BUCKETS), buckets // BUCKETS_PER_TASK)
    ordered = dealt.repartition(tasks, "bucket").sortWithinPartitions("bucket", F.desc("bytes"), "key")
    return ordered.mapInArrow(run, "key string, bucket int, block bigint, bytes bigint")


def _block() -> Column:
    """The name of a row's block."""
    return F.concat_ws("/", "bucket", "block")


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row."""
    text = F.coalesce("text", F.lit(""))
    rows = stored(
        placed(
            docs.select(
                "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"),
                F.crc32(text.cast("binary")).alias("text_crc32"), F.sha2(text, 256).alias("key"),
            )
        ),
        "sizes",
    )
    groups = stored(rows.groupBy("key").agg(F.sum("size").alias("bytes")), "groups")
    count, total = groups.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    capacity = max(1, -(-total // (shards * BLOCKS)))
    # Any two blocks of a bucket hold more than one capacity, so a level leaves at most
    # 2 * shards * BLOCKS of them and one for each bucket.
    levels, most = [], 2 * shards * BLOCKS + BUCKETS
    while not levels or count > most:
        buckets = max(1, -(-count // GROUPS_PER_BUCKET))
        levels.append(stored(group_blocks(groups, capacity, buckets), "blocks"))
        groups = stored(
            levels[-1].groupBy(_block().alias("key")).agg(F.sum("bytes").alias("bytes")), "block-sizes"
        )
        count = groups.count()
    sizes = sorted(groups.collect(), key=lambda r: (-r.bytes, r.key))
    into = fixed_number([r.bytes for r in sizes], shards)
    homes = F.broadcast(
        rows.sparkSession.createDataFrame(
            [(r.key, s) for r, s in zip(sizes, into, strict=True)], "home string, shard int"
        )
    )
    for blocks in reversed(levels):
        # Stored, so that a hot group's side of the join below is split.
        homes = stored(blocks.join(homes, _block() == F.col("home")).select("key", "shard"), "homes")
        homes = homes.withColumnRenamed("key", "home")
    homes = homes.withColumnRenamed("home", "key")
    return numbered(rows.join(homes, "key"), "shard", "slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("slot").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
