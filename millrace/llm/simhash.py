"""Near-duplicates by SimHash fingerprints and a covering code.

Fingerprints of 64 bits link when at most ``THRESHOLD`` bits differ. Anchors are
the words of a covering code: the binary Golay code of length 23, whose 4,096
words cover all 23-bit words within radius 3, on the first 23 bits of the
fingerprint, and for very many fingerprints the product of two of them on the
first 46. Every fingerprint is at home at the one anchor within the covering
radius, and is sent as a guest to every anchor within radius plus threshold, so
it meets every fingerprint it links with at that one's home. With two codes
the threshold is shared between them, which spares most of the copies.

At an anchor, homes are compared with guests on all 64 bits. Only links that join
something are passed on: at most one per guest and home, not all pairs. An anchor
with many homes is dealt to several tasks by the hash of the home; guests go to
each and stream past.

Cases: a missing text is an empty one; a text without words has fingerprint
zero, which links like any other. A missing id has no say in the smallest
id of a component; repeated rows are rows of their own with one result. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.components import components
from .common import id_and_text, stored

THRESHOLD = 3
WORDS = 3
SEED = 42
LENGTH, RADIUS = 23, 3  # of the code
GENERATOR = 0b101011100011  # of the code, fixed value
# Up to so many fingerprints one code is enough: an anchor has about 5,000 homes then.
ONE_CODE = 20_000_000
# Homes that a task holds at a time.
HOMES = 4096
# Shingles whose bits are counted at a time.
_AT_ONCE = 50_000


# --- Fingerprints --------------------------------------------------------------


def fingerprint(text: str, width: int = WORDS) -> int:
    """The bits set in over half the shingle hashes."""
    import xxhash

    hashed = xxhash.xxh64_intdigest
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    count = max(1, len(words) - width + 1)
    last = len(words) - count  # words of a shingle after its first
    ends = [end + i for i, end in enumerate(accumulate(map(len, words)))]
    begins = [0, *[end + 1 for end in ends]]
    total = np.zeros(64, np.int64)
    for at in range(0, count, _AT_ONCE):
        stop = min(count, at + _AT_ONCE)
        h = [
            hashed(line[begin:end], SEED)
            for begin, end in zip(begins[at:stop], ends[at + last : stop + last], strict=True)
        ]
        bits = np.unpackbits(np.array(h, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > count).view(">u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` as a signed 64-bit integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py()) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fingerprint"]
            )

    rows = id_and_text(docs)
    # As types, since an id may be a struct of columns with any names.
    kinds = StructType([StructField("doc_id", rows.schema["doc_id"].dataType), StructField("fingerprint", LongType())])
    return rows.mapInArrow(run, kinds)


# --- Anchors -------------------------------------------------------------------


def _remainders() -> np.ndarray:
    """Syndromes of the words that have their high 12 bits only."""
    high = np.arange(1 << 12, dtype=np.int64) << 11
    for bit in range(22, 10, -1):
        high = np.where(high >> bit & 1, high ^ (GENERATOR << (bit - 11)), high)
    return high


@lru_cache(maxsize=1)
def _code(threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Remainders; then by syndrome the words of weight up to radius plus threshold,
    lightest first: all of them, where each syndrome begins, and how many of them
    cost at most 0, 1 and so on beyond the radius."""
    words = np.arange(1 << LENGTH, dtype=np.uint32)
    weight = np.bitwise_count(words)
    words = words[weight <= RADIUS + threshold].astype(np.int64)
    weight = np.bitwise_count(words).astype(np.int64)
    remainders = _remainders()
    syndrome = (words & 2047) ^ remainders[words >> 11]
    order = np.lexsort((weight, syndrome))
    words, weight, syndrome = words[order], weight[order], syndrome[order]
    begin = np.searchsorted(syndrome, np.arange(2049))
    counts = np.stack(
        [
            np.bincount(syndrome[weight <= RADIUS + cost], minlength=2048)
            for cost in range(threshold + 1)
        ]
    )
    return remainders, words, begin[:-1], counts


def anchors(values: np.ndarray, codes: int, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of fingerprints: index of the fingerprint, anchor, cost beyond the radius.

    Cost 0 is the home. With several codes the costs add up to the threshold at most.
    """
    remainders, words, begin, counts = _code(threshold)
    index = np.arange(len(values))
    anchor = np.zeros(len(values), np.int64)
    cost = np.zeros(len(values), np.int64)
    for k in range(codes):
        block = ((values >> np.uint64(64 - LENGTH * (k + 1))) & np.uint64((1 << LENGTH) - 1)).astype(np.int64)
        block = block[index]
        syndrome = (block & 2047) ^ remainders[block >> 11]
        times = counts[threshold - cost, syndrome]
        which = np.repeat(np.arange(len(index)), times)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
        error = words[begin[syndrome[which]] + nth]
        beyond = np.maximum(0, np.bitwise_count(error).astype(np.int64) - RADIUS)
        index, cost = index[which], cost[which] + beyond
        # The high 12 bits of a code word tell which one it is.
        anchor = anchor[which] << 12 | (block[which] ^ error) >> 11
    return index, anchor, cost


def crowded(fps: DataFrame, codes: int, count: int) -> dict[int, int]:
    """Pieces of the anchors with more homes than a task should hold.

    The limit follows the count, so that the list has 10,000 entries at most.
    """
    limit = max(HOMES, count // 10_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            anchor, n = np.unique(anchors(values, codes, 0)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(n)], ["anchor", "n"])

    homes = fps.mapInArrow(run, "anchor bigint, n bigint").groupBy("anchor").agg(F.sum("n").alias("n"))
    return {r.anchor: -(-r.n // limit) for r in homes.filter(F.col("n") > limit).collect()}


def replicated(fps: DataFrame, codes: int, threshold: int, pieces: dict[int, int]) -> DataFrame:
    """``anchor, piece, guest, fingerprint``: each home once, its guests in every piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = np.array(sorted(pieces), np.int64)
        into = np.array([pieces[a] for a in sorted(pieces)], np.int64)
        for batch in batches:
            every = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(every), 2_000):
                values = every[at : at + 2_000]
                index, anchor, cost = anchors(values, codes, threshold)
                own = values[index]
                copies = np.ones(len(anchor), np.int64)
                if len(hot):
                    place = np.minimum(np.searchsorted(hot, anchor), len(hot) - 1)
                    copies = np.where(hot[place] == anchor, into[place], 1)
                home = cost == 0
                mixed = (own[home] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
                yield _batch(anchor[home], mixed.astype(np.int64) % copies[home], False, own[home])
                nth = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
                yield _batch(np.repeat(anchor, copies), nth, True, np.repeat(own, copies))

    return fps.mapInArrow(run, "anchor bigint, piece int, guest boolean, fingerprint bigint")


def _batch(anchor, piece, guest, values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(anchor, pa.int64()), pa.array(piece.astype(np.int32)),
            pa.array(np.full(len(anchor), guest)), pa.array(values.view(np.int64)),
        ],
        ["anchor", "piece", "guest", "fingerprint"],
    )


class _Anchor:
    """The homes of one anchor and which of them are known to be joined."""

    def __init__(self, homes: np.ndarray):
        self.homes = homes
        self.parent = list(range(len(homes)))

    def _root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def links(self, guests: np.ndarray, threshold: int) -> Iterator[tuple[int, int]]:
        """Each guest with one home, and homes with each other, as far as that joins them."""
        step = max(1, 500_000 // max(1, len(self.homes)))
        for at in range(0, len(guests), step):
            part = guests[at : at + step]
            apart = np.bitwise_count(part[:, None] ^ self.homes[None, :])
            g, h = np.nonzero(apart <= threshold)
            last = -1
            for i, j in zip(g.tolist(), h.tolist(), strict=True):
                if part[i] == self.homes[j]:
                    continue
                if i != last:
                    last, first = i, j
                    yield int(part[i]), int(self.homes[j])
                elif (a := self._root(first)) != (b := self._root(j)):
                    self.parent[b] = a
                    yield int(self.homes[first]), int(self.homes[j])


def links(fps: DataFrame, threshold: int = THRESHOLD, codes: int | None = None) -> DataFrame:
    """Links between distinct fingerprints that join all that are linked.

    ``fps`` has one column, the distinct fingerprints, from a stored table.
    """
    count = fps.count()
    codes = codes or (1 if count <= ONE_CODE else 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, homes, held = None, [], None
        for batch in batches:
            anchor = batch.column("anchor").to_numpy()
            piece = batch.column("piece").to_numpy()
            guest = batch.column("guest").to_numpy(zero_copy_only=False)
            values = batch.column("fingerprint").to_numpy().view(np.uint64)
            turns = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(piece) != 0)) + 1
            found = []
            for lo, hi in zip([0, *turns.tolist()], [*turns.tolist(), len(anchor)], strict=True):
                if lo == hi:
                    continue
                if (anchor[lo], piece[lo]) != key:
                    key, homes, held = (anchor[lo], piece[lo]), [], None
                own = values[lo:hi]
                split = int(np.searchsorted(guest[lo:hi], True))
                if split:
                    homes.append(own[:split])
                if split < len(own) and homes:
                    held = held or _Anchor(np.concatenate(homes))
                    found.extend(held.links(own[split:], threshold))
            ends = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    spread = replicated(fps, codes, threshold, crowded(fps, codes, count)).repartition("anchor", "piece")
    return spread.sortWithinPartitions("anchor", "piece", "guest").mapInArrow(run, "a bigint, b bigint")


def _components(docs: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id, fingerprint`` of every row; ``fingerprint, least_id, root, component_id`` of the
    distinct fingerprints. An id may be the least of several components, a root is of one."""
    each = stored(fingerprints(docs), "fingerprints")
    classes = stored(
        each.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id")), "classes"
    )
    # Linked fingerprints and the least of each component; the least itself is its own.
    joined = stored(components(links(classes.select("fingerprint"), threshold)), "joined")
    roots = joined.union(joined.select("root", "root").distinct())
    named = roots.join(classes, F.col("node") == F.col("fingerprint"))
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    answers = roots.join(least, "root").select(F.col("node").alias("fingerprint"), "root", "component_id")
    found = classes.join(answers, "fingerprint", "left").select(
        "fingerprint", "least_id", F.coalesce("root", "fingerprint").alias("root"),
        F.coalesce("component_id", "least_id").alias("component_id"),
    )
    # Stored, so that both sides of a join come from shuffles and a hot fingerprint is split.
    return each, stored(found, "found")


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row."""
    each, found = _components(docs, threshold)
    return each.join(found.select("fingerprint", "component_id"), "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def kept(docs: DataFrame) -> DataFrame:
    """One row of each component, with its smallest id; all columns as they are."""
    each, found = _components(docs, THRESHOLD)
    least = found.filter(F.col("least_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(
        F.min("fingerprint").alias("kept_print"), F.min("component_id").alias("kept_id")
    )
    staying = stored(least.select("kept_id", "kept_print"), "staying")
    same_id = F.col("doc_id").eqNullSafe(F.col("kept_id"))
    repeated = each.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1")
    repeated = stored(repeated.select(F.col("doc_id").alias("repeated_id")), "repeated")
    if repeated.isEmpty():
        return docs.join(staying, same_id, "left_semi")
    # Where several rows have one id, the id alone does not say which of them stays.
    is_repeated = F.col("doc_id").eqNullSafe(F.col("repeated_id"))
    single = docs.join(repeated, is_repeated, "left_anti")
    unclear = docs.join(repeated, is_repeated, "left_semi")
    names = docs.columns
    whole = F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc_id")
    prints = fingerprints(unclear.select(whole, "text")).withColumnRenamed("doc_id", "kept_row")
    same = F.col("kept_row.doc_id").eqNullSafe(F.col("kept_id")) & (F.col("fingerprint") == F.col("kept_print"))
    once = (
        prints.join(staying, same, "left_semi")
        .select("kept_row", F.col("kept_row.doc_id").alias("id"), "fingerprint")
        .dropDuplicates(["id", "fingerprint"])
    )
    return single.join(staying, same_id, "left_semi").union(
        once.select(*[F.col(f"kept_row.`{c}`") for c in names])
    )
