"""Sequence packing by shortest-pack-first over the histogram of lengths.

Documents become pieces of at most one sequence: full ones, and the rest of the
document cut in two where it is longer than half. Lengths are placed longest first,
each into the packs that are shortest so far, many equal packs at a time, so the
planning works on the histogram (at most one count per length) and gives patterns
with counts. Patterns then claim ranges of ranks per length, and pieces are joined
with them by their rank among the pieces of their length.

Cases: a missing or empty text is the separator alone. Missing ids and repeated rows
are documents like any other. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, numbered, placed, stored
from .vocab import encoder, tokenizer_path

CAPACITY = 1024
SEPARATOR = 0


def cuts(total: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document."""
    full, rest = divmod(total, capacity)
    half = capacity // 2
    return [capacity] * full + ([half, rest - half] if rest > half else [rest] if rest else [])


def tokenized_pieces(
    docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, separator: int = SEPARATOR,
    special: bool = False,
) -> DataFrame:
    """``doc_id, start, length, doc_tokens, ids`` of the pieces; ids little-endian unsigned 32-bit."""
    path = tokenizer or tokenizer_path()
    close = np.array([separator], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, starts, lengths, totals, pieces, size = [], [], [], [], [], 0
            for i, ids in enumerate(encoder(path, special).encode(batch.column("text"))):
                ids += close
                at = 0
                for length in cuts(len(ids) // 4, capacity):
                    which.append(i)
                    starts.append(at)
                    lengths.append(length)
                    totals.append(len(ids) // 4)
                    pieces.append(ids[4 * at : 4 * (at + length)])
                    at += length
                size += len(ids)
                if size > 4_000_000:
                    yield _pieces(batch, which, starts, lengths, totals, pieces)
                    which, starts, lengths, totals, pieces, size = [], [], [], [], [], 0
            yield _pieces(batch, which, starts, lengths, totals, pieces)

    rows = id_and_text(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, start bigint, length bigint, doc_tokens bigint, ids binary"
    )


def _pieces(batch: pa.RecordBatch, which, starts, lengths, totals, pieces) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id").take(pa.array(which, pa.int64())),
            *[pa.array(c, pa.int64()) for c in (starts, lengths, totals)],
            pa.array(pieces, pa.binary()),
        ],
        ["doc_id", "start", "length", "doc_tokens", "ids"],
    )


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how many sequences follow each.

    A length either uses up a group of equal packs, or splits the last group it
    touches, and opens at most two, so there are at most three groups per length.
    """
    groups: list[tuple[int, int, tuple[int, ...], int]] = []  # used, order, pattern, count
    order = 0

    def put(pattern: tuple[int, ...], count: int) -> None:
        nonlocal order
        if count:
            order += 1
            heapq.heappush(groups, (sum(pattern), order, pattern, count))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left and groups and groups[0][0] + length <= capacity:
            _, _, pattern, count = heapq.heappop(groups)
            taken = min(left, count)
            left -= taken
            put((*pattern, length), taken)
            put(pattern, count - taken)
        # Nothing fits: a new pack is the shortest until it is full.
        many, rest = divmod(left, capacity // length)
        put((length,) * (capacity // length), many)
        put((length,) * rest, 1 if rest else 0)
    return [(pattern, count) for _, _, pattern, count in sorted(groups)]


def claims(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """``length, from_rank, to_rank, first_sequence, at``: which ranks each slot takes."""
    taken: dict[int, int] = {}
    found, sequence = [], 0
    for pattern, count in patterns:
        at = 0
        for length in pattern:
            low = taken.get(length, 0)
            taken[length] = low + count
            found.append((length, low, low + count, sequence, at))
            at += length
        sequence += count
    return found


def packed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; their ``length`` is 1 to capacity.

    Other columns ride along; ``part``, ``row``, ``rank`` and those of the claims are taken.
    """
    rows = stored(placed(pieces), "pieces")
    histogram = {r.length: r.n for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = rows.sparkSession.createDataFrame(
        claims(plan(histogram, capacity)),
        "slot_length bigint, from_rank bigint, to_rank bigint, first_sequence bigint, at bigint",
    )
    # At most 3 * capacity patterns of at most capacity lengths: 130 MB, and some kB in practice.
    ranked = numbered(rows, "length", "rank").join(
        F.broadcast(slots),
        (F.col("length") == F.col("slot_length"))
        & (F.col("rank") >= F.col("from_rank"))
        & (F.col("rank") < F.col("to_rank")),
    )
    return ranked.select(
        *pieces.columns,
        (F.col("first_sequence") + F.col("rank") - F.col("from_rank")).alias("sequence_id"),
        F.col("at").alias("offset"),
    )


def sequences(pieces: DataFrame) -> DataFrame:
    """``sequence_id, ids, lengths`` of packed pieces that carry their ids."""
    item = F.struct("offset", "length", "ids")
    held = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(item)).alias("items"))
    return held.select(
        "sequence_id",
        F.aggregate("items", F.lit(b""), lambda a, i: F.concat(a, i["ids"])).alias("ids"),
        F.transform("items", lambda i: i["length"]).alias("lengths"),
    )
