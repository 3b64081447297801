"""Token ids as binary files of patched frame-of-reference blocks, and back.

Documents are dealt to files by ranges of doc_id and sorted within, so the files
in their order hold all ids in ascending doc_id. A task writes its files one after another, block by
block, and names them in the rows it returns; the list of files, written by Spark,
holds those of tasks that succeeded, so a repeated task leaves no doubt. A file ends with the document that
fills it, so its index, which is held whole, is bounded whatever a task gets. A file is
``blocks, block starts u64, ids' ends per document u64, doc_ids i64, missing-id
flags u8``, then ``ids u64, blocks u64, documents u64, magic``. The index lets
any block or document be read alone.

Cases: a missing or empty text has the end id alone. A missing id sorts first.
Rows with one id are ordered by a hash of their text, and rows equal in both are
interchangeable. An empty table gives no file and no row. doc_id must be an integer.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from . import pfor
from .common import id_and_text, stored
from .vocab import encoder, tokenizer_path

END = 2
MAGIC = b"MRPFOR01"
TAIL = "<QQQ8s"
TAIL_SIZE = struct.calcsize(TAIL)
# A file ends when it has so many ids or documents.
FILE_IDS, FILE_DOCS = 128 * 1024 * 1024, 1_000_000
# Ids that are encoded or decoded at a time.
AT_ONCE = 256 * 1024 // pfor.BLOCK * pfor.BLOCK


def _open(place: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(place)


class _Writer:
    """One file: takes documents, encodes whole blocks as they fill."""

    def __init__(self, place: str, task: int, nth: int):
        self.part = (task << 32) + nth
        name = f"{task:06d}-{nth:06d}-{uuid.uuid4().hex}.pfor"
        system, root = _open(place)
        system.create_dir(root, recursive=True)
        self.path = f"{place}/{name}"
        self._out = system.open_output_stream(f"{root}/{name}")
        self._held: list[bytes] = []
        self._size = self._written = self.ids = self.docs = 0
        self._starts: list[np.ndarray] = []
        self._ends: list[int] = []
        self._names: list[int | None] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self._held.append(ids)
        self._size += len(ids) // 4
        self.ids += len(ids) // 4
        self._ends.append(self.ids)
        self._names.append(doc_id)
        self.docs += 1
        if self._size >= AT_ONCE:
            self._flush(self._size // AT_ONCE * AT_ONCE)

    def _flush(self, count: int) -> None:
        held = np.frombuffer(b"".join(self._held), "<u4")
        for at in range(0, count, AT_ONCE):
            raw, begin = pfor.encode(held[at : min(count, at + AT_ONCE)])
            self._starts.append(begin + self._written)
            self._out.write(raw)
            self._written += len(raw)
        self._held, self._size = [held[count:].tobytes()], len(held) - count

    def close(self) -> pa.RecordBatch:
        self._flush(self._size)
        starts = np.concatenate([np.zeros(0, np.int64), *self._starts])
        missing = np.array([n is None for n in self._names], np.uint8)
        for column, kind in (
            (starts, "<u8"), (self._ends, "<u8"), ([n or 0 for n in self._names], "<i8"), (missing, "u1"),
        ):
            self._out.write(np.asarray(column, kind).tobytes())
        self._out.write(struct.pack(TAIL, self.ids, len(starts), len(self._names), MAGIC))
        self._out.close()
        row = {"part": self.part, "path": self.path, "n_ids": self.ids, "n_docs": self.docs, "n_bytes": self._written}
        return pa.RecordBatch.from_pylist([row])


def write_tokens(
    docs: DataFrame, place: str | None = None, tokenizer: str | None = None, end: int = END, special: bool = False,
    file_ids: int = FILE_IDS, file_docs: int = FILE_DOCS,
) -> DataFrame:
    """The list of files written: ``part, path, n_ids, n_docs, n_bytes, first_id``.

    ``part`` orders the files; ``first_id`` is the number of ids in the files before.
    """
    spark = docs.sparkSession
    place = place or scratch_path(spark, "tokens")
    path = tokenizer or tokenizer_path()
    close = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, nth, writer = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            every = encoder(path, special).encode(batch.column("text"))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), every, strict=True):
                writer = writer or _Writer(place, task, nth)
                writer.add(doc_id, ids + close)
                if writer.ids >= file_ids or writer.docs >= file_docs:
                    yield writer.close()
                    writer, nth = None, nth + 1
        if writer:
            yield writer.close()

    order = ["doc_id", "tie"]
    rows = id_and_text(docs).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text",
        F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"),
    )
    # The row number splits masses of equal rows between ranges.
    dealt = rows.repartitionByRange(*order, "row").sortWithinPartitions(*order, "row")
    files = stored(
        dealt.select("doc_id", "text").mapInArrow(
            run, "part bigint, path string, n_ids bigint, n_docs bigint, n_bytes bigint"
        ),
        "token-files",
    )
    # One row per file, not per document.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _documents(path: str, first: int) -> Iterator[tuple[int | None, int, bytes]]:
    """``doc_id, start, ids`` of each document of a file, read in runs of blocks."""
    place, name = path.rsplit("/", 1)
    system, root = _open(place)
    with system.open_input_file(f"{root}/{name}") as file:
        size = file.size()
        ids, blocks, count, magic = struct.unpack(TAIL, file.read_at(TAIL_SIZE, size - TAIL_SIZE))
        if magic != MAGIC:
            raise ValueError(f"{path} is no token file")
        width = 8 * blocks + 17 * count
        index = file.read_at(width, size - TAIL_SIZE - width)
        starts = np.frombuffer(index, "<u8", blocks).astype(np.int64)
        ends = np.frombuffer(index, "<u8", count, 8 * blocks).astype(np.int64)
        names = np.frombuffer(index, "<i8", count, 8 * (blocks + count)).tolist()
        missing = np.frombuffer(index, "u1", count, 8 * (blocks + 2 * count))
        body = size - TAIL_SIZE - width
        nth, begin, parts = 0, 0, []
        run = AT_ONCE // pfor.BLOCK
        for block in range(0, blocks, run):
            low = int(starts[block])
            high = int(starts[block + run]) if block + run < blocks else body
            raw = np.frombuffer(file.read_at(high - low, low), np.uint8)
            at = block * pfor.BLOCK
            held = pfor.decode(raw, starts[block : block + run] - low, min(ids - at, AT_ONCE))
            while nth < count:
                stop = int(ends[nth]) - at
                parts.append(held[max(0, begin - at) : stop].tobytes())
                if stop > len(held):
                    break
                yield None if missing[nth] else names[nth], first + begin, b"".join(parts)
                nth, begin, parts = nth + 1, int(ends[nth]), []


def read_tokens(spark: SparkSession, files: DataFrame) -> DataFrame:
    """``doc_id, start, ids`` of the documents in the files; ids little-endian unsigned 32-bit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first in zip(*[batch.column(c).to_pylist() for c in ("path", "first_id")], strict=True):
                held, size = [], 0
                for row in _documents(path, first):
                    held.append(row)
                    size += len(row[2])
                    if size > 4_000_000:
                        yield _rows(held)
                        held, size = [], 0
                yield _rows(held)

    # One task per file, as files are of bounded size.
    count = max(1, files.count())
    dealt = files.select("path", "first_id").repartitionByRange(count, "first_id")
    return dealt.mapInArrow(run, "doc_id bigint, start bigint, ids binary")


def _rows(held: list[tuple]) -> pa.RecordBatch:
    names, starts, ids = zip(*held, strict=True) if held else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.int64()), pa.array(starts, pa.int64()), pa.array(ids, pa.binary())],
        ["doc_id", "start", "ids"],
    )
