"""Archive scan: byte ranges of archives to records.

Each task takes location rows and streams the ranges it was given; no archive
passes through the driver or is held whole. A location list is small as text,
so it is dealt to tasks on purpose, by the bytes its ranges stand for (``dealing``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import formats as fmt
from ..functions.text import archive_time
from ..schemas import SCANNED
from . import records
from .dealing import TASK_BYTES, dealt, location_columns
from .files import byte_range, opened

_ROWS, _BYTES = 512, 8 << 20

Decoder = Callable[[Iterable[bytes]], Iterable[tuple]]


def _batches(rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows to Arrow batches bounded by rows and by bytes, as pages differ in size."""
    names = SCANNED.fieldNames()
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    schema = pa.schema(list(zip(names, types)))
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row[4] or "")
        if len(held) >= _ROWS or size >= _BYTES:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*held), types)], schema=schema
            )
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*held), types)], schema=schema
        )


def read_ranges(
    ranges: Iterable[tuple], base: str, decoder: Decoder, failfast: bool
) -> Iterator[tuple]:
    """``key, start, end, uri, content, error`` of the records in ranges ``key, start, end``."""
    held, source, size = None, None, 0
    for key, start, end in ranges:
        start = start or 0
        path = f"{base}/{key}" if base else key
        try:
            if start < 0 or (end is not None and end <= start):
                raise ValueError(f"no such range [{start}, {end})")
            # Ranges come sorted, so an archive is opened once for all of its.
            if path != held:
                if source is not None:
                    source.close()
                held = source = None
                source, held = opened(base, key), path
                size = source.size()
            if start > size:
                raise ValueError(f"starts after the archive's end at {size}")
            for uri, content, error in decoder(byte_range(source, start, end)):
                if error and failfast:
                    raise records.DamagedRecord(f"{path}: {error}")
                yield key, start, end, uri, content, error
        except (OSError, ValueError) as problem:
            if failfast:
                raise
            yield key, start, end, None, None, f"cannot read: {problem}"
    if source is not None:
        source.close()


def _range_task(base: str, decoder: Decoder, failfast: bool):
    def ranges(batches):
        for batch in batches:
            yield from zip(*[batch.column(c).to_pylist() for c in ("key", "start", "end")])

    return lambda batches: _batches(read_ranges(ranges(batches), base, decoder, failfast))


def scan_locations(
    locations: DataFrame,
    base: str = "",
    decoder: Decoder = records.responses,
    mode: str = "PERMISSIVE",
    tasks: int | None = None,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """Response records of the archive ranges in ``locations(key, start, end)``.

    ``base`` is put before each key. Each task gets about ``task_bytes`` of neighbouring ranges,
    less where that would leave cores idle; ``tasks`` fixes their number. The ranges are
    measured by a job that runs now; those of a stream stay where they are. ``PERMISSIVE`` turns an unreadable stretch
    into a row with ``error`` set and goes on; ``FAILFAST`` stops the job.
    Returns ``key, start, end, uri, ts, content, error``.
    """
    failfast = _failfast(mode)
    base = base.rstrip("/")
    if locations.isStreaming:
        wanted = location_columns(locations)
    else:
        wanted = dealt(locations, base, tasks, task_bytes)
    return _timed(wanted.mapInArrow(_range_task(base, decoder, failfast), SCANNED))


def _file_task(decoder: Decoder, failfast: bool):
    def rows(batches):
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                key = path.as_py()
                for uri, text, error in decoder([content.as_py()]):
                    if error and failfast:
                        raise records.DamagedRecord(f"{key}: {error}")
                    yield key, 0, None, uri, text, error

    return lambda batches: _batches(rows(batches))


def scan_files(
    files: DataFrame, decoder: Decoder = records.responses, mode: str = "PERMISSIVE"
) -> DataFrame:
    """Records of archives read by the ``binaryFile`` source (``path, content``).

    For file systems only the JVM can reach. Every archive is one cell here, so
    :func:`scan_locations` is the choice for archives near a gigabyte.
    """
    task = _file_task(decoder, _failfast(mode))
    return _timed(files.select("path", "content").mapInArrow(task, SCANNED))


def _failfast(mode: str) -> bool:
    if mode not in ("PERMISSIVE", "FAILFAST"):
        raise ValueError(f"unknown mode {mode!r}")
    return mode == "FAILFAST"


def _timed(scanned: DataFrame) -> DataFrame:
    return scanned.select(
        "key", "start", "end", "uri", archive_time(F.col("key")).alias("ts"), "content", "error"
    )


def archive_listing(
    spark: SparkSession, path: str, stream: bool = False, files_per_step: int = fmt.LOOK_AHEAD
) -> DataFrame:
    """``path, length`` of the archives below a path; contents are not read."""
    if stream:
        reader = (
            spark.readStream.format("binaryFile")
            .schema("path string, modificationTime timestamp, length bigint, content binary")
            .option("maxFilesPerTrigger", files_per_step)
        )
    else:
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return reader.load(path).select("path", "length")


def pair_with_listing(locations: DataFrame, listing: DataFrame, base: str) -> DataFrame:
    """Locations with the length of their archive and an ``error`` where it does not fit.

    Both sides shuffle on the path (or Spark broadcasts the listing when it
    measures it as small), so AQE can split an archive with very many ranges.
    """
    files = listing.select(
        F.regexp_replace("path", "^file:/+", "file:///").alias("path"),
        F.col("length").alias("archive_length"),
    )
    place = F.regexp_replace(
        F.concat(F.lit(base.rstrip("/") + "/"), F.col("key")), "^file:/+", "file:///"
    )
    error = (
        F.when(F.col("archive_length").isNull(), "no such archive")
        .when(
            F.col("start") > F.col("archive_length"), "starts after the archive's end"
        )
        .when(F.col("end") > F.col("archive_length"), "ends after the archive's end")
    )
    return (
        locations.withColumn("path", place)
        .join(files, "path", "left")
        .select("key", "start", "end", "archive_length", error.alias("error"))
    )
