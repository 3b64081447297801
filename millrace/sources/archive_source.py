"""Archives as a data source: ``spark.read.format("archives").load(folder)``.

The source plans its own partitions. It lists the folder (or takes the ranges of a
Parquet table, as ``cuts`` leaves them), drops the archives that filters on ``key`` and ``ts``
rule out, and deals the rest to partitions by their bytes. An archive that is ruled out is never
opened. Both columns follow from an archive's name, so these filters are decided here
for good; all others stay with Spark.

Options: ``ranges``, a Parquet folder of ``key, start, end``, else each archive is one range;
``taskBytes``; ``mode``, ``PERMISSIVE`` or ``FAILFAST``. The plan holds a few bytes for each range, on the
driver, as Spark's own file listings do; a list of a range for every record is for
``archives.scan_locations``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import datasource as ds

from ..functions import formats as fmt
from . import records
from .archives import read_ranges
from .dealing import OPENING, TASK_BYTES
from .files import arrow_path, listed, opened

NAME = "archives"
SCHEMA = "key string, start bigint, end bigint, uri string, ts timestamp, content string, error string"
_ARROW = pa.schema(
    [
        ("key", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("uri", pa.string()),
        ("ts", pa.timestamp("us", tz="UTC")), ("content", pa.string()), ("error", pa.string()),
    ]
)
_ROWS, _BYTES = 512, 8 << 20
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
# Filters that compare a column with one value.
_COMPARED = {
    ds.EqualTo: lambda v, w: v == w,
    ds.EqualNullSafe: lambda v, w: v == w,
    ds.GreaterThan: lambda v, w: v > w,
    ds.GreaterThanOrEqual: lambda v, w: v >= w,
    ds.LessThan: lambda v, w: v < w,
    ds.LessThanOrEqual: lambda v, w: v <= w,
    ds.In: lambda v, w: v in w,
    ds.StringStartsWith: lambda v, w: v.startswith(w),
    ds.StringEndsWith: lambda v, w: v.endswith(w),
    ds.StringContains: lambda v, w: w in v,
}


def key_time(key: str) -> int:
    """Crawl time told by an archive's name, in microseconds since the epoch, as
    ``functions.text.archive_time`` has it."""
    if found := re.search(fmt.ARCHIVE_STAMP, key):
        try:
            return _micros(datetime.strptime(found[1], "%Y%m%d%H%M%S"))
        except ValueError:
            pass
    if (found := re.search(fmt.ARCHIVE_EPOCH_MS, key)) and int(found[1]) < 1 << 63:
        return int(found[1]) // 1000 * 1_000_000
    return 0


def _micros(value):
    """Times as numbers; other values as they are."""
    if isinstance(value, datetime):
        aware = value if value.tzinfo else value.replace(tzinfo=timezone.utc)
        return (aware - _EPOCH) // timedelta(microseconds=1)
    if isinstance(value, (tuple, list)):
        return tuple(map(_micros, value))
    return value


def wanted(filter: ds.Filter):
    """A test of ``key, time`` for a filter that names decide; None for others."""
    if isinstance(filter, ds.Not):
        inner = wanted(filter.child)
        # Neither column is ever missing, so nothing but the value decides.
        return inner and (lambda key, ts: not inner(key, ts))
    if getattr(filter, "attribute", None) not in (("key",), ("ts",)):
        return None
    of_key = filter.attribute == ("key",)
    if isinstance(filter, ds.IsNotNull):
        return lambda key, ts: True
    if isinstance(filter, ds.IsNull):
        return lambda key, ts: False
    compare = _COMPARED.get(type(filter))
    value = _micros(filter.value) if compare else None
    if value is None or (isinstance(value, tuple) and None in value):
        return None
    return lambda key, ts: compare(key if of_key else ts, value)


@dataclass
class Ranges(ds.InputPartition):
    """What one task reads: ``key, start, end``, in order."""

    ranges: list


def deal(ranges: list[tuple], task_bytes: int) -> list[Ranges]:
    """Ranges ``key, start, end, bytes`` as partitions of neighbours with about equally many bytes."""
    ranges = sorted(ranges, key=lambda r: (r[0], r[1]))
    total = sum(max(0, r[3]) + OPENING for r in ranges)
    tasks = max(1, -(-total // task_bytes))
    parts: dict[int, list] = {}
    before = 0
    for key, start, end, size in ranges:
        weight = max(0, size) + OPENING
        parts.setdefault(min(tasks - 1, (before + weight // 2) * tasks // total), []).append((key, start, end))
        before += weight
    return [Ranges(parts[p]) for p in sorted(parts)]


class ArchiveSource(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ds.DataSourceReader:
        return ArchiveReader(self.options)


class ArchiveReader(ds.DataSourceReader):
    def __init__(self, options):
        self.base = options["path"].rstrip("/")
        self.table = options.get("ranges")
        self.task_bytes = int(options.get("taskBytes", TASK_BYTES))
        self.failfast = options.get("mode", "PERMISSIVE").upper() == "FAILFAST"
        self.tests: list = []

    def pushFilters(self, filters):
        for f in filters:
            test = wanted(f)
            if test is None:
                yield f
            else:
                self.tests.append(test)

    def _stored(self) -> list[tuple]:
        import pyarrow.dataset as arrow

        system, root = arrow_path(self.table)
        rows = arrow.dataset(root, filesystem=system, format="parquet").to_table(["key", "start", "end"])
        return list(zip(*[rows.column(c).to_pylist() for c in ("key", "start", "end")]))

    def partitions(self) -> list[Ranges]:
        if self.table:
            sizes: dict[str, int] = {}
            ranges = []
            for key, start, end in self._stored():
                if not self._chosen(key):
                    continue
                start = start or 0
                if end is None and key not in sizes:
                    try:
                        with opened(self.base, key) as source:
                            sizes[key] = source.size()
                    except (OSError, ValueError):
                        sizes[key] = 0  # the task reports it
                ranges.append((key, start, end, (sizes[key] if end is None else end) - start))
        else:
            ranges = [(key, 0, None, size) for key, size in listed(self.base) if self._chosen(key)]
        # A source must have a partition, if an empty one.
        return deal(ranges, self.task_bytes) if ranges else [Ranges([])]

    def _chosen(self, key: str) -> bool:
        ts = key_time(key)
        return all(test(key, ts) for test in self.tests)

    def read(self, partition: Ranges):
        held, size = [], 0
        for key, start, end, uri, content, error in read_ranges(
            partition.ranges, self.base, records.responses, self.failfast
        ):
            held.append((key, start, end, uri, key_time(key), content, error))
            size += len(content or "")
            if len(held) >= _ROWS or size >= _BYTES:
                yield _batch(held)
                held, size = [], 0
        if held:
            yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW)


def register(spark: SparkSession) -> None:
    """Make the source known to a session, and let it see filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ArchiveSource)
