"""Long archive ranges cut at record boundaries, so that a huge archive is many tasks.

Archives are gzipped record by record, which lets a reader start at any member.
Where members start is not written down, so a job looks for the first one at or
after every cut point: the gzip signature, followed by bytes that unpack to the
head of an archive record. That may be a record of an archive stored inside the archive, so
every cut is proven: a second job reads on from each cut to the first later one at which
a member of its own begins, and only the cuts on the way from the range's start
are used. Then the parts hold exactly the members that one reader of the whole range sees,
whatever the size of the parts. Long archives are read twice for it.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .dealing import MEASURED, measured, spread_tasks
from .files import byte_range, opened
from .records import MAGIC, first_member_at

SIZE = 1 << 30
_WINDOW = 1 << 20


def member_start(source, near: int, stop: int) -> int | None:
    """First offset in ``[near, stop)`` where an archive record starts."""
    at = near
    while at < stop:
        source.seek(at)
        data = source.read(min(_WINDOW, stop - at))
        found = data.find(MAGIC)
        if found < 0:
            if at + len(data) >= stop:
                return None
            at += max(len(data) - len(MAGIC) + 1, 1)
            continue
        at += found
        source.seek(at)
        try:
            head = zlib.decompressobj(31).decompress(source.read(_WINDOW), 5)
        except zlib.error:
            head = b""
        if head == b"WARC/":
            return at
        at += 1
    return None


def _cut_task(base: str):
    def cut(batches):
        for batch in batches:
            cuts = []
            for row in batch.to_pylist():
                found = None
                try:
                    with opened(base, row["key"]) as source:
                        source.seek(row["start"])
                        if source.read(len(MAGIC)) == MAGIC:
                            found = member_start(source, row["near"], row["stop"])
                except (OSError, ValueError):
                    pass  # not cut; the scan reports it
                cuts.append(found)
            yield batch.append_column("cut", pa.array(cuts, pa.int64()))

    return cut


def _proof_task(base: str):
    """Adds ``reached``: the later cut at which a reader that starts at ``cut`` begins a member."""

    def prove(batches):
        for batch in batches:
            reached = []
            for row in batch.to_pylist():
                try:
                    with opened(base, row["key"]) as source:
                        later = {c - row["cut"] for c in row["cuts"] if c > row["cut"]}
                        found = later and first_member_at(
                            byte_range(source, row["cut"], row["stop"]), later
                        )
                except (OSError, ValueError):
                    found = None
                reached.append(row["cut"] + found if found else None)
            yield batch.append_column("reached", pa.array(reached, pa.int64()))

    return prove


def cut_long_ranges(locations: DataFrame, base: str = "", size: int = SIZE) -> DataFrame:
    """Ranges ``key, start, end`` with those longer than about ``size`` cut into several.

    Archives of the usual gigabyte stay whole. What cannot be cut (an archive
    that is not gzipped, a single huge record) stays as it is.
    """
    base = base.rstrip("/")
    spark = locations.sparkSession
    ranges = measured(locations, base).drop("part", "row")
    is_long = F.coalesce(F.col("stop") - F.col("start") > size, F.lit(False))
    if ranges.filter(is_long).isEmpty():
        return ranges.select("key", "start", "end")
    whole = ranges.filter(~is_long).select("key", "start", "end")

    # A range has at most length / size cut points, each a row of a few bytes.
    near = F.explode(F.sequence(F.col("start") + size, F.col("stop") - 1, F.lit(size)))
    points = ranges.filter(is_long).withColumn("near", near)
    points = points.repartitionByRange(spread_tasks(spark), "key", "near", "piece")
    cuts = points.mapInArrow(_cut_task(base), f"{MEASURED}, near bigint, cut bigint")
    one = ["key", "start", "end", "piece"]
    # The range's own start is a cut too; a record longer than ``size`` gives the
    # same cut for several points.
    starts = (
        cuts.select(*one, "stop", F.explode(F.array("start", "cut")).alias("cut"))
        .filter(F.col("cut").isNotNull())
        .distinct()
    )
    # Cuts of a range are few: its length by ``size``.
    every = F.sort_array(F.collect_list("cut").over(Window.partitionBy(*one)))
    candidates = starts.select(*one, "stop", "cut", every.alias("cuts"))
    candidates = candidates.repartitionByRange(spread_tasks(spark), "key", "cut", "piece")
    proven = candidates.mapInArrow(
        _proof_task(base), f"{MEASURED}, cut bigint, cuts array<bigint>, reached bigint"
    )
    steps = proven.groupBy(*one).agg(
        F.sort_array(F.collect_list(F.struct("cut", "reached"))).alias("steps")
    )
    # From the start along what was reached; other cuts are inside a record.
    first = F.struct(
        F.col("start").alias("at"), F.expr("cast(array() as array<bigint>)").alias("kept")
    )
    walked = F.aggregate(
        "steps",
        first,
        lambda seen, step: F.when(
            step["cut"] == seen["at"],
            F.struct(
                step["reached"].alias("at"),
                F.concat(seen["kept"], F.array(step["cut"])).alias("kept"),
            ),
        ).otherwise(seen),
    )["kept"]
    used = steps.select("key", "end", walked.alias("kept")).select(
        "key", "end", "kept", F.posexplode("kept").alias("n", "cut")
    )
    parts = used.select(
        "key", F.col("cut").alias("start"),
        F.coalesce(F.get("kept", F.col("n") + 1), F.col("end")).alias("end"),
    )
    return whole.unionByName(parts)
