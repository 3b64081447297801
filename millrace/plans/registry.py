"""Named sources, transformations and sinks, and the job that joins them up.

A source is ``(spark, input, **options) -> DataFrame`` of records, a
transformation ``DataFrame -> DataFrame`` (so it serves batch and stream alike),
a sink ``(DataFrame, path) -> None``. User code adds its own under new names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sinks
from ..operators import articles, movies
from ..sources import archives, cuts, locations, tables

Source = Callable[..., DataFrame]
Transform = Callable[[DataFrame], DataFrame]
Sink = Callable[[DataFrame, str], None]


def archive_index(spark: SparkSession, index: str, base: str = "", **options) -> DataFrame:
    """Records of the archives listed in an index file; huge archives are split."""
    listed = locations.read_locations(spark, index, strict=True)
    listed = cuts.cut_long_ranges(listed, base)
    return archives.scan_locations(listed, base, **options).select("uri", "ts", "content", "error")


def capture_index(spark: SparkSession, index: str, base: str = "", **options) -> DataFrame:
    """Records of the captures listed in a capture index; lines that are none are error rows."""
    listed = locations.read_captures(spark, index)
    records = archives.scan_locations(listed.filter(F.col("error").isNull()), base, **options)
    unread = listed.filter(F.col("error").isNotNull()).select(
        F.lit(None).cast("string").alias("uri"), F.lit(None).cast("timestamp").alias("ts"),
        F.lit(None).cast("string").alias("content"), "error",
    )
    return records.select("uri", "ts", "content", "error").union(unread)


# --- Fixed values: the names users put on the command line -------------------
SOURCES: dict[str, Source] = {
    "warc-index": archive_index,
    "cdx-index": capture_index,
    "csv-file": tables.read_csv_records,
    "btc": tables.read_landed_payloads,
}
TRANSFORMS: dict[str, Transform] = {
    "news": articles.articles,
    "copy": articles.copy,
    "rottentomatoes": movies.extract_scores,
}
SINKS: dict[str, Sink] = {
    "parquet": sinks.write_parquet,
    "encoded": sinks.write_encoded,
    "json": sinks.write_json,
    "quarantine": sinks.write_with_quarantine,
}
# -----------------------------------------------------------------------------


def _named(kind: str, known: dict, name: str):
    if name not in known:
        raise ValueError(f"unknown {kind} {name!r}; known: {', '.join(sorted(known))}")
    return known[name]


def register(kind: dict, name: str, function: Callable) -> None:
    if name in kind:
        raise ValueError(f"{name!r} is taken")
    kind[name] = function


def compose(
    spark: SparkSession, source: str, transform: str, source_input: str, **options
) -> DataFrame:
    """Source and transformation as one DataFrame.

    It is lazy but for the archive index, where listing and cutting the ranges of long archives
    are jobs of their own that run now.
    """
    records = _named("source", SOURCES, source)(spark, source_input, **options)
    return records.transform(_named("transform", TRANSFORMS, transform))


def run(
    spark: SparkSession,
    source: str,
    transform: str,
    source_input: str,
    output: str,
    sink: str = "parquet",
    **options,
) -> None:
    """A whole crawl job: read, transform, append the results."""
    rows = compose(spark, source, transform, source_input, **options)
    _named("sink", SINKS, sink)(rows, output)
