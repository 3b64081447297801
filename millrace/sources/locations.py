"""Location indexes: text lines to archive byte ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.once import once
from ..functions.text import range_end, trim_space
from ..schemas import CAPTURE


def parse_locations(lines: DataFrame, strict: bool = False) -> DataFrame:
    """``key [offset [length]]`` lines to ``key, start, end, error``; blank lines go.

    Other lines get an ``error``, or stop the job when ``strict``.
    """
    line = trim_space(F.col("value"))
    fields = F.col("fields")
    count = F.size(fields)
    start = F.when(count == 1, F.lit(0)).otherwise(F.get(fields, F.lit(1)).try_cast("bigint"))
    length = F.get(fields, F.lit(2)).try_cast("bigint")
    bad = (count > 3) | start.isNull() | (start < 0) | (
        (count == 3) & F.coalesce(length < 0, F.lit(True))
    )
    malformed = F.concat(F.lit("malformed location line: "), F.array_join(fields, " "))
    error = F.when(bad, F.raise_error(malformed) if strict else malformed)
    split = once(lines, fields=F.split(line, " "))
    return split.filter(F.get(fields, F.lit(0)) != "").select(
        F.when(~bad, F.get(fields, F.lit(0))).alias("key"),
        F.when(~bad, start).alias("start"),
        F.when(~bad & (count == 3), range_end(start, length)).alias("end"),
        error.alias("error"),
    )


def read_locations(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    return parse_locations(spark.read.text(path), strict)


def parse_captures(lines: DataFrame) -> DataFrame:
    """Capture-index lines ``<url key> <time> {json}`` to ``key, start, end, error``."""
    return parse_keyed_captures(lines).select("key", "start", "end", "error")


def parse_keyed_captures(lines: DataFrame) -> DataFrame:
    """As :func:`parse_captures`, with the ``url_key`` and the time ``ts`` that a line begins with.

    A time that is none is NULL and no error, as the range can be read without it.
    """
    entry = F.from_json(
        F.regexp_extract("value", r"^.* (\{.*)$", 1), CAPTURE, {"mode": "PERMISSIVE"}
    )
    parsed = once(lines, entry=entry)
    start = F.col("entry.offset").try_cast("bigint")
    length = F.col("entry.length").try_cast("bigint")
    end = range_end(start, length)
    bad = F.col("entry.filename").isNull() | ~F.coalesce((start >= 0) & (length >= 0), F.lit(False))
    stamp = F.get(F.split("value", " ", 3), F.lit(1))
    return parsed.select(
        F.substring_index("value", " ", 1).alias("url_key"),
        F.try_to_timestamp(stamp, F.lit("yyyyMMddHHmmss")).alias("ts"),
        F.col("entry.filename").alias("key"),
        start.alias("start"),
        end.alias("end"),
        F.when(bad, "malformed capture line").alias("error"),
    )


def write_capture_table(captures: DataFrame, path: str, group_bytes: int = 8 << 20) -> None:
    """Well-formed captures as Parquet in the order of their URL keys, in small row groups.

    Ranges are drawn over all that tells captures apart, so a key with most of them is in several files.
    """
    order = ["url_key", "ts", "key", "start"]
    kept = captures.filter(F.col("error").isNull()).drop("error")
    sorted_ = kept.repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_.write.option("parquet.block.size", group_bytes).parquet(path)


def captures_below(spark: SparkSession, path: str, prefix: str) -> DataFrame:
    """Captures of a table whose URL key begins with the prefix; row groups of other keys are not read."""
    schema = "url_key string, ts timestamp, key string, start bigint, end bigint"
    return spark.read.schema(schema).parquet(path).filter(F.col("url_key").startswith(prefix))


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    return parse_captures(spark.read.text(path))
