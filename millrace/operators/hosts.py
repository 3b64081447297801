"""Host distribution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.once import once
from ..functions.text import host_of


def _no_host():
    return F.concat(F.lit("Could not extract domain from "), F.col("uri"))


def with_host(rows: DataFrame) -> DataFrame:
    """Rows with ``host`` and, where a URI has none, ``error``."""
    hosted = once(rows, host=host_of(F.col("uri")))
    missing = F.col("uri").isNotNull() & F.col("host").isNull()
    return hosted.withColumn("error", F.when(missing, _no_host()))


def host_distribution(rows: DataFrame, strict: bool = False) -> DataFrame:
    """``host, count``, most frequent first; rows without URI do not count.

    A URI without host is left to the quarantine, or stops the job when
    ``strict``. Counts are combined before the shuffle, so a host with most of
    the pages costs one row per task.
    """
    uri = F.col("uri")
    host = host_of(uri)
    if strict:
        host = F.coalesce(host, F.raise_error(_no_host()).cast("string"))
    return (
        once(rows.filter(uri.isNotNull()).select("uri"), host=host)
        .filter(F.col("host").isNotNull())
        .groupBy("host")
        .count()
        .orderBy(F.desc("count"), "host")
    )


def report_lines(distribution: DataFrame) -> DataFrame:
    return distribution.select(
        F.concat_ws(": ", "host", F.col("count").cast("string")).alias("line")
    )
