"""Lookup joins that survive hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with more rows than this is spread over several tasks.
ROWS_PER_TASK = 4_000_000
_SPAN = 100_000


def hot_keys(weights: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """``key, salts`` of the keys with more rows than a task should take.

    ``weights`` holds ``key, n``, one row per key. All keys above the limit are
    listed: rows / limit of them at most, 250,000 in a million million rows, so the list may be
    broadcast.
    """
    limit = rows_per_task or ROWS_PER_TASK
    return weights.filter(F.col("n") > limit).select(
        "key", F.ceil(F.col("n") / limit).cast("int").alias("salts")
    )


def heavy_keys(
    table: DataFrame, key: str, n: str, rows_per_task: int | None = None
) -> DataFrame | None:
    """Hot keys of a stored table that counts rows per key; None if no key is hot.

    One look at the largest count spares the usual case, a table without hot
    keys, all of the salting.
    """
    heaviest = table.agg(F.max(n)).first()[0] or 0
    if heaviest <= (rows_per_task or ROWS_PER_TASK):
        return None
    return hot_keys(table.select(F.col(key).alias("key"), F.col(n).alias("n")), rows_per_task)


def in_pieces(rows: DataFrame, most: int) -> DataFrame:
    """Equal rows as numbered pieces: adds ``piece`` and ``copies``, at most ``most`` each.

    Equal rows fall into one range of a range partitioning, however many there
    are. Counted before the shuffle and cut into pieces they can be told apart.
    """
    counted = rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))
    last = F.floor((F.col("n") - 1) / most)
    # In two steps, so that no array is longer than a span.
    block = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(last / _SPAN)))
    begin = F.col("block") * _SPAN
    piece = F.explode(F.sequence(begin, F.least(begin + (_SPAN - 1), last)))
    return counted.withColumn("block", block).withColumn("piece", piece).select(
        *rows.columns, "piece",
        F.least(F.lit(most), F.col("n") - F.col("piece") * most).alias("copies"),
    )


def sort_whole(rows: DataFrame, *by: str) -> DataFrame:
    """Global sort in which neither a hot key nor a mass of equal rows meets in one task.

    A row number as the last sort key tells equal rows apart, so the ranges of the one
    shuffle may part them.
    """
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    return numbered.orderBy(*by, "_row").drop("_row")


def lookup(
    rows: DataFrame,
    key: str,
    table: DataFrame,
    hot: DataFrame | None = None,
    spread_by: str | None = None,
    seed: int = 17,
) -> DataFrame:
    """Left join of ``rows`` with ``table`` on ``key``, unique in ``table``.

    With ``hot`` given, rows of a hot key are spread over its salts and the one
    table row is repeated per salt. Every salt finds the same match, so the
    result does not depend on who goes where. Rows go by the hash of
    ``spread_by``, a column that differs among the rows of a key; or at random,
    where there may be equal rows. In that case ``rows`` should come from files,
    so that a repeated task draws alike.
    """
    if hot is None:
        return rows.join(table, key, "left")
    hot = F.broadcast(hot.withColumnRenamed("key", key))
    salts = F.coalesce(F.col("salts"), F.lit(1))
    if spread_by:
        salt = F.pmod(F.xxhash64(spread_by), salts).cast("int")
    else:
        salt = F.floor(F.rand(seed) * salts).cast("int")
    spread = rows.join(hot, key, "left").withColumn("salt", salt)
    copies = table.join(hot, key, "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), salts - 1))
    )
    return spread.drop("salts").join(copies.drop("salts"), [key, "salt"], "left").drop("salt")
