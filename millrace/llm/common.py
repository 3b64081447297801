"""What several operators share: given tables, stored steps, numbering, row identity.

Operators look at two columns of their input, an id and a text, and pick them by
name first, so further columns of any name do not disturb them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(rows: DataFrame) -> DataFrame:
    """``doc_id, text`` alone; a missing text is an empty one."""
    return rows.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def stored(rows: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared scratch folder and read back.

    It cuts the lineage, fixes what tasks numbered or drew, and outlives lost
    executors.
    """
    place = scratch_path(rows.sparkSession, label)
    rows.write.parquet(place)
    return rows.sparkSession.read.schema(rows.schema).parquet(place)


def placed(rows: DataFrame) -> DataFrame:
    """Adds ``part`` and ``row``, which :func:`numbered` counts by. Store the result."""
    return rows.withColumn("part", F.spark_partition_id()).withColumn(
        "row", F.monotonically_increasing_id()
    )


def numbered(rows: DataFrame, key: str, name: str) -> DataFrame:
    """A gapless number from 0 per ``key``, in the order of ``part`` and ``row``.

    A key may hold most of the rows: rows are counted within their part, and only
    one count per part and key meets in the window over the key.
    """
    within = Window.partitionBy("part", key).orderBy("row")
    before = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("part", key).agg(F.count("*").alias("n"))
    base = counts.select("part", key, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = rows.withColumn("nth", F.row_number().over(within) - 1)
    return (
        ranked.join(base, ["part", key])
        .withColumn(name, F.col("base") + F.col("nth"))
        .drop("base", "nth")
    )


def without(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """``rows`` whose doc_id is not among ``dropped``; a missing id is an id like any other."""
    gone = dropped.select(F.col("doc_id").alias("gone_id")).distinct()
    return rows.join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id")), "left_anti")


def fold(of: int) -> Column:
    """The fold of a row: crc32 of its id as text, modulo ``of``."""
    return F.crc32(F.col("doc_id").cast("string")) % of


def label_sample(labels: DataFrame, label: str, of: int, held_out: int, most: int) -> DataFrame:
    """``doc_id, label`` of about ``most`` labelled rows outside the held-out fold.

    Rows are chosen by a hash of their id, so every run chooses the same; of
    several labels of one id the largest counts, missing ones none. The result
    is small enough to broadcast.
    """
    usable = labels.filter(
        F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold(of) != held_out)
    )
    rows = usable.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    count = rows.count()
    if count > most:
        span = 1 << 30
        rows = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(span)) < span * most // count)
    return rows
