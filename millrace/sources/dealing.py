"""Byte ranges dealt to tasks by their bytes.

A location row is few bytes but stands for as much work as its range is long. So ranges are
put in order, their bytes summed up to each of them, and the sum decides the task: every
task gets neighbouring ranges of about the same number of bytes, whatever the number of rows.
A range that alone is longer than a task's share is a task alone; ``cuts`` cuts it first.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.skew import in_pieces
from ..schemas import LOCATION
from ..session import scratch_path
from .files import opened

# Bytes of a task, what opening an archive counts for besides, and a range of one that is open already.
TASK_BYTES, OPENING, SEEKING = 256 << 20, 64 << 10, 4 << 10
MEASURED = "key string, start bigint, end bigint, piece bigint, stop bigint"


def spread_tasks(spark: SparkSession) -> int:
    """Tasks that occupy all cores a few times."""
    return max(
        4 * spark.sparkContext.defaultParallelism,
        int(spark.conf.get("spark.sql.shuffle.partitions")),
    )


def location_columns(locations: DataFrame) -> DataFrame:
    return locations.select(*[F.col(f.name).cast(f.dataType) for f in LOCATION])


def _sizes(base: str):
    """Adds ``stop``, the size of the file, to ranges without an end."""

    def measure(batches):
        for batch in batches:
            stops = []
            for key in batch.column("key").to_pylist():
                try:
                    with opened(base, key) as source:
                        stops.append(source.size())
                except (OSError, ValueError):
                    stops.append(None)  # the scan reports it
            yield batch.append_column("stop", pa.array(stops, pa.int64()))

    return measure


def measured(locations: DataFrame, base: str = "") -> DataFrame:
    """Stored ``key, start, end, piece, stop``, in order, so that the file system is asked once.

    ``piece`` tells ranges apart that are listed several times.
    """
    spark = locations.sparkSession
    # Stored first, or lines are parsed again to draw the bounds of the parts.
    listed = scratch_path(spark, "listed")
    ranges = in_pieces(location_columns(locations), 1).drop("copies")
    ranges.write.parquet(listed)
    ranges = spark.read.schema(ranges.schema).parquet(listed)
    known = ranges.filter(F.col("end").isNotNull()).withColumn("stop", F.col("end"))
    # Few bytes a row, but a file to open, so these rows are spread on purpose.
    unknown = ranges.filter(F.col("end").isNull()).repartition(spread_tasks(spark), "key")
    asked = unknown.mapInArrow(_sizes(base.rstrip("/")), MEASURED)
    ordered = known.unionByName(asked).repartitionByRange("key", "start", "piece")
    ordered = ordered.sortWithinPartitions("key", "start", "piece")
    place = scratch_path(spark, "ranges")
    placed = ordered.withColumn("part", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id())
    placed.write.parquet(place)
    return spark.read.schema(placed.schema).parquet(place)


def running(ranges: DataFrame, again: int = SEEKING) -> DataFrame:
    """Adds ``weight`` and ``before``, the weights of all ranges before; ``ranges`` as :func:`measured`.

    Ranges are summed up within the part that wrote them, and only one sum a part meets in one task.
    The scan opens an archive once for neighbouring ranges, so these weigh ``again`` bytes more than they
    have, and in ``cost``, which tells how many tasks there should be, always ``SEEKING``.
    """
    size = F.greatest(F.coalesce(F.col("stop") - F.col("start"), F.lit(0)), F.lit(0))
    held = F.coalesce(F.lag("key").over(Window.partitionBy("part").orderBy("row")) == F.col("key"), F.lit(False))
    weighed = ranges.withColumns(
        {n: size + F.when(held, more).otherwise(OPENING) for n, more in (("weight", again), ("cost", SEEKING))}
    )
    sums = weighed.groupBy("part").agg(F.sum("weight").alias("sum"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("part", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return (
        weighed.withColumn("within", F.coalesce(F.sum("weight").over(within), F.lit(0)))
        .join(F.broadcast(base), "part")  # a row for each part
        .withColumn("before", F.col("base") + F.col("within"))
        .drop("base", "within")
    )


def share(total: int, tasks: int):
    """The task of a range: where its middle lies among all bytes."""
    middle = F.col("before") + F.floor(F.col("weight") / 2)
    return F.least(F.floor(middle / F.lit(max(total, 1)) * tasks), F.lit(tasks - 1)).cast("int")


def task_count(spark: SparkSession, total: int, task_bytes: int = TASK_BYTES) -> int:
    """As many tasks as the bytes need, and enough to occupy the cores."""
    return max(1, min(spread_tasks(spark), total // OPENING), -(-total // task_bytes))


def dealt(
    locations: DataFrame, base: str = "", tasks: int | None = None, task_bytes: int = TASK_BYTES
) -> DataFrame:
    """``key, start, end``, a partition for each task, sorted by key and start.

    A capture index of short records is not dealt to a task for every few thousand of them, but what tasks
    there are get equal bytes with every range as an archive to open, which it may be for its task.
    """
    ranges = running(measured(locations, base), OPENING)
    total, cost = (n or 0 for n in ranges.agg(F.sum("weight"), F.sum("cost")).first())
    tasks = tasks or task_count(locations.sparkSession, cost, task_bytes)
    return (
        ranges.withColumn("task", share(total, tasks))
        .repartitionById(tasks, "task")
        .sortWithinPartitions("key", "start")
        .select("key", "start", "end")
    )
