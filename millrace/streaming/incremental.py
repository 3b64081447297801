"""Incremental runs: the batch transformations behind a file stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import formats as fmt
from ..sources import archives, cuts, dealing

# Bytes of a step; cut sizes and task shares are those of the batch scan.
STEP_BYTES = 64 << 30
_PLANNED = "key string, start bigint, end bigint, task int"


def stream_table(
    spark: SparkSession, path: str, schema, files_per_step: int = fmt.LOOK_AHEAD
) -> DataFrame:
    """Parquet files as they arrive, a bounded number per step."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_step)
        .parquet(path)
    )


def stream_archives(
    spark: SparkSession, path: str, files_per_step: int = fmt.LOOK_AHEAD, **options
) -> DataFrame:
    """Records of archives as they land. The stream only lists the files; the
    tasks stream their bytes."""
    landed = archives.archive_listing(spark, path, stream=True, files_per_step=files_per_step)
    where = landed.select(
        F.col("path").alias("key"),
        F.lit(0).cast("bigint").alias("start"),
        F.lit(None).cast("bigint").alias("end"),
    )
    return archives.scan_locations(where, **options).select("uri", "ts", "content", "error")


def plan_landed(
    spark: SparkSession,
    landing: str,
    plan: str,
    checkpoint: str,
    size: int = cuts.SIZE,
    step_bytes: int = STEP_BYTES,
    task_bytes: int = dealing.TASK_BYTES,
) -> StreamingQuery:
    """Plan the reading of archives that have landed since the last call: steps by bytes.

    Long archives are cut at proven records, and the ranges are dealt by running bytes to
    steps of about ``step_bytes`` and to tasks within a step. Every step is one file
    of ``key, start, end, task`` below ``plan``, so an archive longer than a step goes on in the
    next ones. A folder that has been written whole is not written again, so the
    steps of a planning that is repeated stay the ones that may have been read.
    """

    def write(landed: DataFrame, batch: int) -> None:
        place = f"{plan}/batch={batch:010d}"
        if _is_whole(spark, place):
            return
        locations = landed.select(
            F.col("path").alias("key"), F.lit(0).cast("bigint").alias("start"),
            F.lit(None).cast("bigint").alias("end"),
        )
        ranges = dealing.running(dealing.measured(cuts.cut_long_ranges(locations, size=size)))
        total = ranges.agg(F.sum("weight")).first()[0] or 0
        steps = max(1, -(-total // step_bytes))
        tasks = max(1, -(-total // (steps * task_bytes)), min(spark.sparkContext.defaultParallelism, total // steps // dealing.OPENING))
        rows = ranges.withColumn("step", dealing.share(total, steps)).withColumn(
            "task", F.pmod(dealing.share(total, steps * tasks), F.lit(tasks))
        )
        rows.repartitionById(steps, "step").select("key", "start", "end", "task").write.mode(
            "overwrite"
        ).parquet(place)

    landed = archives.archive_listing(spark, landing, stream=True, files_per_step=1_000_000)
    return (
        landed.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _is_whole(spark: SparkSession, place: str) -> bool:
    """Whether a job has committed a folder."""
    from ..sources.files import arrow_path

    system, root = arrow_path(place)
    return system.get_file_info(f"{root}/_SUCCESS").size is not None


def stream_planned(spark: SparkSession, plan: str, tasks: int | None = None, **options) -> DataFrame:
    """Records of planned steps, one a micro-batch.

    What has been read is the list of steps in the checkpoint of Spark's own file stream: it is a
    list of archives and of the record in each at which the next step goes on, so a run
    that was stopped goes on there.
    """
    steps = (
        spark.readStream.schema(_PLANNED)
        .option("maxFilesPerTrigger", 1)
        .parquet(f"{plan}/batch=*")
    )
    tasks = tasks or dealing.spread_tasks(spark)
    dealt = steps.repartitionById(tasks, "task").select("key", "start", "end")
    return archives.scan_locations(dealt, **options).select("uri", "ts", "content", "error")


def run_incrementally(
    records: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    output: str,
    checkpoint: str,
) -> StreamingQuery:
    """Process everything that has arrived since the last run, then stop.

    Append-only Parquet files with a commit log: a step that is repeated after a
    failure adds no row twice.
    """
    return (
        records.transform(transform)
        .writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
