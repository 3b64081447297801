"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # Timestamps are UTC everywhere; file names carry no zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # A batch is held by the JVM and by Python at once, for each core.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def local_session(cores: int | str = 8, app: str = "millrace", **settings: str) -> SparkSession:
    """A session on this machine, for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    chosen = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(cores if str(cores).isdigit() else 8),
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        # Call sites of every column cost more than small queries do.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **settings,
    }
    for key, value in chosen.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Fallback folders of local sessions, by application.
_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Where the setting is absent a local session gets a fresh temporary folder;
    on a cluster that would lose data, so it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return _qualified(spark, root.rstrip("/"))
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="run-")
    return _local_roots[context.applicationId]


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system named, as JVM and Python have different defaults."""
    if ":/" in path:
        return path
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    return ("file://" if default.startswith("file:") else default.rstrip("/")) + path


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the scratch folder that no earlier run has used."""
    return f"{scratch_root(spark)}/millrace/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, place: str) -> None:
    """Delete a folder of :func:`scratch_path` that no later step reads."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
