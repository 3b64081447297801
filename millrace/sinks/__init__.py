"""Writers: Parquet and JSON results, encoded lines, edge files, score tables, quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import codec
from ..schemas import SCORE


def _plain(rows: DataFrame) -> list[Column]:
    """The columns with times as epoch seconds."""
    return [
        F.col(name).cast("double").alias(name) if kind.startswith("timestamp") else F.col(name)
        for name, kind in rows.dtypes
    ]


def encode_lines(rows: DataFrame) -> DataFrame:
    """Each row as one base64(gzip(JSON)) line; times become epoch seconds."""
    return codec.pack(rows, F.to_json(F.struct(*_plain(rows))), "value")


def write_encoded(rows: DataFrame, path: str, mode: str = "append", compression: str | None = None) -> None:
    """Encoded lines as text; a packed file (base64 leaves a quarter to gain) is one task to its readers."""
    encode_lines(rows).write.mode(mode).text(path, compression=compression)


def write_parquet(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Typed columns that a study reads one by one."""
    rows.write.mode(mode).parquet(path)


def write_json(rows: DataFrame, path: str, mode: str = "append") -> None:
    """The native counterpart: gzipped JSON lines any tool reads, times as epoch seconds."""
    rows.select(*_plain(rows)).write.mode(mode).json(path, compression="gzip")


def write_edges(edges: DataFrame, path: str, mode: str = "append") -> None:
    """Edges as blank-separated text."""
    edges.select("block", "idx", "group_addr", "out_addr", "amount", "fee").write.mode(mode).csv(
        path, sep=" "
    )


def write_groups(groups: DataFrame, path: str, mode: str = "append") -> None:
    """The address mapping, its own dataset beside the edges."""
    groups.select("addr", "group_addr").write.mode(mode).csv(path, sep=" ")


def append_scores(scores: DataFrame, table: str) -> None:
    """Insert cleaned snapshots into a table, which is created on first use."""
    typed = scores.select(*[F.col(f.name).cast(f.dataType) for f in SCORE])
    typed.write.mode("append").format("parquet").saveAsTable(table)


def write_with_quarantine(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Good and failed rows in one pass, under ``outcome=good`` and ``outcome=quarantine``.

    One partitioned write instead of two filters, so the work before it (a scan
    of every archive, perhaps) runs once and nothing has to be cached.
    """
    outcome = F.when(F.col("error").isNull(), "good").otherwise("quarantine")
    rows.withColumn("outcome", outcome).write.mode(mode).partitionBy("outcome").parquet(path)


# --- Score table in buckets ---------------------------------------------------------


def create_score_table(spark: SparkSession, table: str, path: str, buckets: int = 200) -> None:
    """A score table below ``path``: a part for each ingest batch, dealt into buckets by name and
    sorted by name and time within, so that studies of series need no shuffle."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in SCORE)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, batch STRING) USING parquet "
        f"PARTITIONED BY (batch) CLUSTERED BY (name) SORTED BY (name, ts) INTO {buckets} BUCKETS LOCATION '{path}'"
    )


def insert_scores(scores: DataFrame, table: str, batch: str) -> None:
    """Put a batch of snapshots into a table of :func:`create_score_table`.

    The batch takes the place of what an earlier insert of the same batch left, and touches no
    other, so an insert may be repeated.
    """
    spark = scores.sparkSession
    buckets = int(_described(spark, table)["Num Buckets"])
    typed = scores.select(*[F.col(f.name).cast(f.dataType) for f in SCORE], F.lit(batch).alias("batch"))
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        # Dealt as the buckets are, so each is one file.
        typed.repartition(buckets, "name").write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(setting, before)


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    return {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}


# --- Failures counted on the way ------------------------------------------------------


class TooManyFailures(RuntimeError):
    """More rows failed than a job was told to bear."""

    def __init__(self, counts: dict[str, int]):
        super().__init__(", ".join(f"{name}: {n}" for name, n in counts.items()))
        self.counts = counts


def write_counted(
    rows: DataFrame, path: str, reasons: dict[str, Column], most: float = 1.0, mode: str = "append"
) -> dict[str, int]:
    """Good and failed rows in one pass, with counts of both that the same pass observes.

    ``reasons`` names conditions; rows that fail (``error`` is set) by none of them are ``other``. If more
    than the share ``most`` of the rows fails, :class:`TooManyFailures` is raised; the rows
    are written by then, kept apart as :func:`write_with_quarantine` does, to be looked at.
    """
    failed = F.col("error").isNotNull()
    known = F.lit(False)
    for condition in reasons.values():
        known = known | F.coalesce(condition, F.lit(False))
    told = {"rows": F.lit(True), "failed": failed, **reasons, "other": failed & ~known}
    seen = Observation()
    counted = rows.observe(seen, *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in told.items()])
    write_with_quarantine(counted, path, mode)
    counts = seen.get
    if counts["failed"] > most * counts["rows"]:
        raise TooManyFailures(counts)
    return counts
