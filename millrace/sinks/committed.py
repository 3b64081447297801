"""Encoded lines that count only once they are committed, from batches and streams alike.

``df.write.format("committed-lines")`` and ``df.writeStream.format("committed-lines")`` take rows with
one text column, ``value``. A task writes its lines to a file of its own below ``data`` and
tells its name; when all tasks are done, one manifest below ``manifests`` lists the files, put in
place by a rename. Readers see the listed files and no others: not those of tasks that
failed or ran twice, nor of a write that was given up. A step of a stream has a manifest named by its number,
so a step that is repeated finds it there and adds no row. Streams that write to one place
need names of their own (option ``stream``).
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds

from ..sources.files import arrow_path

NAME = "committed-lines"
# Lines that are joined at a time.
ROWS = 256


@dataclass
class Written(ds.WriterCommitMessage):
    file: str | None
    rows: int


class _Lines:
    """What both kinds of writers share."""

    def __init__(self, options):
        self.path = options["path"].rstrip("/")
        self.stream = options.get("stream", "stream")

    def write(self, batches) -> Written:
        system, root = arrow_path(self.path)
        name, out, rows = f"data/{uuid.uuid4().hex}.txt", None, 0
        for batch in batches:
            if out is None:
                system.create_dir(f"{root}/data", recursive=True)
                out = system.open_output_stream(f"{root}/{name}", compression=None)
            for first in range(0, batch.num_rows, ROWS):
                lines = batch.column("value").slice(first, ROWS).to_pylist()
                out.write("".join(f"{line}\n" for line in lines if line is not None).encode())
            rows += batch.num_rows
        if out is not None:
            out.close()
        return Written(name if out is not None else None, rows)

    def _list(self, messages, manifest: str) -> None:
        system, root = arrow_path(self.path)
        system.create_dir(f"{root}/manifests", recursive=True)
        place = f"{root}/manifests/{manifest}"
        if system.get_file_info(place).size is not None:
            self._drop(messages)
            return
        found = [{"file": m.file, "rows": m.rows} for m in messages if m is not None and m.file]
        with system.open_output_stream(f"{root}/manifests/.{manifest}", compression=None) as out:
            out.write("".join(json.dumps(f) + "\n" for f in found).encode())
        system.move(f"{root}/manifests/.{manifest}", place)

    def _drop(self, messages) -> None:
        system, root = arrow_path(self.path)
        for m in messages:
            if m is not None and m.file:
                system.delete_file(f"{root}/{m.file}")


class BatchWriter(_Lines, ds.DataSourceArrowWriter):
    def commit(self, messages) -> None:
        self._list(messages, f"batch-{uuid.uuid4().hex}.json")

    def abort(self, messages) -> None:
        self._drop(messages)


class StreamWriter(_Lines, ds.DataSourceStreamArrowWriter):
    def commit(self, messages, batchId: int) -> None:
        self._list(messages, f"{self.stream}-{batchId:012d}.json")

    def abort(self, messages, batchId: int) -> None:
        self._drop(messages)


class CommittedLines(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "value string"

    def writer(self, schema, overwrite: bool) -> ds.DataSourceWriter:
        if overwrite:
            raise ValueError("committed lines are only appended")
        return BatchWriter(self.options)

    def streamWriter(self, schema, overwrite: bool) -> ds.DataSourceStreamWriter:
        return StreamWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(CommittedLines)


def write(rows: DataFrame, path: str) -> None:
    """Rows as encoded lines, all or none of them."""
    from . import encode_lines

    register(rows.sparkSession)
    encode_lines(rows).write.format(NAME).mode("append").save(path)


def write_stream(rows: DataFrame, path: str, checkpoint: str, stream: str = "stream"):
    """A stream's rows as encoded lines; every step counts once. Ends when all has been read."""
    from . import encode_lines

    register(rows.sparkSession)
    return (
        encode_lines(rows).writeStream.format(NAME).option("path", path).option("stream", stream)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The committed lines, as column ``value``; the files are listed as Spark lists its own."""
    path = path.rstrip("/")
    system, root = arrow_path(path)
    if system.get_file_info(f"{root}/manifests").type.name == "NotFound":
        return spark.createDataFrame([], "value string")
    listed = spark.read.schema("file string, rows bigint").json(f"{path}/manifests").select("file").distinct()
    places = [f"{path}/{r.file}" for r in listed.collect()]
    return spark.read.text(places) if places else spark.createDataFrame([], "value string")
