"""A streaming sink with commits: alerts as JSON lines in files that count only once their micro-batch is committed.

Tasks write files under names of their own and report them; the commit of a batch is one small file
that names them. Files of a failed or repeated task are named by no commit and are removed by the batch's
abort, or stay unseen. Committing a batch again replaces its list, so a replayed batch counts once.
The file systems are those of Arrow: local or shared folders, ``hdfs://``, ``s3://``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import DataStreamWriter

FORMAT = "committed_json"


@dataclass
class WrittenFile(WriterCommitMessage):
    name: str | None
    rows: int


def _folder(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


class CommittedWriter(DataSourceStreamArrowWriter):
    """Writes the text column ``value``, a line each."""

    def __init__(self, path: str):
        self._path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WrittenFile:
        system, root = _folder(self._path)
        name, rows, out = f"{uuid.uuid4().hex}.json", 0, None
        try:
            for batch in iterator:
                lines = [line for line in batch.column("value").to_pylist() if line is not None]
                if lines:
                    if out is None:
                        system.create_dir(f"{root}/files", recursive=True)
                        out = system.open_output_stream(f"{root}/files/{name}")
                    out.write("".join(line + "\n" for line in lines).encode())
                    rows += len(lines)
        finally:
            if out is not None:
                out.close()
        return WrittenFile(name if rows else None, rows)

    def commit(self, messages: list[WrittenFile | None], batchId: int) -> None:
        system, root = _folder(self._path)
        system.create_dir(f"{root}/commits", recursive=True)
        listed = json.dumps({"batch": batchId, "files": sorted(m.name for m in messages if m and m.name), "rows": sum(m.rows for m in messages if m)})
        draft = f"{root}/commits/.{batchId}-{uuid.uuid4().hex}"
        with system.open_output_stream(draft) as out:
            out.write(listed.encode())
        system.move(draft, f"{root}/commits/{batchId}.json")

    def abort(self, messages: list[WrittenFile | None], batchId: int) -> None:
        system, root = _folder(self._path)
        for message in messages:
            if message and message.name and system.get_file_info(f"{root}/files/{message.name}").is_file:
                system.delete_file(f"{root}/files/{message.name}")


class CommittedJson(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> CommittedWriter:
        if schema.names != ["value"]:
            raise ValueError("the sink takes one text column named value")
        return CommittedWriter(self.options["path"])


def committed_sink(alerts: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """A stream's rows as JSON lines, each batch visible at once when it is committed."""
    alerts.sparkSession.dataSource.register(CommittedJson)
    lines = alerts.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                                                    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}).alias("value"))
    return lines.writeStream.format(FORMAT).option("path", path).option("checkpointLocation", checkpoint)


def read_committed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all committed batches, with ``batch``. A commit is one short row, the files are read by tasks."""
    system, root = _folder(path)
    if not system.get_file_info(f"{root}/commits").type == fs.FileType.Directory:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("batch", T.LongType())]))
    commits = spark.read.schema("batch bigint, files array<string>, rows bigint").json(f"{path}/commits")
    named = commits.select("batch", F.explode("files").alias("_file"))
    files = spark.read.schema(schema).json(f"{path}/files") if commits.where("rows > 0").count() else spark.createDataFrame([], schema)
    return files.withColumn("_file", F.element_at(F.split(F.input_file_name(), "/"), -1)).join(named, "_file").drop("_file")
