"""A log of committed batches as a source and a sink of its own.

Layout of a log's folder::

    data/<run>-<uuid>.parquet   what one task wrote
    commits/<number>.json       the files and rows of one batch, in one put

A batch exists once its commit file does. Tasks write data files that nobody
reads until the driver commits the batch; an aborted one is taken away again, and
a batch that is committed a second time after a failure changes nothing. Readers
follow the commits: the offset of a stream is the number of commits it has read,
so a stopped stream goes on with the first batch it has not seen.

Files are read and written through Arrow's file systems (local, HDFS, S3, ...),
inside tasks, batch by batch.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

FORMAT = "commitlog"


class Folder:
    """A log's folder on whatever file system its path names."""

    def __init__(self, path: str) -> None:
        self.files, self.path = fs.FileSystem.from_uri(path.replace("file:/", "/", 1) if path.startswith("file:/") else path)

    def commits(self) -> list[int]:
        """Numbers of the commits, in order."""
        found = self.files.get_file_info(fs.FileSelector(f"{self.path}/commits", allow_not_found=True))
        return sorted(int(f.base_name.split(".")[0]) for f in found if f.base_name.endswith(".json"))

    def commit(self, number: int) -> dict:
        with self.files.open_input_stream(f"{self.path}/commits/{number:012d}.json") as f:
            return json.loads(f.read())

    def put_commit(self, number: int, content: dict) -> None:
        """In one put, under its name only when it is whole."""
        self.files.create_dir(f"{self.path}/commits", recursive=True)
        target, draft = f"{self.path}/commits/{number:012d}.json", f"{self.path}/commits/.{uuid.uuid4().hex}"
        with self.files.open_output_stream(draft) as f:
            f.write(json.dumps(content).encode())
        self.files.move(draft, target)

    def remove(self, names: Sequence[str]) -> None:
        for name in names:
            if self.files.get_file_info(f"{self.path}/{name}").type == fs.FileType.File:
                self.files.delete_file(f"{self.path}/{name}")

    def sweep(self, run: str = "") -> None:
        """Remove data files (of a run) that are in no commit. Without ``run``
        only while nobody writes: files of open batches look the same."""
        found = self.files.get_file_info(fs.FileSelector(f"{self.path}/data", allow_not_found=True))
        mine = {f"data/{f.base_name}" for f in found if f.base_name.startswith(run)}
        if mine:
            self.remove(sorted(mine.difference(*[self.commit(n)["files"] for n in self.commits()])))


@dataclass
class Written(WriterCommitMessage):
    file: str | None
    rows: int


@dataclass
class File(InputPartition):
    file: str


class _Writing:
    """What batch and stream writers share: a file for each task."""

    def __init__(self, path: str) -> None:
        self.path = path
        self.run = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        folder, name, rows, out = Folder(self.path), f"data/{self.run}-{uuid.uuid4().hex}.parquet", 0, None
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if out is None:
                    folder.files.create_dir(f"{folder.path}/data", recursive=True)
                    out = pq.ParquetWriter(f"{folder.path}/{name}", batch.schema, filesystem=folder.files)
                out.write_batch(batch)
                rows += batch.num_rows
        except BaseException:
            if out is not None:
                out.close()
                folder.remove([name])
            raise
        if out is not None:
            out.close()
        return Written(name if rows else None, rows)

    def _take(self, messages: list[Written | None], number: int) -> None:
        folder = Folder(self.path)
        files = [m.file for m in messages if m and m.file]
        if number in folder.commits():  # committed before a failure; these are the same rows again
            folder.remove(files)
        else:
            folder.put_commit(number, {"files": files, "rows": sum(m.rows for m in messages if m)})

    def _drop(self, messages: list[Written | None]) -> None:
        """Files of tasks that have reported, and what other tasks of this run left."""
        folder = Folder(self.path)
        folder.remove([m.file for m in messages if m and m.file])
        folder.sweep(self.run)


class StreamWriter(_Writing, DataSourceStreamArrowWriter):
    def commit(self, messages, batchId: int) -> None:
        self._take(messages, batchId)

    def abort(self, messages, batchId: int) -> None:
        self._drop(messages)


class BatchWriter(_Writing, DataSourceArrowWriter):
    """Each write is one commit after those that are there."""

    def commit(self, messages) -> None:
        known = Folder(self.path).commits()
        self._take(messages, known[-1] + 1 if known else 0)

    def abort(self, messages) -> None:
        self._drop(messages)


class _Reading:
    def __init__(self, path: str, schema: StructType) -> None:
        self.path, self.names = path, schema.fieldNames()

    def _files(self, numbers: Sequence[int]) -> list[InputPartition]:
        folder = Folder(self.path)
        return [File(name) for n in numbers for name in folder.commit(n)["files"]]

    def read(self, partition: File | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no files at all
            return
        folder = Folder(self.path)
        with folder.files.open_input_file(f"{folder.path}/{partition.file}") as f:
            yield from pq.ParquetFile(f).iter_batches(batch_size=8_192, columns=self.names)


class BatchReader(_Reading, DataSourceReader):
    def partitions(self) -> list[InputPartition]:
        return self._files(Folder(self.path).commits())


class StreamReader(_Reading, DataSourceStreamReader):
    """Offset: the number of the last commit read, -1 at the start."""

    def initialOffset(self) -> dict:
        return {"commit": -1}

    def latestOffset(self) -> dict:
        return {"commit": max(Folder(self.path).commits(), default=-1)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        wanted = [n for n in Folder(self.path).commits() if start["commit"] < n <= end["commit"]]
        return self._files(wanted)

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


class CommitLog(DataSource):
    """``format("commitlog")`` with the option ``path``; reading needs a schema."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    @property
    def path(self) -> str:
        return self.options["path"]

    def reader(self, schema: StructType) -> DataSourceReader:
        return BatchReader(self.path, schema)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return StreamReader(self.path, schema)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("a log is only appended to")
        return BatchWriter(self.path)

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
        return StreamWriter(self.path)


def log_stream(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The log's batches as a stream; each run takes what was committed since the last one."""
    spark.dataSource.register(CommitLog)
    return spark.readStream.format(FORMAT).schema(schema).option("path", path).load()


def log_table(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """All committed rows."""
    spark.dataSource.register(CommitLog)
    return spark.read.format(FORMAT).schema(schema).option("path", path).load()


def append_to_log(df: DataFrame, path: str) -> None:
    """Rows of a batch frame as one commit."""
    df.sparkSession.dataSource.register(CommitLog)
    df.write.format(FORMAT).option("path", path).mode("append").save()


def stream_to_log(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Run a stream over all available input into the log, a commit a batch.

    With the same checkpoint and path a later run continues; a batch that was
    committed before a failure is not there twice.
    """
    stream.sparkSession.dataSource.register(CommitLog)
    run = (
        stream.writeStream.format(FORMAT)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
