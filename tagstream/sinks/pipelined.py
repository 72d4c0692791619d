"""A stream's entries written by its tasks, in chunks, through a writer each.

This is a sink of Spark's Python data source API: a task opens its writer on its first row, sends
chunk after chunk and tells the driver what it wrote; when all tasks of a batch are done the
target commits it, else it takes back what there is. ``EntryFiles`` is a target of files
that only a commit makes visible; ``ServerTarget`` sends to a key-value server, whose writes
are visible at once and may be repeated.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

from tagstream.constants import BATCH_SECONDS
from tagstream.session import ship_package
from tagstream.sinks.cache_store import ENTRY_SCHEMA
from tagstream.sinks.key_value import CHUNK_ROWS, KeyValueWriter
from tagstream.sources.files import listed, shared_folder

FORMAT = "tagstream_entries"
ENTRIES = f"db INT, {ENTRY_SCHEMA}"


class TaskWriter(Protocol):
    """One per task and batch."""

    def put(self, chunk: pa.RecordBatch) -> None: ...

    def finish(self) -> str | None:
        """Close; what a commit needs to know of this task."""

    def cancel(self) -> None:
        """Close after a failure, and take back what is not visible yet."""


class PipelinedTarget(Protocol):
    def open(self) -> TaskWriter: ...

    def commit(self, written: list[str], batch_id: int) -> None: ...

    def abort(self, written: list[str], batch_id: int) -> None: ...


@dataclass
class Written(WriterCommitMessage):
    rows: int
    what: str | None


class PipelinedWriter(DataSourceStreamArrowWriter):
    def __init__(self, target: PipelinedTarget, chunk_rows: int = CHUNK_ROWS):
        self.target, self.chunk_rows = target, chunk_rows

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        writer, rows = None, 0
        try:
            for batch in iterator:
                for start in range(0, batch.num_rows, self.chunk_rows):
                    writer = writer or self.target.open()
                    chunk = batch.slice(start, self.chunk_rows)
                    writer.put(chunk)
                    rows += chunk.num_rows
            return Written(rows, writer.finish() if writer else None)
        except BaseException:
            if writer:
                writer.cancel()
            raise

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        self.target.commit(_told(messages), batchId)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        self.target.abort(_told(messages), batchId)


def _told(messages: list[Written | None]) -> list[str]:
    return sorted(m.what for m in messages if m is not None and m.what is not None)


@dataclass(frozen=True)
class EntryFiles:
    """Cache entries in a file per task, which a file per batch makes visible.

    The first commit of a batch counts: one that is repeated after a crash removes its own files
    and changes nothing. Files of tasks that were lost are never named by a commit.
    """

    root: str

    def open(self) -> "EntryFile":
        return EntryFile(self.root)

    def commit(self, written: list[str], batch_id: int) -> None:
        system, root = shared_folder(self.root)
        system.create_dir(f"{root}/commits", recursive=True)
        name = f"{root}/commits/{batch_id}.json"
        if system.get_file_info(name).is_file:
            return self.abort(written, batch_id)
        hidden = f"{root}/commits/_{uuid.uuid4().hex}"
        with system.open_output_stream(hidden) as out:
            out.write(json.dumps(written).encode())
        system.move(hidden, name)

    def abort(self, written: list[str], batch_id: int) -> None:
        system, root = shared_folder(self.root)
        for name in written:
            if system.get_file_info(f"{root}/files/{name}").is_file:
                system.delete_file(f"{root}/files/{name}")

    def read(self, spark: SparkSession) -> DataFrame:
        """All committed entries."""
        system, root = shared_folder(self.root)
        names = []
        for commit in listed(system, f"{root}/commits"):
            with system.open_input_stream(commit.path) as lines:
                names += json.loads(lines.read())
        if not names:
            return spark.createDataFrame([], ENTRIES)
        return spark.read.schema(ENTRIES).parquet(*[f"{self.root}/files/{n}" for n in names])


class EntryFile:
    def __init__(self, root: str):
        self.system, root = shared_folder(root)
        self.name = f"{uuid.uuid4().hex}.parquet"
        self.system.create_dir(f"{root}/files", recursive=True)
        self.path = f"{root}/files/{self.name}"
        self.out: pq.ParquetWriter | None = None

    def put(self, chunk: pa.RecordBatch) -> None:
        if self.out is None:
            self.out = pq.ParquetWriter(self.path, chunk.schema, filesystem=self.system)
        self.out.write_batch(chunk)

    def finish(self) -> str:
        self.out.close()
        return self.name

    def cancel(self) -> None:
        if self.out is not None:
            self.out.close()
            self.system.delete_file(self.path)


@dataclass(frozen=True)
class ServerTarget:
    """A key-value server; ``open_writer`` opens a connection to one of its namespaces."""

    open_writer: Callable[[int], KeyValueWriter]

    def open(self) -> "_ServerTask":
        return _ServerTask(self.open_writer)

    def commit(self, written: list[str], batch_id: int) -> None:
        pass

    def abort(self, written: list[str], batch_id: int) -> None:
        pass


class _ServerTask:
    def __init__(self, open_writer: Callable[[int], KeyValueWriter]):
        self.open_writer = open_writer
        self.writers: dict[int, KeyValueWriter] = {}

    def put(self, chunk: pa.RecordBatch) -> None:
        per_db: dict[int, list] = {}
        for row in chunk.select(["db", "key", "value", "written_at", "expires_at"]).to_pylist():
            expires = row["expires_at"]
            ttl = None if expires is None else int((expires - row["written_at"]).total_seconds())
            per_db.setdefault(row["db"], []).append((row["key"], row["value"], ttl))
        for db, rows in per_db.items():
            if db not in self.writers:
                self.writers[db] = self.open_writer(db)
            self.writers[db].put(rows)

    def finish(self) -> None:
        for writer in self.writers.values():
            writer.close()

    cancel = finish


def pipelined_format(target: PipelinedTarget, chunk_rows: int = CHUNK_ROWS, name: str = FORMAT) -> type[DataSource]:
    """A data source that writes a stream of entries to the target."""

    class Pipelined(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def streamWriter(self, schema, overwrite: bool) -> PipelinedWriter:
            return PipelinedWriter(target, chunk_rows)

    return Pipelined


def start_pipelined(
    entries: DataFrame,
    target: PipelinedTarget,
    checkpoint: str,
    batch_seconds: float = BATCH_SECONDS,
    available_now: bool = False,
    chunk_rows: int = CHUNK_ROWS,
) -> StreamingQuery:
    """Start writing a stream of entries (``ENTRIES``), each as it comes; readers reduce them by version."""
    spark = entries.sparkSession
    ship_package(spark)
    name = f"{FORMAT}_{uuid.uuid4().hex}"
    spark.dataSource.register(pipelined_format(target, chunk_rows, name))
    writer = entries.writeStream.format(name).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{batch_seconds} seconds"}
    return writer.trigger(**trigger).start()

