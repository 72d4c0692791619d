"""A stored message log as a stream, read by offsets of its topic partitions.

The stream's own offset is the next offset of every partition, as a Kafka source's. It starts at
the newest offsets, at the beginning, or at given positions; after that its checkpoint decides.
A partition that is added later is read from its beginning.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tagstream.operators.offsets import group_positions
from tagstream.session import ship_package
from tagstream.sources.files import listed, shared_folder
from tagstream.sources.message_log import MESSAGE_SCHEMA

FORMAT = "tagstream_log"
LATEST, EARLIEST = "latest", "earliest"

Positions = Mapping[str, Mapping[str, int]]

_ARROW = pa.schema(
    [
        ("key", pa.binary()), ("value", pa.binary()), ("topic", pa.string()), ("partition", pa.int32()),
        ("offset", pa.int64()), ("timestamp", pa.timestamp("us", "UTC")), ("timestampType", pa.int32()),
    ]
)


@dataclass
class LogRange(InputPartition):
    """Messages of one file with offsets from ``start`` on and below ``end``."""

    file: str
    topic: str
    partition: int
    start: int
    end: int


@dataclass(frozen=True)
class _File:
    path: str
    first: int
    last: int


class LogStreamReader(DataSourceStreamReader):
    """``options``: ``path``, ``startingOffsets`` (``latest``, ``earliest`` or positions as JSON), ``strict``.

    Strict reads only the partitions that the positions name. Of every file only the footer is
    looked at on the driver, once.
    """

    def __init__(self, options: Mapping[str, str]):
        self.path = options["path"]
        self.starting = options.get("startingOffsets", LATEST)
        self.only = None
        if self.starting not in (LATEST, EARLIEST):
            positions = json.loads(self.starting)
            if options.get("strict", "false").lower() == "true":
                self.only = {(t, int(p)) for t, of_topic in positions.items() for p in of_topic}
        self._files: dict[str, _File | None] = {}

    def initialOffset(self) -> dict:
        if self.starting == LATEST:
            return self.latestOffset()
        return {} if self.starting == EARLIEST else json.loads(self.starting)

    def latestOffset(self) -> dict:
        ends: dict[str, dict[str, int]] = {}
        for (topic, partition), files in self._log().items():
            if files:
                ends.setdefault(topic, {})[str(partition)] = max(f.last for f in files) + 1
        return ends

    def partitions(self, start: dict, end: dict) -> list[LogRange]:
        found = []
        for (topic, partition), files in self._log().items():
            a = start.get(topic, {}).get(str(partition), 0)
            b = end.get(topic, {}).get(str(partition), 0)
            found += [
                LogRange(f.path, topic, partition, a, b) for f in files if f.last >= a and f.first < b
            ]
        return found

    def read(self, partition: LogRange) -> Iterator[pa.RecordBatch]:
        return read_range(self.path, partition)

    def commit(self, end: dict) -> None:
        pass

    def _log(self) -> dict[tuple[str, int], list[_File]]:
        """The files of every topic partition."""
        system, root = shared_folder(self.path)
        log: dict[tuple[str, int], list[_File]] = {}
        for of_topic in listed(system, root):
            for folder in listed(system, of_topic.path):
                topic, partition = (unquote(f.base_name.split("=", 1)[1]) for f in (of_topic, folder))
                if self.only is not None and (topic, int(partition)) not in self.only:
                    continue
                files = [self._file(system, f.path) for f in listed(system, folder.path)]
                log[topic, int(partition)] = [f for f in files if f is not None]
        return log

    def _file(self, system, path: str) -> _File | None:
        if path not in self._files:
            with system.open_input_file(path) as stream:
                footer = pq.ParquetFile(stream).metadata
            place = footer.schema.names.index("offset")
            groups = [footer.row_group(i).column(place).statistics for i in range(footer.num_row_groups)]
            bounds = [(g.min, g.max) for g in groups if g is not None and g.has_min_max]
            self._files[path] = _File(path, min(a for a, _ in bounds), max(b for _, b in bounds)) if bounds else None
        return self._files[path]


def read_range(path: str, part: LogRange) -> Iterator[pa.RecordBatch]:
    """The messages of a range, row group by row group; groups outside it are not read."""
    system, _ = shared_folder(path)
    with system.open_input_file(part.file) as stream:
        file = pq.ParquetFile(stream)
        place = file.metadata.schema.names.index("offset")
        bounds = [file.metadata.row_group(i).column(place).statistics for i in range(file.num_row_groups)]
        wanted = [i for i, s in enumerate(bounds) if s.max >= part.start and s.min < part.end]
        for batch in file.iter_batches(row_groups=wanted, use_threads=False):
            offset = batch.column("offset")
            batch = batch.filter(pc.and_(pc.greater_equal(offset, part.start), pc.less(offset, part.end)))
            own = {"topic": pa.array([part.topic] * len(batch)), "partition": pa.array([part.partition] * len(batch))}
            columns = [own[f.name] if f.name in own else batch.column(f.name) for f in _ARROW]
            yield pa.RecordBatch.from_arrays([_cast(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def _cast(column: pa.Array, type_: pa.DataType) -> pa.Array:
    if pa.types.is_timestamp(type_) and column.type.tz is None:
        # Parquet's older timestamps carry no zone, and are instants all the same.
        column = column.cast(pa.timestamp("us"))
    return column.cast(type_)


class StoredLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return MESSAGE_SCHEMA

    def streamReader(self, schema) -> LogStreamReader:
        return LogStreamReader(self.options)


def stream_stored_log(
    spark: SparkSession, path: str, positions: Positions | None = None, start: str = LATEST, strict: bool = False
) -> DataFrame:
    """The stream of a stored log, from the positions, or from ``start`` (``latest`` or ``earliest``)."""
    if start not in (LATEST, EARLIEST):
        raise ValueError(f"start must be {LATEST} or {EARLIEST}")
    ship_package(spark)
    spark.dataSource.register(StoredLog)
    starting = start if positions is None else json.dumps(positions, sort_keys=True)
    reader = spark.readStream.format(FORMAT).option("path", path).option("startingOffsets", starting)
    return reader.option("strict", str(strict).lower()).load()


def resume_stored_stream(
    spark: SparkSession, path: str, stored: DataFrame, group: str, strict: bool = False
) -> DataFrame:
    """The stream from the group's stored positions; without any, from the newest offsets.

    A partition without a position is read from its beginning, or left out if ``strict``. One row
    per partition comes to the driver.
    """
    positions: dict[str, dict[str, int]] = {}
    for r in group_positions(stored, group).orderBy("topic", "partition").collect():
        positions.setdefault(r["topic"], {})[str(r["partition"])] = r["next_offset"]
    return stream_stored_log(spark, path, positions or None, strict=strict)

