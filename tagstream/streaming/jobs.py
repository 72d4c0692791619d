"""The two jobs. Sinks are replay-safe and a batch keeps its time, so a repeated batch changes nothing."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from enum import Enum
from typing import Protocol

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tagstream.constants import BATCH_SECONDS, CACHE_DB, CACHE_PREFIX, CACHE_TTL_SECONDS, TIME_FIELD
from tagstream.functions.time import check_zone, instant
from tagstream.operators.keyed import first_write_wins
from tagstream.operators.messages import (
    MODES,
    latest_entries,
    parse_readings,
    quarantined,
    usable,
)
from tagstream.operators.offsets import offset_ranges
from tagstream.operators.report import reading_counts
from tagstream.operators.tableschema import (
    conform,
    infer_table_columns,
    rejected_tags,
    table_schema,
)
from tagstream.session import configure
from tagstream.sinks.batch_store import BatchStore
from tagstream.sinks.offset_log import OffsetLog
from tagstream.sinks.table import JdbcTable, ParquetTable, day_of, tags_of
from tagstream.streaming.report import BatchReport, OnReport, log_report

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
# Days whose stored rows are looked up by name.
MOST_DAYS = 10_000
# Column with the time of the batch.
STAMP = "batch_time"

QUARANTINE_SCHEMA = "value STRING, topic STRING, partition INT, offset BIGINT, reason STRING"
REJECT_SCHEMA = (
    "topic STRING, partition INT, offset BIGINT, time BIGINT, tag STRING, value STRING, reason STRING"
)


def quarantine_store(spark: SparkSession, root: str) -> BatchStore:
    return BatchStore(spark, root, QUARANTINE_SCHEMA)


def reject_store(spark: SparkSession, root: str) -> BatchStore:
    return BatchStore(spark, root, REJECT_SCHEMA)


class Discard(Enum):
    """Says in so many words that what cannot be used may vanish (it is still counted)."""

    DISCARD = "discard"


DISCARD = Discard.DISCARD


class CacheTarget(Protocol):
    def write(self, entries: DataFrame, batch_id: int) -> None: ...


@dataclass(kw_only=True)
class _Job:
    """``quarantine`` takes the messages that cannot be used: a store, or DISCARD, or nothing in FAILFAST mode.

    A batch is stamped with the time the stream recorded for it, which a replay repeats;
    ``clock`` replaces that time.
    """

    spark: SparkSession
    checkpoint: str
    zone: str = "UTC"
    lenient: bool = False
    mode: str = "PERMISSIVE"
    quarantine: BatchStore | Discard | None = None
    offsets: OffsetLog | None = None
    clock: Callable[[], datetime] | None = None
    on_report: OnReport = log_report
    name: str | None = None
    key_columns: dict[str, Column] = field(default_factory=dict)

    def __post_init__(self):
        check_zone(self.zone)
        if self.mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")
        self._must_have("quarantine", self.quarantine)

    def _must_have(self, what: str, store: BatchStore | Discard | None) -> None:
        if store is None and self.mode != "FAILFAST":
            raise ValueError(f"{what} needs a store, or DISCARD to lose what goes there")

    def start(
        self,
        messages: DataFrame,
        batch_seconds: float = BATCH_SECONDS,
        available_now: bool = False,
    ) -> StreamingQuery:
        """Start the stream: a batch every few seconds, or all that is there and stop."""
        if batch_seconds <= 0:
            raise ValueError("batch_seconds must be positive")
        configure(self.spark)
        stamped = messages.withColumn(STAMP, F.current_timestamp())
        writer = stamped.writeStream.foreachBatch(self.write_batch)
        writer = writer.option("checkpointLocation", self.checkpoint)
        if self.name:
            writer = writer.queryName(self.name)
        if available_now:
            return writer.trigger(availableNow=True).start()
        return writer.trigger(processingTime=f"{batch_seconds} seconds").start()

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        if self.clock:
            batch = batch.withColumn(STAMP, instant(self.clock()))
        readings = parse_readings(batch, self.zone, self.lenient, self.mode, lambda _: [F.col(STAMP)])
        for name, value in self.key_columns.items():
            readings = readings.withColumn(name, value)
        # The source is read once; whatever else looks at the batch finds it here.
        again = self._looks_again()
        readings = readings.persist() if again else readings
        try:
            written_at, counts = self._write(readings, batch_id)
            if isinstance(self.quarantine, BatchStore) and counts["n_bad"]:
                self.quarantine.write(quarantined(readings), batch_id)
            if self.offsets and counts["n_in"]:
                self.offsets.append(offset_ranges(readings), batch_id)
        finally:
            if again:
                readings.unpersist()
        if not counts["n_in"]:
            return
        self.on_report(BatchReport(batch_id=batch_id, written_at=written_at, **counts))

    def _looks_again(self) -> bool:
        return bool(self.offsets) or isinstance(self.quarantine, BatchStore)

    def _write(self, readings: DataFrame, batch_id: int) -> tuple[datetime | None, dict[str, int]]:
        raise NotImplementedError


def _observe(df: DataFrame, **metrics) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, *[c.alias(n) for n, c in metrics.items()]), seen


def _observe_readings(readings: DataFrame) -> tuple[DataFrame, Observation]:
    micros = F.max(F.unix_micros(STAMP))
    return _observe(readings, **reading_counts(), stamp=micros)


def _count(seen: Observation) -> dict[str, int]:
    return {n: int(v or 0) for n, v in seen.get.items() if n.startswith("n_")}


def _stamp(seen: Observation) -> datetime | None:
    micros = seen.get["stamp"]
    return None if micros is None else EPOCH + timedelta(microseconds=micros)


@dataclass(kw_only=True)
class CacheJob(_Job):
    """Messages to cache entries: the last reading per key wins and expires after the TTL."""

    target: CacheTarget
    prefix: str = CACHE_PREFIX
    db: int | str = CACHE_DB
    ttl_seconds: int | None = CACHE_TTL_SECONDS

    def __post_init__(self):
        super().__post_init__()
        if self.ttl_seconds is not None and self.ttl_seconds <= 0:
            raise ValueError("ttl_seconds must be positive, or None to keep entries")

    def _write(self, readings: DataFrame, batch_id: int) -> tuple[datetime | None, dict[str, int]]:
        readings, seen = _observe_readings(readings)
        entries = latest_entries(
            usable(readings), F.col(STAMP), self.ttl_seconds, self.prefix, self.db, tuple(self.key_columns), STAMP
        )
        entries, kept = _observe(entries, n_keys=F.count(F.lit(1)))
        self.target.write(entries, batch_id)
        return _stamp(seen), _count(seen) | _count(kept)


@dataclass(kw_only=True)
class TableJob(_Job):
    """Messages to table rows: the first reading per key wins.

    The first batch with a usable reading decides the columns, from its first
    reading or (``columns="union"``) from all of its readings. ``rejects`` takes the tags that
    have no column or no number: a store, or DISCARD, or nothing in FAILFAST mode.
    """

    target: ParquetTable | JdbcTable
    columns: str = "first"
    rejects: BatchStore | Discard | None = None

    def __post_init__(self):
        super().__post_init__()
        if self.columns not in ("first", "union"):
            raise ValueError("columns must be 'first' or 'union'")
        self._must_have("rejects", self.rejects)
        if self.target is not None and list(self.key_columns) != list(self.target.key_columns):
            raise ValueError("the job and its table must have the same key columns")

    def _looks_again(self) -> bool:
        return super()._looks_again() or isinstance(self.rejects, BatchStore) or self.target.schema() is None

    def _table_schema(self, readings: DataFrame) -> T.StructType | None:
        schema = self.target.schema()
        if schema is None:
            learned = table_schema(infer_table_columns(usable(readings), self.columns))
            if learned is not None:
                keys = [T.StructField(n, _type_of(t), False) for n, t in self.target.key_columns.items()]
                tags = [f for f in learned.fields[1:] if f.name not in self.target.key_columns]
                self.target.create(T.StructType([learned.fields[0], *keys, *tags]))
                schema = self.target.schema() or learned
        return schema

    def _write(self, readings: DataFrame, batch_id: int) -> tuple[datetime | None, dict[str, int]]:
        schema = self._table_schema(readings)
        tags = tags_of(schema, tuple(self.key_columns)) if schema else []
        observed, seen = _observe_readings(readings)
        rows = conform(usable(observed), tags, self.mode, tuple(self.key_columns))
        rows, refused = _observe(rows, n_rejected=F.sum("n_rejected"))
        keys = [TIME_FIELD, *self.key_columns]
        firsts, kept = _observe(
            first_write_wins(rows.drop("n_rejected"), keys, F.col("ver")),
            n_keys=F.count(F.lit(1)),
        )
        if schema is None:
            firsts.write.format("noop").mode("overwrite").save()
        elif not self.target.looks_up:
            self.target.insert_new(firsts, batch_id)
        else:
            # Held while the table's rows of its days are looked up; one row per key.
            firsts = firsts.persist()
            try:
                firsts.write.format("noop").mode("overwrite").save()
                self.target.insert_new(firsts, batch_id, _days(firsts))
            finally:
                firsts.unpersist()
        counts = _count(seen) | _count(refused) | _count(kept)
        if isinstance(self.rejects, BatchStore) and counts["n_rejected"]:
            self.rejects.write(rejected_tags(usable(readings), tags), batch_id)
        return _stamp(seen), counts


def _days(rows: DataFrame) -> list[int] | None:
    """The days that the rows cover; None if they are so many that naming them would not help."""
    days = rows.select(day_of(F.col(TIME_FIELD)).alias("day")).distinct().limit(MOST_DAYS + 1).collect()
    return None if len(days) > MOST_DAYS else sorted(r["day"] for r in days)


def _type_of(name: str) -> T.DataType:
    return T.StructType.fromDDL(f"x {name}").fields[0].dataType
