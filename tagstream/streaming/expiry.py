"""The cache in Spark's own state store: the last reading per key, with a time to live.

Each key has one value state with a time to live. A write of a higher version replaces it and
arms it anew; when the time is over the state store drops the key by itself. What lives is read
through the state data source from the query's checkpoint, without the query and without any
files of ours.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tagstream.constants import BATCH_SECONDS, CACHE_TTL_SECONDS
from tagstream.operators.keyed import unexpired
from tagstream.operators.messages import message_entries, parse_readings, usable
from tagstream.session import ship_package

STATE = "entry"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"

# Versions as plain numbers: the message's time in microseconds, its partition and offset.
_ENTRY = "value string, at bigint, partition int, offset bigint"
_WRITTEN = "db int, key string, at bigint"


class LatestEntry(StatefulProcessor):
    """Keeps the entry of the highest version per key for ``ttl_seconds`` after it was written."""

    def __init__(self, ttl_seconds: int | None):
        self.ttl_seconds = ttl_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        millis = None if self.ttl_seconds is None else self.ttl_seconds * 1000
        self.entry = handle.getValueState(STATE, _ENTRY, millis)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        stored = self.entry.get() if self.entry.exists() else None
        best, kept = (tuple(stored[1:]), None) if stored else (None, None)
        for row in rows:
            version = (row.at, row.partition, row.offset)
            if best is None or version > best:
                best, kept = version, row.value
        if kept is not None:
            self.entry.update((kept, *best))
            yield Row(db=key[0], key=key[1], at=best[0])

    def close(self) -> None:
        pass


def start_state_cache(
    messages: DataFrame,
    checkpoint: str,
    ttl_seconds: int | None = CACHE_TTL_SECONDS,
    zone: str = "UTC",
    lenient: bool = False,
    batch_seconds: float = BATCH_SECONDS,
    available_now: bool = False,
    partitions: int | None = None,
) -> StreamingQuery:
    """Keep the last reading per key in the query's state; the query itself writes nothing else.

    The session needs a state store that can forget by time (``use_state_on_disk``). The state has as many
    ``partitions`` as the query's first start says, else as the session's shuffles have.
    """
    if ttl_seconds is not None and ttl_seconds <= 0:
        raise ValueError("ttl_seconds must be positive, or None to keep entries")
    ship_package(messages.sparkSession)
    entries = message_entries(usable(parse_readings(messages, zone, lenient))).select(
        "db", "key", "value", F.unix_micros("ver.timestamp").alias("at"), "ver.partition", "ver.offset"
    )
    kept = entries.groupBy("db", "key").transformWithState(
        statefulProcessor=LatestEntry(ttl_seconds),
        outputStructType=_WRITTEN,
        outputMode="Update",
        timeMode="ProcessingTime",
    )
    writer = kept.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint)
    own = {} if partitions is None else {SHUFFLE_PARTITIONS: str(partitions)}
    if available_now:
        # Time alone would bring batch after batch, and the query would never be done with what there is.
        own[EMPTY_BATCHES] = "false"
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{batch_seconds} seconds"}
    # A query keeps the settings of its start.
    conf = messages.sparkSession.conf
    before = {name: conf.get(name) for name in own}
    for name, value in own.items():
        conf.set(name, value)
    try:
        return writer.trigger(**trigger).start()
    finally:
        for name, value in before.items():
            conf.set(name, value)


def use_state_on_disk(spark: SparkSession) -> None:
    """State in RocksDB: larger than memory, and with a time to live."""
    spark.conf.set(PROVIDER, ROCKSDB)


def live_entries(spark: SparkSession, checkpoint: str, as_of: datetime | Column | None = None) -> DataFrame:
    """``db, key, value, ver, expires_at`` of what the state of the last batch holds and has not expired.

    ``as_of`` is now if not given; what had expired when the last batch ran is gone already.
    """
    state = spark.read.format("statestore").option("stateVarName", STATE).load(checkpoint)
    expires, entry = F.lit(None).cast("timestamp"), "value"
    if "ttlExpirationMs" in state.schema["value"].dataType.names:
        expires, entry = F.timestamp_millis("value.ttlExpirationMs"), "value.value"
    ver = F.struct(
        F.timestamp_micros(f"{entry}.at").alias("timestamp"), F.col(f"{entry}.partition"), F.col(f"{entry}.offset")
    )
    rows = state.select(
        "key.db", "key.key", F.col(f"{entry}.value").alias("value"), ver.alias("ver"), expires.alias("expires_at")
    )
    return unexpired(rows, as_of)
