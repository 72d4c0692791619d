"""The cache as a Parquet store: namespaces, last write wins, time to live."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession

from tagstream.operators.keyed import current, superseded_dropped
from tagstream.sinks.batch_store import BATCH, BatchStore

ENTRY_SCHEMA = (
    "key STRING, value STRING, "
    "ver STRUCT<timestamp: TIMESTAMP, partition: INT, offset: BIGINT>, "
    "written_at TIMESTAMP, expires_at TIMESTAMP"
)
KEY = ["key", "db"]


class CacheStore:
    def __init__(self, spark: SparkSession, root: str):
        self.batches = BatchStore(spark, root, ENTRY_SCHEMA, {"db": "INT"})

    def write(self, entries: DataFrame, batch_id: int) -> None:
        """Store a batch of entries that is already reduced to one row per key."""
        self.batches.write(entries, batch_id)

    def view(self, as_of: datetime | Column | None = None, db: int | None = None) -> DataFrame:
        """The live entries: the latest write per key with its own expiry."""
        rows = self.batches.read(None if db is None else [db]).drop(BATCH)
        return current(rows, KEY, as_of).select("db", "key", "value", "written_at", "expires_at", "ver")

    def copied(self, root: str, as_of: datetime | Column | None = None) -> "CacheStore":
        """A store at ``root`` with what views at or after ``as_of`` need, in one batch.

        Of the writes made by then that is the highest version per key, unless it has expired and
        nothing of its key lives; and the writes of a clock ahead. A view as of a time before is not
        exact there.
        """
        self.batches.copied(root, lambda rows: superseded_dropped(rows, KEY, as_of))
        return CacheStore(self.batches.spark, root)
