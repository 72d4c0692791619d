"""Writing cache entries to a key-value server, pipelined per partition."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagstream.constants import CACHE_DB

CHUNK_ROWS = 1000


class KeyValueWriter(Protocol):
    """One per task. ``put`` must set value and expiry together and be repeatable."""

    def put(self, entries: list[tuple[str, str, int | None]]) -> None: ...

    def close(self) -> None: ...


def write_pipelined(
    entries: DataFrame,
    open_writer: Callable[[int], KeyValueWriter],
    chunk_rows: int = CHUNK_ROWS,
) -> int:
    """Send cache entries in chunks; returns the number sent.

    A task opens a writer per namespace on its first row only, and holds one chunk.
    """

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writers: dict[int, KeyValueWriter] = {}
        sent = 0
        try:
            for batch in batches:
                for start in range(0, batch.num_rows, chunk_rows):
                    chunk = batch.slice(start, chunk_rows).to_pydict()
                    per_db: dict[int, list] = {}
                    for db, *entry in zip(*(chunk[c] for c in ("db", "key", "value", "ttl"))):
                        per_db.setdefault(db, []).append(tuple(entry))
                    for db, rows in per_db.items():
                        if db not in writers:
                            writers[db] = open_writer(db)
                        writers[db].put(rows)
                        sent += len(rows)
        finally:
            for writer in writers.values():
                writer.close()
        yield pa.RecordBatch.from_pydict({"n": [sent]})

    ttl = F.unix_seconds("expires_at") - F.unix_seconds("written_at")
    counts = entries.select("db", "key", "value", ttl.alias("ttl")).mapInArrow(send, "n bigint")
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


@dataclass(frozen=True)
class KeyValueTarget:
    """A key-value server as the target of a cache job."""

    open_writer: Callable[[int], KeyValueWriter]
    chunk_rows: int = CHUNK_ROWS

    def write(self, entries: DataFrame, batch_id: int) -> None:
        write_pipelined(entries, self.open_writer, self.chunk_rows)


@dataclass(frozen=True)
class RedisWriterFactory:
    """Opens writers on a Redis server; needs the public ``redis`` package on the workers.

    The connection pool lives as long as the Python worker and is shared by its tasks.
    """

    host: str = "localhost"
    port: int = 6379
    timeout_ms: int = 2000
    max_connections: int = 2

    def __call__(self, db: int = CACHE_DB) -> "RedisWriter":
        return RedisWriter(_pool(self, db))


class RedisWriter:
    def __init__(self, pool):
        import redis

        self.client = redis.Redis(connection_pool=pool)

    def put(self, entries: list[tuple[str, str, int | None]]) -> None:
        pipeline = self.client.pipeline(transaction=False)
        for key, value, ttl_seconds in entries:
            pipeline.set(key, value, ex=ttl_seconds)
        pipeline.execute()

    def close(self) -> None:
        self.client.close()


_pools: dict = {}


def _pool(factory: RedisWriterFactory, db: int):
    import redis

    if (factory, db) not in _pools:
        _pools[factory, db] = redis.ConnectionPool(
            host=factory.host,
            port=factory.port,
            db=db,
            socket_timeout=factory.timeout_ms / 1000,
            socket_connect_timeout=factory.timeout_ms / 1000,
            max_connections=factory.max_connections,
        )
    return _pools[factory, db]
