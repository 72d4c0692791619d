"""First arrival wins, decided in the stream's own state.

The state holds, per key, the row that came first: of the earliest batch that had the key, the
one of the lowest partition and offset. So nothing stored is looked up, and a row that was
shown is never replaced, whatever the messages' own times. The state grows with the keys, as the
table does; a state store on disk (Spark's RocksDB provider) holds more than memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tagstream.constants import BATCH_SECONDS, TIME_FIELD
from tagstream.functions.plan import quoted
from tagstream.operators.messages import parse_readings, usable
from tagstream.operators.tableschema import conform
from tagstream.sinks.table import ParquetTable, tags_of

# Column with the time of the batch.
STAMP = "batch_time"


def first_arrivals(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The first row per key of a stream, in the batch in which it comes (output mode ``update``).

    ``rows`` carry ``ver`` and the time of their batch (``STAMP``, ``current_timestamp()`` of the stream).
    """
    rest = [c for c in rows.columns if c not in keys]
    arrival = F.struct(STAMP, "ver.partition", "ver.offset")
    first = F.min_by(F.struct(*[F.col(quoted(c)) for c in rest]), arrival).alias("_first")
    firsts = rows.groupBy(*[quoted(k) for k in keys]).agg(first)
    # A key that comes again is updated too, but its row is of an earlier batch.
    new = firsts.filter(F.col(f"_first.{STAMP}") == F.current_timestamp())
    return new.select(*[quoted(k) for k in keys], *[F.col(f"_first.{quoted(c)}") for c in rest if c != STAMP])


def start_first_arrivals(
    messages: DataFrame,
    table: ParquetTable,
    checkpoint: str,
    tags: list[str],
    zone: str = "UTC",
    lenient: bool = False,
    batch_seconds: float = BATCH_SECONDS,
    available_now: bool = False,
) -> StreamingQuery:
    """Append the first reading per time that arrives to a table of fixed ``tags``.

    The table is created if it is not there; if it is, its columns stand. What is stored before
    the stream's first start is not known to the state: start with an empty table.
    """
    if table.schema() is None:
        fields = [T.StructField(TIME_FIELD, T.LongType(), False), *[T.StructField(t, T.DoubleType()) for t in tags]]
        table.create(T.StructType(fields))
    stamped = messages.withColumn(STAMP, F.current_timestamp())
    readings = parse_readings(stamped, zone, lenient, handler=lambda _: [F.col(STAMP)])
    rows = conform(usable(readings), tags_of(table.schema()), keep=(STAMP,)).drop("n_rejected")
    writer = first_arrivals(rows, [TIME_FIELD]).writeStream.outputMode("update").foreachBatch(table.append)
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{batch_seconds} seconds"}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
