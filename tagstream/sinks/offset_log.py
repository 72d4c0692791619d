"""The audit table of offset ranges per batch, and the positions it implies."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagstream.operators.offsets import commit_offsets
from tagstream.sinks.batch_store import BATCH, BatchStore

RANGE_SCHEMA = "batch_id BIGINT, topic STRING, partition INT, from_offset BIGINT, until_offset BIGINT, n BIGINT"


class OffsetLog:
    def __init__(self, spark: SparkSession, root: str, group: str):
        self.group = group
        self.batches = BatchStore(spark, root, RANGE_SCHEMA)

    def append(self, ranges: DataFrame, batch_id: int) -> None:
        columns = ("topic", "partition", "from_offset", "until_offset", "n")
        self.batches.write(ranges.select(F.lit(batch_id).cast("bigint").alias("batch_id"), *columns), batch_id)

    def ranges(self) -> DataFrame:
        return self.batches.read().drop(BATCH).distinct()

    def positions(self) -> DataFrame:
        """The next offset per partition; a replayed or repeated range changes nothing."""
        return commit_offsets(self.batches.read(), self.group)


def ranges_from_progress(spark: SparkSession, start: str | None, end: str) -> DataFrame:
    """Ranges of a Kafka query's progress (``startOffset`` and ``endOffset`` JSON).

    These come with the progress report after the batch is committed, so no message
    is read a second time.
    """
    begin = json.loads(start) if start else {}
    rows = [
        (topic, int(p), begin.get(topic, {}).get(p), until)
        for topic, of_topic in json.loads(end).items()
        for p, until in of_topic.items()
    ]
    rows = [(None, t, p, f, u, None if f is None else u - f) for t, p, f, u in rows]
    return spark.createDataFrame(rows, RANGE_SCHEMA)
