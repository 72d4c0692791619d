"""A message log in Parquet files with the Kafka source's columns.

A stored log has a folder per topic and partition, and files in the order of the offsets, so that
what lies before a position need not be read: folders are pruned, and the files' statistics on
``offset`` skip files and row groups.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagstream.operators.offsets import POSITION_KEY, group_positions

MESSAGE_SCHEMA = (
    "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, "
    "timestamp TIMESTAMP, timestampType INT"
)
# Scans into which the partitions of a log are grouped by their position, at most.
MOST_SCANS = 16


def read_message_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MESSAGE_SCHEMA).parquet(path)


def stream_message_log(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def write_message_log(messages: DataFrame, path: str, files: int | None = None) -> None:
    """Append messages to a stored log: files of one topic partition and a narrow range of offsets."""
    order = [*POSITION_KEY, "offset"]
    dealt = messages.repartitionByRange(files, *order) if files else messages.repartitionByRange(*order)
    dealt.sortWithinPartitions(*order).write.mode("append").partitionBy(*POSITION_KEY).parquet(path)


def resume_stored_log(
    spark: SparkSession,
    path: str,
    positions: DataFrame,
    group: str,
    strict: bool = False,
    most_scans: int = MOST_SCANS,
) -> DataFrame:
    """``resume`` on a stored log, without reading what lies before the positions.

    The group's positions come to the driver, one row per topic partition. Partitions of like
    positions share a scan, whose folders are pruned and whose lower bound on ``offset`` is pushed
    to the files; each partition's own bound is applied on top. Partitions without a position
    are read whole, by a scan of their own, or left out if ``strict``.
    """
    log = read_message_log(spark, path)
    known = sorted(
        ((r["next_offset"], r["topic"], r["partition"]) for r in group_positions(positions, group).collect()),
        key=lambda r: (r[0], str(r[1]), r[2]),
    )
    per_scan = -(-len(known) // most_scans) or 1
    scans = [_scan(log, known[i : i + per_scan]) for i in range(0, len(known), per_scan)]
    if not strict:
        scans.append(log.filter(~_any([_at(t, p) for _, t, p in known])) if known else log)
    return reduce(DataFrame.unionByName, scans) if scans else log.filter(F.lit(False))


def _scan(log: DataFrame, some: list[tuple[int, str, int]]) -> DataFrame:
    """The messages of some partitions from their positions on; ``some`` is in ascending order of these."""
    rows = log.filter(_any([_at(t, p) for _, t, p in some])).filter(F.col("offset") >= some[0][0])
    if some[0][0] == some[-1][0]:
        return rows
    return rows.filter(_any([_at(t, p) & (F.col("offset") >= o) for o, t, p in some]))


def _at(topic: str, partition: int):
    return (F.col("topic") == topic) & (F.col("partition") == partition)


def _any(conditions: list):
    return reduce(lambda a, b: a | b, conditions)
