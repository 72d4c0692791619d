"""Offset ranges, committed positions, resuming a message log from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

POSITION_KEY = ["topic", "partition"]


def offset_ranges(messages: DataFrame, *by: str) -> DataFrame:
    """``[from_offset, until_offset)`` and row count per topic partition (and batch)."""
    return messages.groupBy(*by, *POSITION_KEY).agg(
        F.min("offset").alias("from_offset"),
        (F.max("offset") + 1).alias("until_offset"),
        F.count(F.lit(1)).alias("n"),
    )


def commit_offsets(ranges: DataFrame, group: str) -> DataFrame:
    """The next offset to read per topic partition for a consumer group."""
    return (
        ranges.groupBy(*POSITION_KEY)
        .agg(F.max("until_offset").cast("bigint").alias("next_offset"))
        .select(F.lit(group).alias("group"), *POSITION_KEY, "next_offset")
    )


def group_positions(positions: DataFrame, group: str) -> DataFrame:
    """A group's positions, one row per topic partition: the furthest it has committed."""
    return (
        positions.filter(F.col("group") == group)
        .groupBy(*POSITION_KEY)
        .agg(F.max("next_offset").cast("bigint").alias("next_offset"))
    )


def resume(messages: DataFrame, positions: DataFrame, group: str, strict: bool = False) -> DataFrame:
    """Messages at or after the group's committed position of their partition.

    ``positions`` may hold several groups and several commits (``group``, ``topic``,
    ``partition``, ``next_offset``). A partition without a position is read from its start, or
    left out if ``strict``. One join, which the optimizer broadcasts or splits by the size it
    finds; to start a Kafka stream without reading what is done, see ``start_options``.
    """
    known = group_positions(positions, group)
    joined = messages.join(known, POSITION_KEY, "inner" if strict else "left")
    start = F.coalesce(F.col("next_offset"), F.lit(0))
    return joined.filter(F.col("offset") >= start).select(*messages.columns)


def newest_positions(log: DataFrame, group: str = "") -> DataFrame:
    """Where a consumer without committed positions starts: the end of the log, in one reduction."""
    ends = log.groupBy(*POSITION_KEY).agg((F.max("offset") + 1).cast("bigint").alias("next_offset"))
    return ends.select(F.lit(group).alias("group"), *POSITION_KEY, "next_offset")


def start_latest(messages: DataFrame, log_at_start: DataFrame) -> DataFrame:
    """Messages that arrived after ``log_at_start``; new partitions in full."""
    return resume(messages, newest_positions(log_at_start), "")
