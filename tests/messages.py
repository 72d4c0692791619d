"""Hand-made messages with the Kafka source's columns."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from tagstream.sources.message_log import MESSAGE_SCHEMA

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def message(value, partition=0, offset=0, at=0, topic="readings"):
    """``at``: message time in seconds after START."""
    body = value.encode() if isinstance(value, str) else value
    return (None, body, topic, partition, offset, START + timedelta(seconds=at), 0)


def frame(spark, messages):
    return spark.createDataFrame(messages, MESSAGE_SCHEMA)


def bodies(spark, *values):
    """One message per body, at increasing offsets."""
    return frame(spark, [message(v, offset=i, at=i) for i, v in enumerate(values)])
