"""Producing messages: one text per record, no key."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def producer_records(rows: DataFrame, topic: str, value: Column | str = "value") -> DataFrame:
    text = F.col(value) if isinstance(value, str) else value
    return rows.select(
        F.lit(None).cast("string").alias("key"),
        text.cast("string").alias("value"),
        F.lit(topic).alias("topic"),
    )


def _options(servers: str, more: Mapping[str, str] | None) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, **(more or {})}


def send_to_kafka(records: DataFrame, servers: str, more: Mapping[str, str] | None = None) -> None:
    """Needs the public ``spark-sql-kafka`` package on the class path."""
    records.write.format("kafka").options(**_options(servers, more)).save()


def stream_to_kafka(
    records: DataFrame, servers: str, checkpoint: str, more: Mapping[str, str] | None = None
) -> DataStreamWriter:
    """A writer for streaming records; set its trigger and start it."""
    writer = records.writeStream.format("kafka").options(**_options(servers, more))
    return writer.option("checkpointLocation", checkpoint)
