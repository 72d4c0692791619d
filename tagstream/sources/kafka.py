"""The Kafka source.

Needs the public ``spark-sql-kafka`` package on the class path. Positions given
explicitly apply to a query's first start only; afterwards its checkpoint decides.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagstream.operators.offsets import group_positions

EARLIEST = -2

Positions = Mapping[str, Mapping[int, int]]


def starting_offsets(positions: Positions, partitions: Mapping[str, Iterable[int]] | None = None) -> str:
    """Positions as the source's JSON; listed partitions without one start at the earliest."""
    full = {
        topic: {str(p): EARLIEST for p in (partitions or {}).get(topic, ())}
        | {str(p): int(o) for p, o in of_topic.items()}
        for topic, of_topic in positions.items()
    }
    return json.dumps(full, sort_keys=True)


def kafka_options(
    servers: str,
    topic: str,
    positions: Positions | None = None,
    partitions: Iterable[int] | None = None,
    strict: bool = False,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    more: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Source options. No positions: start at the newest offset.

    With positions, ``partitions`` lists all partitions of the topic, because the
    source wants a start for each; ``strict`` reads only those with a position.
    ``more`` are further options of the source (security, ``failOnDataLoss`` and so on).
    """
    options = {"kafka.bootstrap.servers": servers}
    if positions is None:
        options |= {"subscribe": topic, "startingOffsets": "latest"}
    elif strict:
        known = sorted(positions[topic])
        options["assign"] = json.dumps({topic: known})
        options["startingOffsets"] = starting_offsets({topic: positions[topic]})
    else:
        options["subscribe"] = topic
        options["startingOffsets"] = starting_offsets(
            {topic: positions[topic]}, {topic: partitions or ()}
        )
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options | dict(more or {})


def start_options(
    stored: DataFrame,
    group: str,
    servers: str,
    topic: str,
    partitions: Iterable[int] | None = None,
    **kwargs,
) -> dict[str, str]:
    """Source options that start where the group's stored positions say.

    Without a stored position of the topic the stream starts at the newest offset. Otherwise
    it reads the partitions that have one, or, if ``partitions`` lists all of the topic, the
    others too, from their beginning. One row per partition of the topic comes to the driver.
    """
    rows = group_positions(stored.filter(F.col("topic") == topic), group).collect()
    if not rows:
        return kafka_options(servers, topic, **kwargs)
    positions = {topic: {r["partition"]: r["next_offset"] for r in rows}}
    return kafka_options(servers, topic, positions, partitions, strict=partitions is None, **kwargs)


def read_kafka_stream(spark: SparkSession, servers: str, topic: str, **kwargs) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, **kwargs)).load()


def resume_kafka_stream(
    spark: SparkSession, stored: DataFrame, group: str, servers: str, topic: str, **kwargs
) -> DataFrame:
    """The stream from the group's stored positions; once it has a checkpoint, that decides."""
    options = start_options(stored, group, servers, topic, **kwargs)
    return spark.readStream.format("kafka").options(**options).load()
