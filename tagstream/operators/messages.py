"""From messages to readings: projection, parsing, quarantine, cache entries."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagstream.constants import CACHE_DB, CACHE_PREFIX, TIME_FIELD
from tagstream.functions import json as J
from tagstream.functions.plan import with_column_once
from tagstream.functions.time import instant, with_epoch
from tagstream.operators.keyed import last_write_wins, version, winning_places, with_expiry
from tagstream.session import check_session

LINEAGE = ("topic", "partition", "offset", "timestamp")
MODES = ("PERMISSIVE", "FAILFAST")


def project_messages(
    messages: DataFrame, handler: Callable[[DataFrame], list[Column]] | None = None
) -> DataFrame:
    """Message body as text with its lineage; ``handler`` adds columns of the caller's own."""
    extra = handler(messages) if handler else []
    return messages.select(*LINEAGE, F.col("value").cast("string").alias("value"), *extra)


def parse_readings(
    messages: DataFrame,
    zone: str = "UTC",
    lenient: bool = False,
    mode: str = "PERMISSIVE",
    handler: Callable[[DataFrame], list[Column]] | None = None,
) -> DataFrame:
    """Add ``body`` (VARIANT), ``time_text``, ``time`` (epoch seconds) and ``reason``.

    ``reason`` is NULL for a usable reading, else why it is not one. FAILFAST
    raises on the first unusable message instead.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    check_session(messages.sparkSession)
    body, text, epoch = F.col("body"), F.col("time_text"), F.col("time")
    readings = project_messages(messages, handler)
    readings = with_column_once(readings, "body", J.parse_body(F.col("value")))
    readings = with_column_once(readings, "time_text", J.get_tag(body, TIME_FIELD, "string"))
    readings = with_epoch(readings, "time", text, zone, lenient)
    reason = (
        F.when(epoch.isNotNull(), F.lit(None).cast("string"))
        .when(body.isNull(), "not_json")
        .when(J.tag_map(body).isNull(), "not_object")
        .when(text.isNull(), "missing_time")
        .otherwise("bad_time")
    )
    readings = readings.withColumn("reason", reason)
    if mode == "FAILFAST":
        place = F.concat_ws(" ", "reason", "topic", F.col("partition"), F.col("offset"))
        failure = F.raise_error(F.concat(F.lit("unusable message: "), place)).cast("boolean")
        readings = readings.filter(F.when(epoch.isNull(), failure).otherwise(True))
    return readings


def usable(readings: DataFrame) -> DataFrame:
    return readings.filter(F.col("time").isNotNull())


def quarantined(readings: DataFrame) -> DataFrame:
    return readings.filter(F.col("time").isNull()).select(
        "value", "topic", "partition", "offset", "reason"
    )


def rewrite_time(readings: DataFrame) -> DataFrame:
    """Replace ``value`` by the body with epoch time and without null fields."""
    return readings.withColumn("value", J.body_with_epoch(F.col("body"), F.col("time")))


def reading_entries(readings: DataFrame, *keep: str) -> DataFrame:
    """One row per field of each reading: the kept columns, ``tag`` and ``number``.

    The time field's number is the epoch; a value that is no number gives NULL.
    """
    entries = readings.select(
        *keep, F.col("time").alias("_epoch"), F.explode(J.tag_map(F.col("body"))).alias("tag", "_v")
    )
    number = F.when(F.col("tag") == TIME_FIELD, F.col("_epoch").cast("double")).otherwise(
        F.try_variant_get("_v", "$", "double")
    )
    return entries.select(*keep, "tag", number.alias("number"))


def cache_key(time: Column, prefix: str = CACHE_PREFIX, *parts: Column) -> Column:
    """Prefix and epoch, then any further key parts after a colon each."""
    key = F.concat(F.lit(prefix), time.cast("string"))
    for part in parts:
        key = F.concat(key, F.lit(":"), part.cast("string"))
    return key


def latest_entries(
    readings: DataFrame,
    written_at: datetime | Column | None = None,
    ttl_seconds: int | None = None,
    prefix: str = CACHE_PREFIX,
    db: int | str = CACHE_DB,
    key_columns: tuple[str, ...] = (),
    *keep: str,
) -> DataFrame:
    """Cache entries of usable readings, the last write per key.

    The body travels as VARIANT and only winners are serialised. ``db`` is a
    number or the name of a column that holds it. ``keep`` names columns that
    ``written_at`` needs.
    """
    # The time leads the keys: the map-side sort compares its first key as a plain number.
    keys = ["time", *key_columns]
    if isinstance(db, str):
        readings = readings.withColumn("db", F.col(db).cast("int"))
        keys.append("db")
    rows = readings.select(*keys, *keep, "body", version().alias("ver"))
    latest = last_write_wins(rows, keys, F.col("ver"))
    if not isinstance(db, str):
        latest = latest.withColumn("db", F.lit(db).cast("int"))
    entries = _entries(latest, prefix, key_columns, *keep)
    return with_expiry(entries, instant(written_at), ttl_seconds).drop(*keep)


def latest_messages(
    messages: DataFrame, zone: str = "UTC", lenient: bool = False, last: bool = True
) -> DataFrame:
    """The raw messages of one topic that are the last (or first) usable ones of their second.

    Of every message only the second and a packed version are aggregated, in a hash aggregate; the
    winners' bodies are fetched by a join on partition, offset and timestamp, which reads the log a second
    time. That pays where bodies are large; ``latest_entries`` carries the bodies along and reads once.
    """
    usable_rows = usable(parse_readings(messages, zone, lenient))
    places = winning_places(usable_rows.select("time", *LINEAGE[1:]), ["time"], last).drop("time")
    return messages.join(places, ["timestamp", "partition", "offset"], "left_semi")


def message_entries(
    readings: DataFrame,
    written_at: datetime | Column | None = None,
    ttl_seconds: int | None = None,
    prefix: str = CACHE_PREFIX,
    db: int = CACHE_DB,
    key_columns: tuple[str, ...] = (),
) -> DataFrame:
    """A cache entry per usable reading, as it comes; what reads them lets the highest version win."""
    rows = readings.withColumns({"ver": version(), "db": F.lit(db).cast("int")})
    return with_expiry(_entries(rows, prefix, key_columns), instant(written_at), ttl_seconds)


def _entries(rows: DataFrame, prefix: str, key_columns: tuple[str, ...], *keep: str) -> DataFrame:
    key = cache_key(F.col("time"), prefix, *[F.col(c) for c in key_columns])
    return rows.select(
        "db",
        key.alias("key"),
        J.body_with_epoch(F.col("body"), F.col("time")).alias("value"),
        "ver",
        *keep,
    )
