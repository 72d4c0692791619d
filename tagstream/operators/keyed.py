"""Keyed-store semantics: last/first write wins, insert-if-absent, time to live."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagstream.functions.plan import quoted
from tagstream.functions.time import instant


def version(timestamp: str = "timestamp", partition: str = "partition", offset: str = "offset") -> Column:
    """Total order of writes, whatever the batching: message time, partition, offset."""
    return F.struct(
        F.col(timestamp).alias("timestamp"),
        F.col(partition).alias("partition"),
        F.col(offset).alias("offset"),
    )


def last_write_wins(df: DataFrame, keys: list[str], ver: Column) -> DataFrame:
    """The row with the highest version per key.

    ``max_by`` reduces on the map side, so a key that holds a large share of the
    rows reaches the shuffle as one row per input task.
    """
    return _pick(df, keys, F.max_by, ver)


def first_write_wins(df: DataFrame, keys: list[str], ver: Column) -> DataFrame:
    """The row with the lowest version per key; reduced on the map side too."""
    return _pick(df, keys, F.min_by, ver)


def _pick(df: DataFrame, keys: list[str], by, ver: Column) -> DataFrame:
    rest = ", ".join(quoted(c) for c in df.columns if c not in keys)
    key_columns = [quoted(k) for k in keys]
    winner = by(F.expr(f"struct({rest})"), ver).alias("_winner")
    return df.groupBy(*key_columns).agg(winner).select(*key_columns, "_winner.*")


# Digits of a packed version below the message's microseconds.
_OFFSET, _PARTITION = 10**15, 10**5


def packed_version(timestamp: str = "timestamp", partition: str = "partition", offset: str = "offset") -> Column:
    """``version`` as one decimal, which a hash aggregate keeps in place; an error for numbers it cannot hold."""
    fits = (
        F.col(offset).between(0, _OFFSET - 1)
        & F.col(partition).between(0, _PARTITION - 1)
        & (F.unix_micros(timestamp) >= 0)
    )
    packed = F.expr(
        f"cast(unix_micros({quoted(timestamp)}) AS decimal(17,0)) * {_PARTITION}BD * {_OFFSET}BD"
        f" + cast({quoted(partition)} AS decimal(20,0)) * {_OFFSET}BD + cast({quoted(offset)} AS decimal(20,0))"
    ).cast("decimal(38,0)")
    return F.when(fits, packed).otherwise(F.raise_error(F.lit("a version that does not fit")).cast("decimal(38,0)"))


def winning_places(rows: DataFrame, keys: list[str], last: bool = True) -> DataFrame:
    """Per key the ``timestamp``, ``partition`` and ``offset`` of its highest (or lowest) version.

    Nothing but keys and a number of fixed width is aggregated and shuffled, so that no body is
    sorted; ``rows`` carry the three columns.
    """
    pick = F.max if last else F.min
    best = rows.groupBy(*[quoted(k) for k in keys]).agg(pick(packed_version()).alias("_v"))
    place = "cast(_v % {0}BD AS bigint)".format(_OFFSET)
    # An integral division gives a long, so what is above goes first.
    partition = f"cast((_v % {_OFFSET * _PARTITION}BD) div {_OFFSET}BD AS int)"
    micros = f"_v div {_OFFSET * _PARTITION}BD"
    return best.select(
        *[quoted(k) for k in keys],
        F.expr(f"timestamp_micros({micros})").alias("timestamp"),
        F.expr(partition).alias("partition"),
        F.expr(place).alias("offset"),
    )


def insert_ignore(new: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """New rows whose key is not stored yet. ``new`` should hold one row per key."""
    return new.join(stored.select(*keys), keys, "left_anti")


def with_expiry(df: DataFrame, written_at: Column, ttl_seconds: int | None) -> DataFrame:
    """Add ``written_at`` and ``expires_at`` (NULL: never)."""
    expires = F.lit(None).cast("timestamp")
    if ttl_seconds is not None:
        expires = F.col("written_at") + F.make_dt_interval(
            F.lit(0), F.lit(0), F.lit(0), F.lit(ttl_seconds)
        )
    return df.withColumn("written_at", written_at).withColumn("expires_at", expires)


def unexpired(entries: DataFrame, as_of: datetime | Column | None = None) -> DataFrame:
    return entries.filter(
        F.col("expires_at").isNull() | (F.col("expires_at") > instant(as_of))
    )


def current(entries: DataFrame, keys: list[str], as_of: datetime | Column | None = None) -> DataFrame:
    """The live entries at ``as_of``: of the writes made by then the highest version, with its own expiry.

    A superseded write never shows again, even if it lives longer than the one that superseded
    it. Reduced on the map side.
    """
    made = entries.filter(F.col("written_at") <= instant(as_of))
    return unexpired(last_write_wins(made, keys, F.col("ver")), as_of)


def needed(entries: DataFrame, keys: list[str], as_of: datetime | Column | None = None) -> DataFrame:
    """Entries that a view at or after ``as_of`` can depend on.

    These are the unexpired ones, and the expired ones that hide an unexpired write of lower
    version.
    """
    alive = F.col("expires_at").isNull() | (F.col("expires_at") > instant(as_of))
    lowest = entries.filter(alive).groupBy(*keys).agg(F.min("ver").alias("lowest"))
    marked = entries.withColumn("alive", alive).join(lowest, keys, "left")
    return marked.filter(F.col("alive") | (F.col("ver") > F.col("lowest"))).drop("alive", "lowest")


def superseded_dropped(
    entries: DataFrame, keys: list[str], as_of: datetime | Column | None = None
) -> DataFrame:
    """What a view at or after ``as_of`` still needs, as few rows as that takes.

    Of the writes made by then the highest version, unless it has expired and nothing of its
    key lives; and the writes of a clock ahead.
    """
    rows = needed(entries, keys, as_of)
    made = F.col("written_at") <= instant(as_of)
    return last_write_wins(rows.filter(made), keys, F.col("ver")).unionByName(rows.filter(~made))
