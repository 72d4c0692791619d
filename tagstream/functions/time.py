"""Text time to epoch seconds in a named zone, independent of the session zone."""

from __future__ import annotations

import re
from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagstream.constants import TIME_PATTERN
from tagstream.functions.plan import with_column_once

_LENIENT = r"^\s*(\d+-\d+-\d+\s+\d+:\d+:\d+)"
DAY = 86_400
# Wall clocks from year 0 to the end of 9999, as seconds of 1970 on.
_FIRST, _LAST = -62_167_219_200, 253_402_300_799


def check_zone(zone: str) -> None:
    """An unknown zone would make every time text unreadable, so it is refused early."""
    if not re.fullmatch(r"[+-]\d\d:\d\d", zone):
        ZoneInfo(zone)


def parse_time(text: Column, zone: str = "UTC", lenient: bool = False) -> Column:
    """Instant of a wall-clock text in ``zone``; NULL where the text does not fit.

    ``lenient`` rolls over fields out of range (month 13, hour 25), accepts short
    fields and leading blanks, and ignores what follows the seconds. For whole tables
    ``with_epoch`` is cheaper.
    """
    check_zone(zone)
    if lenient:
        # Bound by functions, so that the text is taken apart once.
        wall = F.transform(F.array(time_fields(text)), lambda f: _wall_seconds(f, _months(f)))
        return F.transform(wall, lambda w: F.to_utc_timestamp(F.timestamp_seconds(_in_range(w)), zone))[0]
    return F.try_to_timestamp(F.concat(text, F.lit(f" {zone}")), F.lit(f"{TIME_PATTERN} VV"))


def epoch_seconds(text: Column, zone: str = "UTC", lenient: bool = False) -> Column:
    return F.unix_timestamp(parse_time(text, zone, lenient))


def with_epoch(df: DataFrame, name: str, text: Column, zone: str = "UTC", lenient: bool = False) -> DataFrame:
    """Add ``epoch_seconds`` of a text; the text is taken apart once per row, within generated code."""
    check_zone(zone)
    if not lenient:
        return with_column_once(df, name, epoch_seconds(text, zone))
    fields, months, wall = (f"_{name}_{part}" for part in ("fields", "months", "wall"))
    df = with_column_once(df, fields, time_fields(text))
    df = with_column_once(df, months, _months(F.col(fields)))
    df = with_column_once(df, wall, _wall_seconds(F.col(fields), F.col(months)))
    epoch = _in_range(F.col(wall))
    if zone != "UTC":
        epoch = F.unix_timestamp(F.to_utc_timestamp(F.timestamp_seconds(epoch), zone))
    return with_column_once(df, name, epoch).drop(fields, months, wall)


def time_fields(text: Column) -> Column:
    """The six numbers as an array, NULL where one is too long for a number; another text gives fewer than six."""
    # One character parts the numbers: such a split needs no pattern.
    parted = F.translate(F.regexp_replace(F.regexp_extract(text, _LENIENT, 1), r"\s+", "-"), ":", "-")
    return F.split(parted, "-").try_cast("array<bigint>")


def _months(fields: Column) -> Column:
    """Months since the beginning of year 0."""
    return _field(fields, 0) * 12 + _field(fields, 1) - 1


def _wall_seconds(fields: Column, months: Column) -> Column:
    """Seconds of the wall clock since 1970, however large each field is; NULL for a month outside the years 0 to 9999."""
    day, hour, minute, second = (_field(fields, place) for place in range(2, 6))
    year_0 = F.lit("0000-01-01").cast("date")
    first = F.when(months.between(0, 119_999), F.unix_date(F.add_months(year_0, months.cast("int"))))
    return (first + day - 1) * DAY + hour * 3600 + minute * 60 + second


def _in_range(wall: Column) -> Column:
    return F.when(wall.between(_FIRST, _LAST), wall)


def _field(fields: Column, place: int) -> Column:
    """One of the six numbers; one so large that the time is out of range anyway is NULL."""
    value = F.get(fields, F.lit(place))
    return F.when(value <= 10**12, value)


def instant(at: datetime | Column | None) -> Column:
    """A point in time as a column: now if None; a datetime must carry its zone."""
    if at is None:
        return F.current_timestamp()
    if isinstance(at, datetime):
        if at.tzinfo is None:
            raise ValueError("the datetime needs a time zone")
        whole = int(at.replace(microsecond=0).timestamp())
        return F.timestamp_micros(F.lit(whole * 1_000_000 + at.microsecond).cast("bigint"))
    return at
