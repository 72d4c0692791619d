from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagstream.functions.time import epoch_seconds, instant

FEW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def epochs(spark, texts, **kwargs):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", epoch_seconds(F.col("t"), **kwargs).alias("e")).orderBy("i").collect()
    return [r.e for r in rows]


def utc(*fields):
    return int(datetime(*fields, tzinfo=timezone.utc).timestamp())


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York", "Asia/Shanghai"])
def test_zone_is_the_operators_not_the_sessions(spark, session_zone):
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        texts = ["2017-08-01 10:00:00", "2024-03-10 02:30:00", "2024-11-03 01:30:00"]
        assert epochs(spark, texts) == [utc(2017, 8, 1, 10), utc(2024, 3, 10, 2, 30), utc(2024, 11, 3, 1, 30)]
        assert epochs(spark, texts[:1], zone="Asia/Shanghai") == [1501552800]
        assert epochs(spark, ["2017-13-01 10:00:00"], lenient=True) == [utc(2018, 1, 1, 10)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


STRICTLY_BAD = [
    "2017-13-01 10:00:00", "2017-8-1 1:2:3", "2017-08-01 10:00:00.5", "2017-02-30 00:00:00",
    " 2017-08-01 10:00:00", "2017-08-01", "ping", "", None,
]


def test_strict_rejects(spark):
    assert epochs(spark, STRICTLY_BAD) == [None] * len(STRICTLY_BAD)


def test_lenient_rolls_over(spark):
    want = [
        utc(2018, 1, 1, 10), utc(2017, 8, 1, 1, 2, 3), utc(2017, 8, 1, 10), utc(2017, 3, 2),
        utc(2017, 8, 1, 10), None, None, None, None,
    ]
    assert epochs(spark, STRICTLY_BAD, lenient=True) == want
    odd = ["2017-08-01 25:61:61 and more", "2017-00-00 00:00:00", "9999-99-99 99:99:99"]
    assert epochs(spark, odd, lenient=True) == [utc(2017, 8, 2, 2, 2, 1), utc(2016, 11, 30), None]


def test_lenient_takes_fields_of_any_length(spark):
    texts = [
        "2017-08-01 10:00:12345", "2017-00008-01 10:00:00", "2017-08-01 10:12345:00", "2017-08-100000 00:00:00",
        "02017-08-01 10:00:00", "2017-08-01 10:00:3000000000", "2017-08-01 10:00:" + "9" * 30, "99999-01-01 00:00:00",
        "0-0-1 00:00:00", "2017-999999999999-01 00:00:00",
    ]
    start = utc(2017, 8, 1, 10)
    assert epochs(spark, texts, lenient=True) == [
        start + 12345, start, start + 12345 * 60, utc(2017, 8, 1) + 99_999 * 86_400, start, start + 3_000_000_000,
        None, None, None, None,
    ]
    shanghai = epochs(spark, texts[:2], lenient=True, zone="Asia/Shanghai")
    assert shanghai == [start + 12345 - 8 * 3600, start - 8 * 3600]


@FEW
@given(st.lists(st.datetimes(datetime(1970, 1, 2), datetime(2100, 1, 1)), min_size=1, max_size=30))
def test_strict_agrees_with_python(spark, moments):
    whole = [m.replace(microsecond=0) for m in moments]
    texts = [m.strftime("%Y-%m-%d %H:%M:%S") for m in whole]
    assert epochs(spark, texts) == [int(m.replace(tzinfo=timezone.utc).timestamp()) for m in whole]
    assert epochs(spark, texts, lenient=True) == epochs(spark, texts)


@FEW
@given(st.lists(
    st.tuples(*[st.integers(0, n) for n in (40, 99, 99, 99, 99)]), min_size=1, max_size=30))
def test_lenient_agrees_with_calendar_arithmetic(spark, fields):
    def model(mo, d, h, mi, s):
        month = datetime(2017 + (mo - 1) // 12, (mo - 1) % 12 + 1, 1, tzinfo=timezone.utc)
        return int((month + timedelta(days=d - 1, hours=h, minutes=mi, seconds=s)).timestamp())

    texts = ["2017-%d-%d %d:%d:%d" % f for f in fields]
    assert epochs(spark, texts, lenient=True) == [model(*f) for f in fields]


def test_wall_clock_in_a_zone_with_daylight_saving(spark):
    zone = ZoneInfo("Europe/Berlin")
    moments = [datetime(2024, 1, 1, 12), datetime(2024, 7, 1, 12), datetime(2024, 3, 31, 4)]
    texts = [m.strftime("%Y-%m-%d %H:%M:%S") for m in moments]
    want = [int(m.replace(tzinfo=zone).timestamp()) for m in moments]
    assert epochs(spark, texts, zone="Europe/Berlin") == want


def test_unknown_zone_is_refused(spark):
    with pytest.raises(Exception):
        epochs(spark, ["2017-08-01 10:00:00"], zone="Mars/Base")
    assert epochs(spark, ["2017-08-01 10:00:00"], zone="+08:00") == [1501552800]


def test_instant_needs_a_zone(spark):
    with pytest.raises(ValueError):
        instant(datetime(2024, 1, 1))
    at = datetime(2024, 1, 1, 0, 0, 0, 250_000, tzinfo=timezone.utc)
    assert spark.range(1).select(F.unix_micros(instant(at))).first()[0] == utc(2024, 1, 1) * 10**6 + 250_000
