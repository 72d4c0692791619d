import random
from datetime import timedelta, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tagstream.operators.keyed import (
    current,
    first_write_wins,
    insert_ignore,
    last_write_wins,
    needed,
    superseded_dropped,
    version,
    winning_places,
    with_expiry,
)
from tests.messages import START

FEW = settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
ROW = "`k.x` int, timestamp timestamp, partition int, offset bigint, v int"

writes = st.lists(
    st.tuples(st.integers(0, 3), st.integers(0, 2), st.integers(0, 2), st.integers(0, 3)),
    max_size=40, unique_by=lambda w: w[1:],
)


@FEW
@given(writes)
def test_first_and_last_write_agree_with_a_dictionary(spark, rows):
    data = [(k, START + timedelta(seconds=t), p, o, i) for i, (k, t, p, o) in enumerate(rows)]
    df = spark.createDataFrame(data, ROW)
    first, last = {}, {}
    for k, t, p, o, v in sorted(data, key=lambda r: r[1:4]):
        first.setdefault(k, v)
        last[k] = v
    assert {r[0]: r.v for r in last_write_wins(df, ["k.x"], version()).collect()} == last
    assert {r[0]: r.v for r in first_write_wins(df, ["k.x"], version()).collect()} == first


def test_result_does_not_depend_on_partitioning_with_a_hot_key(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).alias("k"),
        F.lit(START).alias("timestamp"), (F.col("id") % 7).cast("int").alias("partition"),
        F.col("id").alias("offset"), F.col("id").alias("v"),
    )
    one = last_write_wins(df.coalesce(1), ["k"], version()).select("k", "v")
    many = last_write_wins(df.repartition(13, "v"), ["k"], version()).select("k", "v")
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()


def test_insert_ignore(spark):
    new = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "time int, v string")
    stored = spark.createDataFrame([(2, "z")], "time int, w string")
    assert {r.time for r in insert_ignore(new, stored, ["time"]).collect()} == {1, 3}


def entry(db, key, written, ver, ttl):
    expires = None if ttl is None else START + timedelta(seconds=written + ttl)
    return (db, key, f"v{ver}", (START, 0, ver), START + timedelta(seconds=written), expires)


ENTRY = (
    "db int, key string, value string, ver struct<timestamp: timestamp, partition: int, offset: bigint>, "
    "written_at timestamp, expires_at timestamp"
)


def at(seconds):
    return START + timedelta(seconds=seconds)


KEY = ["db", "key"]


def test_rewrite_arms_the_expiry_again(spark):
    df = spark.createDataFrame([entry(1, "k", 0, 1, 600), entry(1, "k", 500, 2, 600)], ENTRY)

    def value(second):
        row = current(df, KEY, at(second)).first()
        return row and row.value

    assert [value(s) for s in (-1, 0, 499, 500, 1099, 1100)] == [None, "v1", "v1", "v2", "v2", None]


def test_the_value_never_goes_back(spark):
    df = spark.createDataFrame([entry(1, "k", 0, 2, 600), entry(1, "k", 500, 1, 600)], ENTRY)

    def seen(second):
        row = current(df, KEY, at(second)).first()
        return row and (row.value, row.expires_at.replace(tzinfo=timezone.utc))

    assert [seen(s) for s in (0, 550, 599)] == [("v2", at(600))] * 3
    assert [seen(s) for s in (600, 650, 1099, 1200)] == [None] * 4


def test_no_ttl_never_expires(spark):
    df = spark.createDataFrame([entry(1, "k", 0, 1, 5), entry(1, "k", 0, 2, None)], ENTRY)
    row = current(df, KEY, at(10**8)).first()
    assert (row.value, row.expires_at) == ("v2", None)


def slow_view(rows, as_of):
    """Key and value of the highest version made by then, if it lives."""
    out = {}
    for ver, (key, written, ttl) in enumerate(rows):
        if written <= as_of:
            out[key] = (ver, ttl is None or written + ttl > as_of)
    return {(f"k{k}", f"v{v}") for k, (v, alive) in out.items() if alive}


@FEW
@given(
    st.lists(st.tuples(st.integers(0, 1), st.integers(0, 30), st.sampled_from([None, 3, 10, 20])), max_size=25),
    st.integers(10, 60),
)
def test_what_is_dropped_changes_no_later_view(spark, rows, later):
    df = spark.createDataFrame([entry(1, f"k{k}", w, i, ttl) for i, (k, w, ttl) in enumerate(rows)], ENTRY)
    want = slow_view(rows, later)
    for kept in (df, needed(df, KEY, at(10)), needed(df, KEY, at(10)).unionByName(df)):
        assert {(r.key, r.value) for r in current(kept, KEY, at(later)).collect()} == want
    reduced = superseded_dropped(df, KEY, at(31))
    if later >= 31:
        assert {(r.key, r.value) for r in current(reduced, KEY, at(later)).collect()} == want


def test_in_order_writes_leave_one_row_per_key(spark):
    data = [entry(1, "k", w, w, 600) for w in range(50)]
    assert superseded_dropped(spark.createDataFrame(data, ENTRY), KEY, at(60)).count() == 1


def test_with_expiry(spark):
    df = with_expiry(spark.range(1), F.lit(START), 90).first()
    assert (df.expires_at - df.written_at).total_seconds() == 90


@pytest.mark.parametrize("last", [True, False])
def test_packed_versions_order_as_the_struct(spark, last):
    rng = random.Random(4)
    rows = [
        (rng.randrange(5), rng.randrange(3), rng.randrange(4), rng.choice([0, 1, 10**15 - 1, 7]))
        for _ in range(300)
    ]
    df = spark.createDataFrame(rows, "k int, s int, partition int, offset bigint").withColumn(
        "timestamp", F.expr("timestamp_micros(1704067200123456 + s)")
    )
    got = {(r.k, r.timestamp.microsecond - 123456, r.partition, r.offset) for r in winning_places(df, ["k"], last).collect()}
    pick = max if last else min
    assert got == {pick(r for r in rows if r[0] == k) for k in range(5)}
    text = winning_places(df, ["k"], last)._jdf.queryExecution().executedPlan().toString()
    assert text.count("HashAggregate(") == 2 and "SortAggregate" not in text and "ObjectHash" not in text


@pytest.mark.parametrize("row", [(0, 10**15), (10**5, 0), (-1, 0), (0, -1)])
def test_versions_that_cannot_be_packed(spark, row):
    df = spark.createDataFrame([(1, *row)], "k int, partition int, offset bigint").withColumn("timestamp", F.current_timestamp())
    with pytest.raises(PySparkException):
        winning_places(df, ["k"]).collect()
