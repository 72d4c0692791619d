"""What a stream keeps in Spark's state: entries that expire, and the first arrival per key."""

import json
import time

import pytest

from tagstream.sinks.table import ParquetTable
from tagstream.sources.message_log import stream_message_log
from tagstream.streaming.arrival import start_first_arrivals
from tagstream.streaming.expiry import EMPTY_BATCHES, PROVIDER, live_entries, start_state_cache, use_state_on_disk
from tests.messages import frame, message


def body(second, value):
    return json.dumps({"time": f"2024-01-01 00:00:{second:02d}", "v.a": value})


def add(spark, path, *messages):
    frame(spark, list(messages)).coalesce(1).write.mode("append").parquet(path)
    # Files are read in the order of their times.
    time.sleep(0.05)


@pytest.fixture
def on_disk(spark):
    before = spark.conf.get(PROVIDER, None)
    use_state_on_disk(spark)
    yield
    spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


def keep(spark, tmp_path, ttl):
    query = start_state_cache(
        stream_message_log(spark, str(tmp_path / "log")), str(tmp_path / "c"), ttl, available_now=True
    )
    query.awaitTermination()


def live(spark, tmp_path):
    return {r.key[-2:]: json.loads(r.value)["v.a"] for r in live_entries(spark, str(tmp_path / "c")).collect()}


def held(spark, tmp_path):
    """Keys in the state, expired or not."""
    state = spark.read.format("statestore").option("stateVarName", "entry").load(str(tmp_path / "c"))
    return {r.key.key[-2:] for r in state.collect()}


def test_rewrite_arms_anew_and_what_expired_is_gone(spark, tmp_path, on_disk):
    log, ttl = str(tmp_path / "log"), 20
    add(spark, log, message(body(1, 1), offset=0, at=1), message(body(2, 2), offset=1, at=2), message("ping", offset=2))
    keep(spark, tmp_path, ttl)
    first = {r.key[-2:]: r.expires_at for r in live_entries(spark, str(tmp_path / "c")).collect()}
    assert live(spark, tmp_path) == {"01": 1, "02": 2}
    time.sleep(2)
    # An older reading that comes late changes nothing and does not arm anew.
    add(spark, log, message(body(1, 3), offset=3, at=3), message(body(2, 9), offset=4, at=0))
    keep(spark, tmp_path, ttl)
    second = {r.key[-2:]: r.expires_at for r in live_entries(spark, str(tmp_path / "c")).collect()}
    assert live(spark, tmp_path) == {"01": 3, "02": 2}
    assert second["01"] > first["01"] and second["02"] == first["02"]
    time.sleep(max(0, second["02"].timestamp() - time.time()) + 0.5)
    assert "02" not in live(spark, tmp_path)
    time.sleep(max(0, second["01"].timestamp() - time.time()) + 0.5)
    assert live(spark, tmp_path) == {}
    # A key that expired starts anew, whatever its version was.
    add(spark, log, message(body(2, 5), offset=5, at=0))
    keep(spark, tmp_path, ttl)
    assert live(spark, tmp_path) == {"02": 5} and held(spark, tmp_path) == {"02"}
    assert spark.conf.get(EMPTY_BATCHES) == "true"


def test_entries_without_an_end(spark, tmp_path, on_disk):
    add(spark, str(tmp_path / "log"), message(body(1, 1), offset=0), message(body(1, 2), partition=1, offset=0))
    stream, before = stream_message_log(spark, str(tmp_path / "log")), spark.conf.get("spark.sql.shuffle.partitions")
    start_state_cache(stream, str(tmp_path / "c"), None, available_now=True, partitions=3).awaitTermination()
    assert len([p for p in (tmp_path / "c" / "state" / "0").iterdir() if p.name.isdigit()]) == 3
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    (row,) = live_entries(spark, str(tmp_path / "c")).collect()
    assert row.expires_at is None and row.ver.partition == 1 and row.db == 1
    with pytest.raises(ValueError):
        start_state_cache(stream_message_log(spark, str(tmp_path / "log")), str(tmp_path / "x"), 0)


def arrive(spark, tmp_path, table):
    stream = stream_message_log(spark, str(tmp_path / "log"), 1)
    start_first_arrivals(stream, table, str(tmp_path / "c"), ["v.a"], available_now=True).awaitTermination()


def test_first_arrival_wins_whatever_the_event_order(spark, tmp_path):
    log, table = str(tmp_path / "log"), ParquetTable(spark, str(tmp_path / "t"))
    # The first file has the later messages; within it the lower partition, then the lower offset counts.
    add(spark, log, message(body(1, 10), partition=1, offset=0, at=50), message(body(1, 11), partition=0, offset=9, at=60),
        message(body(1, 12), partition=0, offset=10, at=40), message("ping", offset=11))
    add(spark, log, message(body(1, 20), offset=1, at=1), message(body(2, 21), offset=2, at=2))
    arrive(spark, tmp_path, table)
    assert {r.time % 60: r["v.a"] for r in table.view().collect()} == {1: 11, 2: 21}
    # The state is there after a restart: nothing that is shown is replaced, or stored again.
    add(spark, log, message(body(1, 30), offset=3, at=0), message(body(2, 31), offset=4, at=0), message(body(3, 32), offset=5, at=0))
    arrive(spark, tmp_path, table)
    assert {r.time % 60: r["v.a"] for r in table.view().collect()} == {1: 11, 2: 21, 3: 32}
    assert table._store().read().count() == 3


def test_first_arrival_keeps_the_tables_columns(spark, tmp_path):
    table = ParquetTable(spark, str(tmp_path / "t"))
    add(spark, str(tmp_path / "log"), message(json.dumps({"time": "2024-01-01 00:00:01", "v.a": 1, "other": 2})))
    arrive(spark, tmp_path, table)
    assert table.view().columns == ["time", "v.a"] and table.view().count() == 1
