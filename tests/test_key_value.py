import json
import os
import sys
import types
import uuid

import pytest
from pyspark.sql import functions as F

from tagstream.sinks import key_value
from tagstream.sinks.key_value import KeyValueTarget, RedisWriterFactory, write_pipelined
from tests.test_keyed import ENTRY, entry


def file_writer(folder, fail_on=None):
    """Writers that append each chunk to a file of their own."""

    class Writer:
        def __init__(self, db):
            self.path = os.path.join(folder, f"{db}-{uuid.uuid4().hex}")

        def put(self, entries):
            if fail_on and any(k == fail_on for k, _, _ in entries):
                raise OSError("refused")
            with open(self.path, "a") as f:
                f.write(json.dumps(entries) + "\n")

        def close(self):
            with open(self.path, "a") as f:
                f.write("closed\n")

    return Writer


def files(folder):
    return {n: open(os.path.join(folder, n)).read().splitlines() for n in os.listdir(folder)}


def test_chunks_ttl_and_lazy_opening(spark, tmp_path):
    data = [entry(1, f"k{i}", 0, i, 600 if i % 2 else None) for i in range(25)]
    entries = spark.createDataFrame(data, ENTRY).repartition(1).union(
        spark.createDataFrame([], ENTRY)
    )
    assert write_pipelined(entries, file_writer(str(tmp_path)), chunk_rows=10) == 25
    (lines,) = files(tmp_path).values()
    assert lines[-1] == "closed"
    chunks = [json.loads(line) for line in lines[:-1]]
    assert [len(c) for c in chunks] == [10, 10, 5]
    assert {k: ttl for c in chunks for k, _, ttl in c} == {f"k{i}": 600 if i % 2 else None for i in range(25)}


def test_one_writer_per_namespace(spark, tmp_path):
    data = [entry(i % 2, f"k{i}", 0, i, 1) for i in range(6)]
    KeyValueTarget(file_writer(str(tmp_path))).write(spark.createDataFrame(data, ENTRY).coalesce(1), 0)
    assert sorted(n.split("-")[0] for n in files(tmp_path)) == ["0", "1"]


def test_nothing_to_write_opens_nothing(spark, tmp_path):
    assert write_pipelined(spark.createDataFrame([], ENTRY), file_writer(str(tmp_path))) == 0
    assert files(tmp_path) == {}


def test_failing_writer_is_closed_and_fails_the_batch(spark, tmp_path):
    entries = spark.createDataFrame([entry(1, "bad", 0, 1, 1)], ENTRY).withColumn("x", F.lit(1)).drop("x")
    with pytest.raises(Exception, match="refused"):
        write_pipelined(entries, file_writer(str(tmp_path), "bad"))
    assert ["closed"] in files(tmp_path).values()


def test_redis_writer_sets_value_and_expiry_in_one_command(monkeypatch):
    sent = []

    class Pipeline:
        def __init__(self):
            self.commands = []

        def set(self, key, value, ex=None):
            self.commands.append((key, value, ex))

        def execute(self):
            sent.append(self.commands)

    class Client:
        def __init__(self, connection_pool):
            self.pool = connection_pool

        def pipeline(self, transaction):
            assert transaction is False
            return Pipeline()

        def close(self):
            sent.append("closed")

    pools = []
    fake = types.ModuleType("redis")
    fake.Redis = Client
    fake.ConnectionPool = lambda **options: pools.append(options) or options
    monkeypatch.setitem(sys.modules, "redis", fake)
    monkeypatch.setattr(key_value, "_pools", {})

    factory = RedisWriterFactory("h", 6399, timeout_ms=30_000)
    for _ in range(2):
        writer = factory(1)
        writer.put([("a", "1", 600), ("b", "2", None)])
        writer.close()
    assert sent == [[("a", "1", 600), ("b", "2", None)], "closed"] * 2
    assert pools == [{
        "host": "h", "port": 6399, "db": 1, "socket_timeout": 30.0, "socket_connect_timeout": 30.0,
        "max_connections": 2}]
