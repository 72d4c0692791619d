import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tagstream.operators.offsets import (
    commit_offsets,
    newest_positions,
    offset_ranges,
    resume,
    start_latest,
)
from tagstream.sinks.offset_log import OffsetLog, ranges_from_progress
from tagstream.sinks.producer import producer_records
from tagstream.sources.kafka import kafka_options, start_options
from tagstream.sources.message_log import stream_message_log
from tagstream.streaming.report import OffsetListener
from tests.messages import frame, message

POSITION = "group string, topic string, partition int, next_offset bigint"


@pytest.fixture(scope="module")
def log(spark):
    return frame(spark, [
        message("x", partition=p, offset=o, topic=t) for t in ("a", "b") for p in range(4) for o in range(10)
    ])


def offsets(df):
    return {(r.topic, r.partition, r.offset) for r in df.collect()}


KNOWN = [("g", "a", 0, 3), ("g", "a", 1, 10), ("g", "a", 2, 0), ("g", "b", 0, 7), ("g", "c", 0, 1)]
# Another group, and an earlier commit of the same one.
MORE = [("h", "a", 0, 7), ("h", "a", 3, 9), ("g", "a", 1, 4)]


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("group", ["g", "h"])
def test_resume(spark, log, group, strict):
    positions = spark.createDataFrame(KNOWN + MORE, POSITION)
    known = {(t, p): n for g, t, p, n in MORE + KNOWN if g == group}
    want = {
        (t, p, o) for t, p, o in offsets(log)
        if ((t, p) in known or not strict) and o >= known.get((t, p), 0)
    }
    rest = resume(log, positions, group, strict=strict)
    assert offsets(rest) == want and rest.columns == log.columns and rest.count() == len(want)


def test_no_positions(spark, log):
    stored = spark.createDataFrame(KNOWN, POSITION)
    assert resume(log, stored, "other").count() == log.count()
    assert resume(log, stored, "other", strict=True).count() == 0


def test_nothing_runs_while_the_query_is_built(spark, log):
    failing = spark.createDataFrame(KNOWN, POSITION).filter(F.raise_error(F.lit("ran")).isNull())
    resume(log, failing, "g")


def test_resume_a_stream(spark, log, tmp_path):
    log.write.parquet(str(tmp_path / "log"))
    known = spark.createDataFrame(KNOWN + MORE, POSITION)
    rest = resume(stream_message_log(spark, str(tmp_path / "log")), known, "g")
    got = []
    query = rest.writeStream.foreachBatch(lambda df, _: got.extend(offsets(df)))
    query.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert set(got) == offsets(resume(log, known, "g"))


def test_start_options_from_stored_positions(spark):
    stored = spark.createDataFrame(KNOWN + MORE, POSITION)
    known = start_options(stored, "g", "h:1", "a")
    assert json.loads(known["assign"]) == {"a": [0, 1, 2]}
    assert json.loads(known["startingOffsets"]) == {"a": {"0": 3, "1": 10, "2": 0}}
    every = start_options(stored, "h", "h:1", "a", partitions=range(4), more={"failOnDataLoss": "false"})
    assert every["subscribe"] == "a" and every["failOnDataLoss"] == "false"
    assert json.loads(every["startingOffsets"]) == {"a": {"0": 7, "1": -2, "2": -2, "3": 9}}
    assert start_options(stored, "new", "h:1", "a")["startingOffsets"] == "latest"


def test_start_at_latest(log):
    before = log.filter("topic = 'a' and offset < 6 and partition < 3")
    want = {(t, p, o) for t, p, o in offsets(log) if t == "b" or p == 3 or o >= 6}
    assert offsets(start_latest(log, before)) == want


def test_ranges_commit_and_log(spark, log, tmp_path):
    topic = log.filter("topic = 'a'")
    audit = OffsetLog(spark, str(tmp_path / "offsets"), "g")
    assert audit.positions().count() == 0
    audit.append(offset_ranges(topic.filter("offset < 4")), 0)
    audit.append(offset_ranges(topic.filter("offset between 4 and 8 and partition < 2")), 1)
    audit.append(offset_ranges(topic.filter("offset between 4 and 8 and partition < 2")), 1)
    assert {(r.group, r.topic, r.partition, r.next_offset) for r in audit.positions().collect()} == {
        ("g", "a", 0, 9), ("g", "a", 1, 9), ("g", "a", 2, 4), ("g", "a", 3, 4)}
    assert audit.ranges().count() == 6 and audit.positions().count() == 4
    ranges = audit.ranges().filter("batch_id = 1 and partition = 0").first()
    assert (ranges.from_offset, ranges.until_offset, ranges.n) == (4, 9, 5)
    assert offsets(resume(topic, audit.positions(), "g", strict=True)) == offsets(
        topic.filter("offset >= if(partition < 2, 9, 4)"))
    assert newest_positions(topic).filter("next_offset = 10").count() == 4
    assert commit_offsets(offset_ranges(topic, "key"), "g").count() == 4


def test_ranges_from_kafka_progress(spark, tmp_path):
    audit = OffsetLog(spark, str(tmp_path / "offsets"), "g")
    listener = OffsetListener(spark, audit, "job")

    def progress(name, rows, batch, start, end):
        source = SimpleNamespace(startOffset=start and json.dumps(start), endOffset=json.dumps(end))
        return SimpleNamespace(progress=SimpleNamespace(
            name=name, numInputRows=rows, batchId=batch, sources=[source]))

    listener.onQueryProgress(progress("job", 5, 0, None, {"t": {"0": 5}}))
    listener.onQueryProgress(progress("job", 4, 1, {"t": {"0": 5}}, {"t": {"0": 8, "1": 1}}))
    listener.onQueryProgress(progress("job", 0, 1, {"t": {"0": 8}}, {"t": {"0": 8, "1": 1}}))
    listener.onQueryProgress(progress("other", 9, 2, None, {"t": {"0": 99}}))
    assert {(r.partition, r.next_offset) for r in audit.positions().collect()} == {(0, 8), (1, 1)}
    assert {(r.batch_id, r.partition, r.n) for r in audit.ranges().collect()} == {
        (0, 0, None), (1, 0, 3), (1, 1, None)}
    assert ranges_from_progress(spark, None, "{}").count() == 0


def test_kafka_options():
    fresh = kafka_options("h:9092", "t", max_offsets_per_trigger=1000, min_partitions=64)
    assert fresh == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "t", "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "1000", "minPartitions": "64"}
    positions = {"t": {0: 5, 2: 7}, "other": {0: 1}}
    resumed = kafka_options("h", "t", positions, partitions=range(4))
    assert resumed["subscribe"] == "t"
    assert json.loads(resumed["startingOffsets"]) == {"t": {"0": 5, "1": -2, "2": 7, "3": -2}}
    strict = kafka_options("h", "t", positions, partitions=range(4), strict=True)
    assert json.loads(strict["assign"]) == {"t": [0, 2]} and "subscribe" not in strict
    assert json.loads(strict["startingOffsets"]) == {"t": {"0": 5, "2": 7}}


def test_producer_records(spark):
    records = producer_records(spark.range(2), "t", F.concat(F.lit("text"), F.col("id")))
    assert [tuple(r) for r in records.collect()] == [(None, "text0", "t"), (None, "text1", "t")]
