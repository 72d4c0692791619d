"""One query per operator; each reads whole tables below ``sf_dir``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagstream.constants import CACHE_PREFIX, LEGACY_CACHE_PREFIX
from tagstream.functions.json import get_tag, parse_body
from tagstream.functions.number import clamped, rounded
from tagstream.functions.plan import each_column
from tagstream.operators.keyed import current, first_write_wins, insert_ignore, version, with_expiry
from tagstream.operators.messages import (
    cache_key,
    latest_entries,
    latest_messages,
    message_entries,
    parse_readings,
    project_messages,
    quarantined,
    reading_entries,
    rewrite_time,
    usable,
)
from tagstream.operators.offsets import commit_offsets, offset_ranges, resume, start_latest
from tagstream.operators.report import batch_report as report_by
from tagstream.operators.tableschema import conform, infer_table_columns, rejected_tags
from tagstream.plans import logs
from tagstream.plans.logs import dense_log, event_id, long_log, mixed_log, rolled_log, user_log
from tagstream.session import scratch_dir
from tagstream.sinks.cache_store import KEY, CacheStore
from tagstream.sinks.pipelined import EntryFiles, start_pipelined
from tagstream.sinks.producer import producer_records as to_records
from tagstream.sinks.table import ParquetTable
from tagstream.sources.log_stream import resume_stored_stream, stream_stored_log
from tagstream.sources.message_log import (
    resume_stored_log,
    stream_message_log,
    write_message_log,
)
from tagstream.streaming.arrival import start_first_arrivals
from tagstream.streaming.expiry import live_entries, start_state_cache, use_state_on_disk
from tagstream.streaming.jobs import DISCARD, CacheJob, TableJob, quarantine_store

MIDDLE = datetime(2024, 1, 15, tzinfo=timezone.utc)
AFTER = datetime(2024, 2, 1, tzinfo=timezone.utc)
VALUE = "VALUE.AV"
DAY_SECONDS = 86_400
# Messages per file of a streamed log.
FILE_MESSAGES = 25_000
# In which part of a log a message arrives.
ARRIVAL = "(offset * 4 + partition) * 7 div 3"


def _tag(name: str, alias: str, data_type: str = "double"):
    return get_tag(F.col("body"), name, data_type).alias(alias)


def _stored_tag(name: str, alias: str):
    return get_tag(parse_body(F.col("value")), name, "double").alias(alias)


def message_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    body_time = get_tag(parse_body(F.col("value")), "time", "string")
    return project_messages(dense_log(spark, sf_dir)).select(
        "topic", F.col("partition").alias("part"), F.col("offset").alias("off"),
        body_time.alias("body_time"),
    )


def message_handler(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of the caller's own, computed from the message."""
    messages = project_messages(
        user_log(spark, sf_dir),
        handler=lambda _: [F.concat_ws("/", "topic", "partition", "offset").alias("place")],
    )
    return messages.select(event_id(), "place")


def parsed_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usable(parse_readings(user_log(spark, sf_dir))).select(
        event_id(), "time", _tag(VALUE, "val"), _tag("K.AV", "k", "bigint")
    )


def event_epoch_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_readings(dense_log(spark, sf_dir)).select(event_id(), "time")


def event_epoch_seconds_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_readings(dense_log(spark, sf_dir), zone="Asia/Shanghai").select(event_id(), "time")


def event_epoch_seconds_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_readings(rolled_log(spark, sf_dir), lenient=True).select(event_id(), "time")


def event_epoch_seconds_long_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_readings(long_log(spark, sf_dir), lenient=True).select(event_id(), "time")


def latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = latest_entries(usable(parse_readings(dense_log(spark, sf_dir))), AFTER)
    return entries.select("key", _stored_tag(VALUE, "val"))


def latest_by_packed_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with bodies fetched for the winners only."""
    winners = usable(parse_readings(latest_messages(dense_log(spark, sf_dir))))
    return winners.select(cache_key(F.col("time")).alias("key"), _tag(VALUE, "val"))


def rewrite_time_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rewritten text, read again and taken apart."""
    rewritten = rewrite_time(usable(parse_readings(dense_log(spark, sf_dir)))).select(
        event_id(), parse_body(F.col("value")).alias("body")
    )
    numbers = F.try_variant_get("body", "$", "map<string,double>")
    return rewritten.select("event_id", F.explode(numbers).alias("key", "value"))


def tag_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = usable(parse_readings(dense_log(spark, sf_dir))).withColumn("event_id", event_id())
    return reading_entries(readings, "event_id").select(
        "event_id", F.col("tag").alias("key"), F.col("number").alias("value")
    )


def quarantine_bad_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantined(parse_readings(mixed_log(spark, sf_dir))).select(
        event_id(), "value", "reason"
    )


def cache_key_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usable(parse_readings(dense_log(spark, sf_dir))).select(
        event_id(),
        cache_key(F.col("time"), CACHE_PREFIX).alias("key"),
        cache_key(F.col("time"), LEGACY_CACHE_PREFIX).alias("legacy_key"),
    )


def live_keys_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written at their own time, alive for a day: what is there in the middle of the month."""
    readings = usable(parse_readings(dense_log(spark, sf_dir)))
    writes = with_expiry(
        readings.select("time", "body", version().alias("ver")),
        F.timestamp_seconds("time"),
        DAY_SECONDS,
    )
    return current(writes, ["time"], MIDDLE).select("time", _tag(VALUE, "val"))


def live_keys_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written up to four days late, so that older readings often arrive after newer ones."""
    readings = usable(parse_readings(user_log(spark, sf_dir)))
    late = (event_id() * 37 % 5) * DAY_SECONDS
    writes = with_expiry(
        readings.select(_tag("K.AV", "k", "bigint"), "body", version().alias("ver"), (F.col("time") + late).alias("at")),
        F.timestamp_seconds("at"),
        DAY_SECONDS,
    )
    return current(writes, ["k"], MIDDLE).select(
        "k", _tag(VALUE, "val"), F.unix_seconds("expires_at").alias("expires_s")
    )


def latest_by_namespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = usable(parse_readings(dense_log(spark, sf_dir)))
    return latest_entries(readings, AFTER, db="partition").select(
        "db", "key", _stored_tag(VALUE, "val")
    )


def latest_by_extra_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A further key part keeps devices that report in the same second apart."""
    readings = usable(parse_readings(dense_log(spark, sf_dir)))
    readings = readings.withColumn("device", get_tag(F.col("body"), "K.AV", "bigint"))
    return latest_entries(readings, AFTER, key_columns=("device",)).select(
        "key", _stored_tag(VALUE, "val")
    )


def _first_rows(log: DataFrame) -> DataFrame:
    rows = conform(usable(parse_readings(log)), [VALUE])
    return first_write_wins(rows, ["time"], F.col("ver"))


def _value_column():
    return F.col(f"tags.`{VALUE}`")


def first_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _first_rows(dense_log(spark, sf_dir)).select("time", _value_column().alias("val"))


def insert_ignore_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First reading per minute, for the minutes without a purchase (the table's rows)."""
    stored = logs.events(spark, sf_dir).filter(F.col("event_type") == "purchase")
    table = parse_readings(logs.as_messages(stored, F.to_json(F.struct(logs.time_text("minute").alias("time")))))
    new = insert_ignore(
        _first_rows(dense_log(spark, sf_dir, "minute")), usable(table).select("time").distinct(), ["time"]
    )
    return new.select("time", _value_column().alias("val"))


def infer_columns_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infer_table_columns(usable(parse_readings(mixed_log(spark, sf_dir))), "first")


def infer_columns_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infer_table_columns(usable(parse_readings(mixed_log(spark, sf_dir))), "union")


def conform_double_10_3(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = logs.events(spark, sf_dir).selectExpr(
        "event_id", "value / 7 AS rounded", "value * 100000 - 10000000 AS clamped"
    )
    columns = ["rounded", "clamped"]
    return each_column(each_column(numbers, columns, clamped), columns, rounded)


def conform_to_table_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conform(usable(parse_readings(mixed_log(spark, sf_dir))), [VALUE])
    return rows.select(
        (F.col("ver.offset") * logs.PARTITIONS + F.col("ver.partition")).alias("event_id"),
        "time",
        _value_column().alias("value_av"),
        "n_rejected",
    )


def reject_unknown_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = rejected_tags(usable(parse_readings(mixed_log(spark, sf_dir))), [VALUE])
    return rejects.select(event_id(), "tag", F.col("value").cast("double").alias("value"), "reason")


def batch_offset_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offset_ranges(_days(spark, sf_dir), "batch").select(
        "batch", F.col("partition").alias("part"), "from_offset", "until_offset", "n"
    )


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log in daily batches."""
    return dense_log(spark, sf_dir).withColumn("batch", F.expr(f"unix_seconds(timestamp) div {DAY_SECONDS}"))


def committed_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return commit_offsets(offset_ranges(_days(spark, sf_dir), "batch"), "cache").select(
        "group", F.col("partition").alias("part"), "next_offset"
    )


def _positions_at_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Committed in the middle of the month, before the last partition was added."""
    log = dense_log(spark, sf_dir)
    done = log.filter(
        (F.col("timestamp") < F.timestamp_seconds(F.lit(int(MIDDLE.timestamp()))))
        & (F.col("partition") < logs.PARTITIONS - 1)
    )
    return commit_offsets(offset_ranges(done), "cache")


def _resume(spark: SparkSession, sf_dir: str, **kwargs) -> DataFrame:
    rest = resume(dense_log(spark, sf_dir), _positions_at_middle(spark, sf_dir), "cache", **kwargs)
    return rest.select(F.col("partition").alias("part"), F.col("offset").alias("off"))


def resume_from_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resume(spark, sf_dir)


def resume_from_offsets_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resume(spark, sf_dir, strict=True)


def resume_from_offsets_two_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each group goes on where it stopped itself: the table's job stopped a week after the cache's."""
    log = dense_log(spark, sf_dir)
    later = F.timestamp_seconds(F.lit(int((MIDDLE + timedelta(days=7)).timestamp())))
    ahead = commit_offsets(offset_ranges(log.filter(F.col("timestamp") < later)), "table")
    stored = _positions_at_middle(spark, sf_dir).unionByName(ahead)
    rests = [resume(log, stored, group).withColumn("group", F.lit(group)) for group in ("cache", "table")]
    return rests[0].unionByName(rests[1]).select(
        "group", F.col("partition").alias("part"), F.col("offset").alias("off")
    )


def start_at_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = dense_log(spark, sf_dir)
    before = log.filter(F.col("timestamp") < F.timestamp_seconds(F.lit(int(MIDDLE.timestamp()))))
    return start_latest(log, before).select(
        F.col("partition").alias("part"), F.col("offset").alias("off")
    )


def _before_middle():
    return F.col("timestamp") < F.timestamp_seconds(F.lit(int(MIDDLE.timestamp())))


def _place(messages: DataFrame) -> DataFrame:
    return messages.select(F.col("partition").alias("part"), F.col("offset").alias("off"))


def _stored_log(spark: SparkSession, sf_dir: str, path: str) -> None:
    write_message_log(dense_log(spark, sf_dir), path, max(8, logs.events(spark, sf_dir).count() // FILE_MESSAGES))


def resume_pruned_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rest of a stored log; files before the positions are not read."""
    path = f"{scratch_dir(spark, 'resume_pruned_log')}/log"
    _stored_log(spark, sf_dir, path)
    return _place(resume_stored_log(spark, path, _positions_at_middle(spark, sf_dir), "cache"))


def _streamed_places(stream: DataFrame, root: str) -> None:
    """Run a stream over all there is, writing where its messages stood."""
    writer = _place(stream).writeStream.format("parquet").option("path", f"{root}/out")
    query = writer.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()


def stream_resume_from_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that starts at stored positions."""
    root = scratch_dir(spark, "stream_resume_from_offsets")
    _stored_log(spark, sf_dir, f"{root}/log")
    stream = resume_stored_stream(spark, f"{root}/log", _positions_at_middle(spark, sf_dir), "cache")
    _streamed_places(stream, root)
    return spark.read.schema("part INT, off BIGINT").parquet(f"{root}/out")


def stream_start_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream without positions: started on half a log, it reads what arrives after that, also after a restart."""
    root = scratch_dir(spark, "stream_start_latest")
    log = dense_log(spark, sf_dir)
    write_message_log(log.filter(_before_middle()), f"{root}/log", 4)
    _streamed_places(stream_stored_log(spark, f"{root}/log"), root)
    write_message_log(log.filter(~_before_middle()), f"{root}/log", 4)
    _streamed_places(stream_stored_log(spark, f"{root}/log"), root)
    return spark.read.schema("part INT, off BIGINT").parquet(f"{root}/out")


def stream_pipelined_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading written by the tasks of the stream; the files of committed batches are read."""
    root = scratch_dir(spark, "stream_pipelined_write")
    entries = message_entries(usable(parse_readings(_log_stream(spark, sf_dir, root))), AFTER)
    target = EntryFiles(f"{root}/entries")
    start_pipelined(entries, target, f"{root}/checkpoint", available_now=True).awaitTermination()
    return current(target.read(spark), KEY, AFTER).select("key", _stored_tag(VALUE, "val"))


def _log_stream(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """The log as files of the message schema, streamed in about four batches."""
    files = max(4, logs.events(spark, sf_dir).count() // FILE_MESSAGES)
    return _stream_of(spark, dense_log(spark, sf_dir), f"{root}/log", files)


def _stream_of(spark: SparkSession, log: DataFrame, path: str, files: int) -> DataFrame:
    log.repartitionByRange(files, "timestamp", "partition", "offset").write.parquet(path)
    return stream_message_log(spark, path, max_files_per_trigger=-(-files // 4))


def stream_latest_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "stream_latest_store")
    store = CacheStore(spark, f"{root}/cache")
    job = CacheJob(
        spark=spark, checkpoint=f"{root}/checkpoint", target=store, quarantine=DISCARD, clock=lambda: AFTER
    )
    job.start(_log_stream(spark, sf_dir, root), available_now=True).awaitTermination()
    return store.view(AFTER).select("key", _stored_tag(VALUE, "val"))


def stream_latest_by_extra_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "stream_latest_by_extra_key")
    store = CacheStore(spark, f"{root}/cache")
    job = CacheJob(
        spark=spark, checkpoint=f"{root}/checkpoint", target=store, quarantine=DISCARD, clock=lambda: AFTER,
        key_columns={"device": get_tag(F.col("body"), "K.AV", "bigint")},
    )
    job.start(_log_stream(spark, sf_dir, root), available_now=True).awaitTermination()
    return store.view(AFTER).select("key", _stored_tag(VALUE, "val"))


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the cache job set aside, read from its store."""
    root = scratch_dir(spark, "stream_quarantine")
    bad = quarantine_store(spark, f"{root}/bad")
    job = CacheJob(
        spark=spark, checkpoint=f"{root}/checkpoint", target=CacheStore(spark, f"{root}/cache"), quarantine=bad
    )
    files = max(4, logs.events(spark, sf_dir).count() // FILE_MESSAGES)
    stream = _stream_of(spark, mixed_log(spark, sf_dir), f"{root}/log", files)
    job.start(stream, available_now=True).awaitTermination()
    return bad.read().select(event_id(), "value", "reason")


def stream_insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "stream_insert_ignore")
    table = ParquetTable(spark, f"{root}/table")
    job = TableJob(
        spark=spark, checkpoint=f"{root}/checkpoint", target=table, quarantine=DISCARD, rejects=DISCARD
    )
    job.start(_log_stream(spark, sf_dir, root), available_now=True).awaitTermination()
    return table.view().select("time", F.col(f"`{VALUE}`").alias("val"))


def _arriving_in_parts(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """The log in four parts that each hold messages of the whole time, streamed one after the other."""
    log = dense_log(spark, sf_dir).withColumn("part_of_log", F.expr(f"({ARRIVAL}) % 4"))
    files = max(1, logs.events(spark, sf_dir).count() // (4 * FILE_MESSAGES))
    for part in range(4):
        rows = log.filter(F.col("part_of_log") == part).drop("part_of_log")
        rows.repartition(files, "offset").write.mode("append").parquet(path)
    return stream_message_log(spark, path, files)


def stream_first_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table job that looks stored rows up: a key's row is of the first part that has the key."""
    root = scratch_dir(spark, "stream_first_batch")
    table = ParquetTable(spark, f"{root}/table", keep="arrival")
    job = TableJob(spark=spark, checkpoint=f"{root}/checkpoint", target=table, quarantine=DISCARD, rejects=DISCARD)
    job.start(_arriving_in_parts(spark, sf_dir, f"{root}/log"), available_now=True).awaitTermination()
    return table.view().select("time", F.col(f"`{VALUE}`").alias("val"))


def stream_first_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What came first stays, by the stream's state: of the first part, the lowest partition and offset."""
    root = scratch_dir(spark, "stream_first_arrival")
    table = ParquetTable(spark, f"{root}/table")
    stream = _arriving_in_parts(spark, sf_dir, f"{root}/log")
    start_first_arrivals(stream, table, f"{root}/checkpoint", [VALUE], available_now=True).awaitTermination()
    return table.view().select("time", F.col(f"`{VALUE}`").alias("val"))


def stream_live_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last reading per key in the state store, where each lives for a month after it was written."""
    root = scratch_dir(spark, "stream_live_keys")
    use_state_on_disk(spark)
    start_state_cache(
        _log_stream(spark, sf_dir, root), f"{root}/checkpoint", 30 * DAY_SECONDS, available_now=True, partitions=4
    ).awaitTermination()
    return live_entries(spark, f"{root}/checkpoint").select("key", _stored_tag(VALUE, "val"))


def batch_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = parse_readings(
        mixed_log(spark, sf_dir),
        handler=lambda _: [F.expr(f"unix_seconds(timestamp) div {DAY_SECONDS}").alias("batch")],
    )
    return report_by(readings, "batch", at=F.max("timestamp"))


def producer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = dense_log(spark, sf_dir).select(F.col("value").cast("string").alias("value"))
    records = to_records(texts, "readings_out").withColumn("body", parse_body(F.col("value")))
    return records.select("key", "topic", _tag("time", "time", "string"), _tag(VALUE, "val"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "message_source": message_source,
    "message_handler": message_handler,
    "parse_readings": parsed_readings,
    "event_epoch_seconds": event_epoch_seconds,
    "event_epoch_seconds_zone": event_epoch_seconds_zone,
    "event_epoch_seconds_lenient": event_epoch_seconds_lenient,
    "event_epoch_seconds_long_fields": event_epoch_seconds_long_fields,
    "latest_by_key": latest_by_key,
    "latest_by_packed_version": latest_by_packed_version,
    "rewrite_time_field": rewrite_time_field,
    "reading_entries": tag_entries,
    "quarantine_bad_messages": quarantine_bad_messages,
    "cache_key_values": cache_key_values,
    "live_keys_ttl": live_keys_ttl,
    "live_keys_out_of_order": live_keys_out_of_order,
    "latest_by_namespace": latest_by_namespace,
    "latest_by_extra_key": latest_by_extra_key,
    "first_by_key": first_by_key,
    "insert_ignore_existing": insert_ignore_existing,
    "infer_table_columns": infer_columns_union,
    "infer_table_columns_first": infer_columns_first,
    "conform_double_10_3": conform_double_10_3,
    "conform_to_table_schema": conform_to_table_schema,
    "reject_unknown_tags": reject_unknown_tags,
    "offset_ranges": batch_offset_ranges,
    "commit_offsets": committed_offsets,
    "resume_from_offsets": resume_from_offsets,
    "resume_from_offsets_strict": resume_from_offsets_strict,
    # The name of a former variant; resuming is always a join now.
    "resume_by_join": resume_from_offsets,
    "resume_from_offsets_two_groups": resume_from_offsets_two_groups,
    "start_latest": start_at_latest,
    "resume_pruned_log": resume_pruned_log,
    "stream_resume_from_offsets": stream_resume_from_offsets,
    "stream_start_latest": stream_start_latest,
    "stream_pipelined_write": stream_pipelined_write,
    "stream_latest_store": stream_latest_store,
    "stream_latest_by_extra_key": stream_latest_by_extra_key,
    "stream_quarantine": stream_quarantine,
    "stream_insert_ignore": stream_insert_ignore,
    "stream_first_batch": stream_first_batch,
    "stream_first_arrival": stream_first_arrival,
    "stream_live_keys": stream_live_keys,
    "batch_report": batch_report,
    "producer_records": producer_records,
}
