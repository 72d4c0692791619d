"""Message logs derived from the ``events`` table, one message per event.

Event ``e`` becomes offset ``e div 4`` of partition ``e % 4`` of one topic, so that a
result can name its event again (``event_id``). Times are UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagstream.constants import CHECK_MESSAGE
from tagstream.session import configure

TOPIC = "readings"
PARTITIONS = 4

# Characters of the timestamp text to keep, and what completes it.
GRAINS = {"second": (19, ""), "minute": (16, ":00"), "hour": (13, ":00:00"), "day": (10, "")}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/events.parquet")


def time_text(grain: str) -> Column:
    length, rest = GRAINS[grain]
    return F.concat(F.substring(F.col("ts").cast("string"), 1, length), F.lit(rest))


def as_messages(events: DataFrame, body: Column) -> DataFrame:
    """The columns of the Kafka source."""
    return events.select(
        F.lit(None).cast("binary").alias("key"),
        body.cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        (F.col("event_id") % PARTITIONS).cast("int").alias("partition"),
        F.expr(f"event_id div {PARTITIONS}").alias("offset"),
        F.concat(F.col("ts").cast("string"), F.lit(" UTC")).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def event_id() -> Column:
    return (F.col("offset") * PARTITIONS + F.col("partition")).alias("event_id")


def dense_log(spark: SparkSession, sf_dir: str, grain: str = "hour") -> DataFrame:
    """Every event as a reading of two tags; a coarse grain puts many on one second."""
    return as_messages(events(spark, sf_dir), _two_tags(time_text(grain)))


def user_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings at their own second, with a third tag."""
    return as_messages(
        events(spark, sf_dir), _two_tags(time_text("second"), F.col("user_id").alias("USER.AV"))
    )


def rolled_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times written with a month past December and a short day: only lenient parsing reads them."""
    wall = F.col("ts").cast("string")
    text = F.concat_ws(
        "",
        (F.year("ts") - 1).cast("string"), F.lit("-"),
        (F.month("ts") + 12).cast("string"), F.lit("-"),
        F.dayofmonth("ts").cast("string"),
        F.substring(wall, 11, 9), F.lit(" +"),
    )
    return as_messages(events(spark, sf_dir), _two_tags(text))


def long_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times written as midnight and the seconds of the day, up to five digits of them."""
    seconds = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    text = F.concat(time_text("day"), F.lit(" 00:00:"), seconds.cast("string"))
    return as_messages(events(spark, sf_dir), _two_tags(text))


def mixed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events carry another tag than the rest; some bodies are no JSON at all."""
    time = time_text("second").alias("time")
    body = (
        F.when(F.col("event_type") == "error", F.to_json(F.struct(time, F.col("value").alias("ERR.AV"))))
        .when(F.col("event_id") % 97 == 0, F.lit(CHECK_MESSAGE))
        .otherwise(F.to_json(F.struct(time, F.col("value").alias("VALUE.AV"))))
    )
    return as_messages(events(spark, sf_dir), body)


def _two_tags(text: Column, *more: Column) -> Column:
    k = F.get_json_object("props", "$.k").cast("int")
    return F.to_json(
        F.struct(text.alias("time"), F.col("value").alias("VALUE.AV"), k.alias("K.AV"), *more)
    )
