"""Counts per batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagstream.constants import TIME_PATTERN


def reading_counts() -> dict[str, Column]:
    bad = F.count_if(F.col("time").isNull())
    return {
        "n_in": F.count(F.lit(1)),
        "n_good": F.count("time"),
        "n_bad": bad,
    }


def batch_report(readings: DataFrame, *by: str, at: Column | None = None) -> DataFrame:
    """When (as text, now unless ``at`` says otherwise), and messages read, usable and set aside per group."""
    when = F.current_timestamp() if at is None else at
    counts = [c.alias(n) for n, c in reading_counts().items()]
    return readings.groupBy(*by).agg(F.date_format(when, TIME_PATTERN).alias("report_time"), *counts)
