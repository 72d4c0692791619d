"""Table columns learned from readings, and readings conformed to them."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagstream.constants import TIME_FIELD
from tagstream.functions import json as J
from tagstream.functions.number import clamped, rounded
from tagstream.functions.plan import quoted, with_column_once
from tagstream.operators.keyed import version
from tagstream.operators.messages import MODES

TIME_TYPE = "bigint"
NUMBER_TYPE = "double"


def tag_types(readings: DataFrame) -> dict[str, str]:
    """Every tag of the readings with the type of all its values: one reduction, merged on the map side.

    A tag with values of several kinds is a ``variant``, one that is always null ``void``. The time
    field is among them.
    """
    merged = readings.agg(F.schema_of_variant_agg("body")).first()[0]
    # Spark's own name for an object's type, outside of quoted names.
    struct = re.sub(r"(`(?:[^`]|``)*`)|\bOBJECT<", lambda m: m[1] or "STRUCT<", merged)
    found = T.StructType.fromDDL(f"body {struct}").fields[0].dataType
    return {f.name: f.dataType.simpleString() for f in found.fields} if isinstance(found, T.StructType) else {}


def infer_table_columns(readings: DataFrame, mode: str = "first") -> DataFrame:
    """``column_name, column_type`` from the first reading, or from the union of all.

    The union is the schema that all bodies merge to, so no reading is exploded and no set of
    names is shuffled. Column names are case-insensitive, as in SQL: of names that differ only in case
    the lowest is kept.
    """
    if mode not in ("first", "union"):
        raise ValueError("mode must be 'first' or 'union'")
    if mode == "union":
        return _columns(readings, tag_types(readings))
    names = J.tag_names(F.col("body")).alias("names")
    first = readings.select("body", version().alias("ver")).orderBy("ver").limit(1).select(names)
    tags = first.select(F.explode("names").alias("tag"))
    folded = F.lower("tag")
    return (
        tags.filter((folded != TIME_FIELD) | (F.col("tag") == TIME_FIELD))
        .groupBy(folded)
        .agg(F.min("tag").alias("column_name"))
        .select("column_name", _column_type(F.col("column_name")).alias("column_type"))
    )


def _columns(readings: DataFrame, tags: Iterable[str]) -> DataFrame:
    lowest: dict[str, str] = {}
    for tag in sorted(tags):
        if tag == TIME_FIELD or tag.lower() != TIME_FIELD:
            lowest.setdefault(tag.lower(), tag)
    rows = [(tag, TIME_TYPE if tag == TIME_FIELD else NUMBER_TYPE) for tag in lowest.values()]
    return readings.sparkSession.createDataFrame(rows, "column_name string, column_type string")


def _column_type(name: Column) -> Column:
    return F.when(name == TIME_FIELD, TIME_TYPE).otherwise(NUMBER_TYPE)


def table_schema(columns: DataFrame) -> T.StructType | None:
    """The learned columns as a schema, time first then by name; None if there are none."""
    rows = columns.collect()
    if not rows:
        return None
    tags = sorted(r["column_name"] for r in rows if r["column_name"] != TIME_FIELD)
    fields = [T.StructField(TIME_FIELD, T.LongType(), False)]
    return T.StructType(fields + [T.StructField(t, T.DoubleType()) for t in tags])


def conform(
    readings: DataFrame, tags: list[str], mode: str = "PERMISSIVE", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Usable readings as table rows: ``ver``, ``time``, the kept columns, ``tags``, ``n_rejected``.

    ``tags`` is a struct of the fixed tags, so that no tag can clash with another column; it is
    absent if there are none. An absent tag is NULL. A tag without a column, or a value that is
    no number, is counted as rejected (see ``rejected_tags``); FAILFAST raises instead.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    own = ["ver", "time", *keep]
    wide = readings.select(version().alias("ver"), "time", *keep, "body")
    stored, result = F.lit(0), []
    if tags:
        wide = with_column_once(wide, "tags", J.get_tags(F.col("body"), tags, "double"))
        wide = _each_tag(_each_tag(wide, tags, clamped), tags, rounded)
        stored = F.expr(f"size(array_compact(array({', '.join(f'tags.{quoted(t)}' for t in tags)})))")
        result = ["tags"]
    wide = wide.withColumn("n_tags", F.size(J.tag_map(F.col("body"))))
    # Looking for null tags one by one is needed only where something is missing.
    rejected = F.when(F.col("n_tags") - 1 == stored, 0).otherwise(
        F.size(J.present_tags(F.col("body"))) - stored
    )
    if mode == "FAILFAST":
        place = F.concat_ws(" ", F.col("ver.partition"), F.col("ver.offset"))
        failure = F.raise_error(F.concat(F.lit("tag without a numeric column: "), place))
        rejected = F.when(rejected > 0, failure.cast("int")).otherwise(rejected)
    return wide.withColumn("n_rejected", rejected).select(*own, *result, "n_rejected")


def _each_tag(df: DataFrame, tags: list[str], expression) -> DataFrame:
    """Every field of ``tags`` by an expression of itself, in a projection of its own."""
    fields = ", ".join(f"{expression(f'tags.{quoted(t)}')} AS {quoted(t)}" for t in tags)
    return df.selectExpr(*[f"struct({fields}) AS tags" if c == "tags" else quoted(c) for c in df.columns])


def rejected_tags(readings: DataFrame, tags: list[str]) -> DataFrame:
    """One row per tag ``conform`` could not store, with the reason."""
    entries = readings.select(
        "topic", "partition", "offset", "time",
        F.explode(J.tag_map(F.col("body"))).alias("tag", "_v"),
    ).filter(F.col("tag") != TIME_FIELD)
    entries = with_column_once(entries, "_number", F.try_variant_get("_v", "$", "double"))
    known = F.lit(False)
    if tags:
        names = ", ".join("'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'" for t in tags)
        known = F.expr(f"tag IN ({names})")
    reason = F.when(F.is_variant_null("_v"), F.lit(None)).when(~known, "unknown_column").when(
        F.expr(f"{clamped('_number')} IS NULL"), "non_numeric"
    )
    return (
        with_column_once(entries, "reason", reason)
        .filter(F.col("reason").isNotNull())
        .select("topic", "partition", "offset", "time", "tag", F.to_json("_v").alias("value"), "reason")
    )
