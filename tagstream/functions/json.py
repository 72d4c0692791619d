"""JSON bodies as VARIANT: parse once, then read fields, iterate or serialise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagstream.constants import TIME_FIELD
from tagstream.functions.plan import quoted

TAG_MAP = "map<string,variant>"


def parse_body(text: Column) -> Column:
    """JSON text as VARIANT, NULL where it is not JSON."""
    return F.try_parse_json(text)


def tag_map(body: Column) -> Column:
    """The object's fields as a map; NULL where the body is not an object."""
    return F.try_variant_get(body, "$", TAG_MAP)


def get_tag(body: Column, tag: str, data_type: str) -> Column:
    """One field by its exact name (names may hold dots), NULL if absent or not castable."""
    for quote in ("'", '"'):
        if tag and quote not in tag:
            return F.try_variant_get(body, f"$[{quote}{tag}{quote}]", data_type)
    # A name the path syntax cannot spell.
    return F.try_variant_get(F.try_element_at(tag_map(body), F.lit(tag)), "$", data_type)


def get_tags(body: Column, tags: list[str], data_type: str) -> Column:
    """Several fields as one struct, NULL where absent or not castable.

    One cast of the object; for wide readings much cheaper than reading tag by tag.
    """
    fields = ", ".join(f"{quoted(t)}: {data_type}" for t in tags)
    return F.try_variant_get(body, "$", f"struct<{fields}>")


def tag_names(body: Column) -> Column:
    """Field names, sorted."""
    return F.map_keys(tag_map(body))


def present_tags(body: Column) -> Column:
    """Fields other than the time whose value is not JSON null."""
    return F.map_filter(
        tag_map(body), lambda name, value: (name != TIME_FIELD) & ~F.is_variant_null(value)
    )


def body_with_epoch(body: Column, epoch: Column) -> Column:
    """The body as JSON text with the time field replaced and null fields left out."""
    epoch_entry = F.create_map(F.lit(TIME_FIELD), epoch.cast("variant"))
    return F.to_json(F.map_concat(present_tags(body), epoch_entry))
