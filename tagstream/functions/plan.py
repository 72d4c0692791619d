"""Plan-shaping helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_column_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed exactly once per row.

    The optimizer pushes a filter on a computed column below the projection and
    computes the column a second time there, which doubles the JSON parsing. It
    does not push through a generator, and exploding a one-element array stays
    within whole-stage codegen.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def quoted(name: str) -> str:
    """The column of exactly that name, dots included."""
    return "`" + name.replace("`", "``") + "`"


def each_column(df: DataFrame, names: list[str], expression: Callable[[str], str]) -> DataFrame:
    """Replace columns by an SQL expression of themselves, in a projection of its own."""
    changed = set(names)
    return df.selectExpr(
        *[
            f"{expression(quoted(c))} AS {quoted(c)}" if c in changed else quoted(c)
            for c in df.columns
        ]
    )
