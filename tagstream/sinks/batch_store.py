"""Parquet folder with a folder per batch, written by Spark and read as one table.

Writing a batch again replaces its folder, so a replayed batch changes nothing. Nothing is
folded or deleted in place: a copy that holds less is an ordinary read, reduction and write to
another path (``copied``), to which readers and the job move when it is complete.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = "_batch_id"
# The batch that a copy's rows belong to, which no stream writes again.
COPIED = -1


class BatchStore:
    """``schema`` lists the data columns; ``partition_by`` adds one ``name: type`` below the batches."""

    def __init__(
        self, spark: SparkSession, root: str, schema: str, partition_by: dict[str, str] | None = None
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.partition_by = dict(partition_by or {})
        if len(self.partition_by) > 1:
            raise ValueError("at most one partition column")
        self.data = schema
        layout = {**self.partition_by, BATCH: "BIGINT"}
        self.schema = ", ".join([schema] + [f"{n} {t}" for n, t in layout.items()])

    def write(self, rows: DataFrame, batch_id: int) -> None:
        if self.partition_by:
            # A folder's few rows become one file, those of a large one several.
            rows = rows.hint("rebalance", *self.partition_by)
        writer = rows.write.mode("overwrite")
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(f"{self.root}/{BATCH}={batch_id}")

    def read(self, parts: Iterable | None = None) -> DataFrame:
        """All rows, or those of the given values of the partition column, with ``_batch_id``.

        Of other values no folder is read.
        """
        try:
            rows = self.spark.read.schema(self.schema).parquet(self.root)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = self.spark.createDataFrame([], self.schema)
        if parts is None:
            return rows
        (column,) = self.partition_by
        return rows.filter(F.col(column).isin(list(parts)))

    def copied(self, root: str, reduce_rows: Callable[[DataFrame], DataFrame]) -> "BatchStore":
        """A store at ``root`` with the reduced rows of this one as its only batch."""
        copy = BatchStore(self.spark, root, self.data, self.partition_by)
        copy.write(reduce_rows(self.read().drop(BATCH)), COPIED)
        return copy
