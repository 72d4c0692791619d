"""What the operators share: sizes, checkpoints, defined columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagstream.functions.plan import quoted
from tagstream.session import scratch_dir, ship_package

def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with files in the shared folder, so that a lost executor costs nothing."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(scratch_dir(spark, "checkpoints"))
    return df.checkpoint(eager=True)


def fitted(df: DataFrame, rows_per_partition: int = 100_000) -> DataFrame:
    """Checkpointed, in no more partitions than its rows need: what follows starts from these."""
    kept = checkpointed(df)
    return kept.coalesce(kept.count() // rows_per_partition + 1)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the identifier and the text, so that no other column can clash with ours."""
    ship_package(docs.sparkSession)
    return docs.select(
        F.col(quoted(doc_id)).cast("bigint").alias("doc_id"), F.col(quoted(text)).cast("string").alias("text")
    )


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts."""
    return docs.agg(F.sum(F.octet_length(F.col(quoted(text))))).first()[0] or 0


def remainder(doc_id: Column, modulus: int) -> Column:
    """CRC-32 of the identifier as text, modulo; NULL for a null identifier."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def unused_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
