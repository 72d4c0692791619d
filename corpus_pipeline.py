"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tagstream.llm.decontaminate import contained_items, without_items
from tagstream.llm.mixing import sampled
from tagstream.llm.quality import good_documents, learn_quality
from tagstream.llm.simhash import near_duplicates, one_of_each
from tagstream.llm.token_output import token_index, write_tokens
from tagstream.session import scratch_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    Null and empty texts get the labels' base rate, as ``good_documents`` says; without labels all stay.
    Repeated rows stay or go together, an empty table stays empty, very long texts are counted in blocks.
    """
    return good_documents(docs, learn_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest identifier of each group stays.

    Null and empty texts are one group. A row without an identifier stays only where no row of its group has
    one, and of rows that repeat identifier and text one stays. An empty table stays empty; of a very long
    text the shingles are hashed in blocks.
    """
    return one_of_each(docs, near_duplicates(docs))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Null and empty texts hold none and stay, as do all if there are no items. Repeated rows stay or go
    together, an empty table stays empty, a very long text is a row of arrays like any other.
    """
    return without_items(docs, contained_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of documents with damped shares of the large sources, languages and topics.

    Shares, topics and probabilities come from all documents. Null sources and languages are values of
    their own. Texts without words have no tokens and go. Rows that repeat identifier and text share their
    draw, an empty table stays empty, very long texts are looked at in blocks.
    """
    return sampled(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in ORC files; the rows are their index, read from the files.

    A null or empty text is the end id alone. Rows without an identifier come first, rows of one identifier
    by a hash of their text, repeated rows one after the other. An empty table gives no rows; a very long
    text is encoded alone.
    """
    path = scratch_dir(spark, "tokens")
    write_tokens(docs, path, public_tokenizers.path(TOKENIZER), END_ID)
    return token_index(spark, path)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("token_output", token_output),
]

# A trained classifier, XXH64 and byte-pair encoding are beyond SQL: tests hold the rows against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = scratch_dir(spark, "pipeline")
    for name, stage in STAGES:
        path = f"{root}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
