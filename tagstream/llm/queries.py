"""One query per operator, over its whole tables below ``sf_dir``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagstream.llm.collocations import collocations
from tagstream.llm.decontaminate import contained_items
from tagstream.llm.fill_in_middle import fill_in_middle, restored
from tagstream.llm.jaccard_join import similar_documents
from tagstream.llm.language_id import identify
from tagstream.llm.license_scan import PHRASE_SCORE, scan_licenses
from tagstream.llm.mixing import mix
from tagstream.llm.nearest import search
from tagstream.llm.quality import classify
from tagstream.llm.simhash import near_duplicates
from tagstream.llm.substring_dedup import remove_repeats
from tagstream.llm.token_counts import count_tokens
from tagstream.llm.token_output import token_index, write_tokens
from tagstream.session import scratch_dir

NEIGHBOURS = 20
IS_NEIGHBOUR_QUERY = "vec_id % 20 = 0"
TOKEN_LIMIT = 2048
END_ID = 2


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return remove_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(_table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("h"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = lambda labels: F.array_join(F.sort_array(labels), ",")
    base = F.array_distinct("places.label")
    best = F.coalesce(F.array_max("found.score"), F.lit(0.0))
    return scan_licenses(_table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min("places.start").alias("first_word"),
        F.array_max("places.start").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.array_union(base, F.col("found.label"))).alias("labels"),
        F.when(F.size("places") > 0, F.greatest(best, F.lit(PHRASE_SCORE))).otherwise(best).alias("score"),
    )


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "op8")
    write_tokens(
        _table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), END_ID
    )
    return token_index(spark, path)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_table(spark, sf_dir, "embeddings"), IS_NEIGHBOUR_QUERY, NEIGHBOURS)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = restored(F.col("output"), F.col("form"))
    return fill_in_middle(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(text, 256).alias("restored_sha256"),
    )


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(_table(spark, sf_dir, "documents")).drop("digest")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_decontaminate": op2_decontaminate,
    "op3_token_counts": op3_token_counts,
    "op4_language_id": op4_language_id,
    "op5_mixing": op5_mixing,
    "op6_simhash": op6_simhash,
    "op7_license_scan": op7_license_scan,
    "op8_token_output": op8_token_output,
    "op9_quality": op9_quality,
    "op10_nearest": op10_nearest,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_jaccard_join": op12_jaccard_join,
    "op13_collocations": op13_collocations,
}
