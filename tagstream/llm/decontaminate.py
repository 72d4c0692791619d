"""Benchmark items contained in documents, by size-partitioned MinHash and an exact check.

An item counts as contained if at least 0.8 of its distinct five-word shingles stand in the
document. Documents are partitioned by size: one of n distinct shingles gets the smallest
power of two of at least n as its number of bins, and the least hash in each bin is its
signature, so that a long document does not drown a short item as it would in a signature of
fixed length. Items are signed for every number of bins at once: a hash that is least in its
bin stays least in every finer one, so one number per hash says from which class on it
belongs to the signature. Equal hashes make a candidate.

In a bin with one shingle on average a shared shingle is least with probability 0.63 or more;
an item of 24 shingles has at least 20 shared ones, and is missed with probability below
3e-9. Shorter items are looked up among all shingles of the documents, so none is missed.

An item of fewer words than a shingle is one shingle of all its words, as the SQL has it. A
document with as many words as a shingle or more has no such shingle, so a document contains
such an item only if it consists of it; inside a longer document the item does not count.

DataFrame functions only. Candidates are verified on the shingles' texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagstream.functions.plan import quoted, with_column_once
from tagstream.llm.runtime import checkpointed, documents, unused_name

SHINGLE = 5
CONTAINMENT = 0.8
SHORT_ITEM = 24
# The items' signatures are broadcast up to this many hashes (24 bytes each), else joined by a shuffle.
MAX_BROADCAST_HASHES = 1_000_000
# Documents that share a hash with an item, 24 bytes each: up to so many are broadcast to their texts.
MAX_BROADCAST_CANDIDATES = 1_000_000
BLANKS = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Lower-cased words; none for a null text."""
    split = F.split(F.lower(F.coalesce(text, F.lit(""))), BLANKS)
    return F.filter(split, lambda w: w != "")


def _runs(words: str, size: int, make, whole: Column) -> Column:
    """``make`` of each run of ``size`` words; ``whole`` if they are fewer; nothing if there are none."""
    n = F.size(words)
    runs = F.transform(F.sequence(F.lit(0), F.greatest(n - size, F.lit(0))), make)
    return F.array_distinct(F.when(n >= size, runs).otherwise(F.filter(F.array(whole), lambda _: n > 0)))


def shingle_hashes(df: DataFrame, name: str, text: str, size: int) -> DataFrame:
    """Add the distinct shingle hashes of a text, ascending."""
    hashed = F.transform(words(F.col(text)), lambda w: F.xxhash64(w))
    df = with_column_once(df, "_w", hashed)
    runs = _runs("_w", size, lambda i: F.xxhash64(*[F.get("_w", i + j) for j in range(size)]), F.xxhash64("_w"))
    return with_column_once(df, name, F.sort_array(runs)).drop("_w")


def shingle_texts(df: DataFrame, name: str, text: str, size: int) -> DataFrame:
    """Add the distinct shingles of a text, as text."""
    df = with_column_once(df, "_w", words(F.col(text)))
    runs = _runs("_w", size, lambda i: F.concat_ws(" ", F.slice("_w", i + 1, F.lit(size))), F.concat_ws(" ", "_w"))
    return with_column_once(df, name, runs).drop("_w")


def size_class(n: Column) -> Column:
    """c with 2**c bins for n shingles: the smallest with at least one bin per shingle, 1 at least."""
    return F.greatest(F.ceil(F.log2(n)), F.lit(1)).cast("int")


def signature(hashes: str, bits: Column) -> Column:
    """The least hash of each bin; bins are the leading bits, so they ascend with the hashes."""

    def bin_of(h: Column) -> Column:
        return F.call_function("shiftright", h, 64 - bits)

    return F.filter(hashes, lambda h, i: (i == 0) | (bin_of(h) != bin_of(F.get(hashes, i - 1))))


def marked(hashes: str, bits: Column) -> Column:
    """All hashes as ``h, least``: whether a hash is the least of its bin."""

    def bin_of(h: Column) -> Column:
        return F.call_function("shiftright", h, 64 - bits)

    return F.transform(
        hashes,
        lambda h, i: F.struct(
            h.alias("h"), ((i == 0) | (bin_of(h) != bin_of(F.get(hashes, i - 1)))).alias("least")
        ),
    )


def item_hashes(items: DataFrame, short_item: int) -> DataFrame:
    """``item_key, h, from_class``: classes in which h is in the item's signature; NULL for short items."""
    exploded = items.select("item_key", "hashes", F.posexplode("hashes").alias("i", "h"))
    before = F.get("hashes", F.col("i") - 1)
    differing = F.length(F.bin(F.col("h").bitwiseXOR(before)))
    first = F.when(F.col("i") == 0, 1).otherwise(65 - differing)
    own = F.when(F.size("hashes") >= short_item, first).cast("int")
    return exploded.select("item_key", "h", own.alias("from_class"))


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    size: int = SHINGLE,
    containment: float = CONTAINMENT,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    short_item: int = SHORT_ITEM,
    max_broadcast: int = MAX_BROADCAST_HASHES,
    max_candidates: int = MAX_BROADCAST_CANDIDATES,
) -> DataFrame:
    """``doc_id, text_hash, item_id, n_shared, n_item, containment`` per item held by a document.

    A text of fewer words than a shingle is one shingle. Null and empty texts hold nothing and
    are held by none. Null identifiers are carried through; rows that repeat an identifier
    and text give one row; of several texts of one item the best counts (equal ones are one row); an
    empty table gives an empty result. A very long text is one row's arrays of words and hashes, some
    40 bytes per word.
    """
    rows = documents(docs, doc_id, text).withColumn("text_hash", F.xxhash64("text"))
    own = documents(items, item_id, item_text).withColumn("item_key", F.xxhash64("doc_id", "text"))
    own = shingle_hashes(own.dropDuplicates(["item_key"]), "hashes", "text", size)
    index = checkpointed(item_hashes(own, short_item))
    n_hashes, all_short = index.agg(F.count(F.lit(1)), F.count_if(F.col("from_class").isNull())).first()

    signed = shingle_hashes(rows, "hashes", "text", size).filter(F.size("hashes") > 0)
    signed = signed.select("doc_id", "text_hash", "hashes", size_class(F.size("hashes")).alias("bits"))
    if all_short:
        # Short items want every hash, so that all are looked up at once, marked if they are a bin's least.
        looked_up = signed.select("doc_id", "text_hash", "bits", F.inline(marked("hashes", F.col("bits"))))
        met = _meet(looked_up, index, n_hashes, max_broadcast)
        met = met.filter("from_class IS NULL OR (least AND bits >= from_class)")
    else:
        minima = signed.select("doc_id", "text_hash", "bits", F.explode(signature("hashes", F.col("bits"))).alias("h"))
        met = _meet(minima, index, n_hashes, max_broadcast).filter("bits >= from_class")
    candidates = checkpointed(
        met.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), "item_key").distinct()
    )
    # The texts stay where they are if the documents found are few.
    if candidates.count() <= max_candidates:
        candidates = F.broadcast(candidates)
    held = rows.join(candidates, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")))
    held = shingle_texts(held, "doc_shingles", "text", size).select(
        "doc_id", "text_hash", "item_key", "doc_shingles"
    )
    texts = shingle_texts(own, "item_shingles", "text", size).select(
        "item_key", F.col("doc_id").alias("item_id"), "item_shingles"
    )
    shared = F.size(F.array_intersect("item_shingles", "doc_shingles")).cast("bigint")
    checked = held.join(texts, "item_key").select(
        "doc_id", "text_hash", "item_id",
        shared.alias("n_shared"), F.size("item_shingles").cast("bigint").alias("n_item"),
    )
    share = (F.col("n_shared") / F.col("n_item")).alias("containment")
    best = F.max(F.struct(share, "n_shared", "n_item")).alias("best")
    return (
        checked.groupBy("doc_id", "text_hash", "item_id").agg(best)
        .filter(F.col("best.containment") >= containment)
        .select("doc_id", "text_hash", "item_id", "best.n_shared", "best.n_item", "best.containment")
    )


def _meet(doc_hashes: DataFrame, index: DataFrame, n_hashes: int, max_broadcast: int) -> DataFrame:
    """Documents' hashes that the index holds; the counted index is broadcast only if it is small."""
    return doc_hashes.join(F.broadcast(index) if n_hashes <= max_broadcast else index, "h")


def without_items(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that hold none of the items found.

    Null identifiers and texts are matched like values, repeated rows stay or go together, an empty table
    stays empty.
    """
    own_id, own_hash = unused_name(docs, "id"), unused_name(docs, "hash")
    bad = found.select(F.col("doc_id").alias(own_id), F.col("text_hash").alias(own_hash)).distinct()
    same = F.col(quoted(doc_id)).cast("bigint").eqNullSafe(bad[own_id]) & (
        F.xxhash64(F.col(quoted(text))) == bad[own_hash]
    )
    return docs.join(bad, same, "left_anti")
