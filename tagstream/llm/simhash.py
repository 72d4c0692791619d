"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints that differ in at most k bits agree, in one of ``k // 2 + 1`` segments, up to one
bit. So every distinct fingerprint is indexed under each segment with each one of its bits as
a wildcard, and an equality join on these 64 keys finds all candidates.

The keys are shuffled once. A key that just two fingerprints share gives one pair, which is
verified. Fingerprints that meet others under a more crowded key (many copies, or chance in a
very large table) are linked by keys of the whole fingerprint whose groups are bounded by
construction: for k = 2 a fingerprint and all that differ from it in one bit, for k = 1 the
fingerprint with one bit as a wildcard. Sharing such a key proves the link, so members need
only be tied to the group's smallest. A segment's value that very many fingerprints hold is
counted before (reduced on the map side) and not indexed: these fingerprints, and those one bit
away in that segment, go straight to the keys of the whole. So no group grows with the data,
and the work is linear in the number of distinct fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagstream.functions.plan import quoted
from tagstream.llm.components import components
from tagstream.llm.runtime import checkpointed, documents, shuffle_partitions, unused_name

SHINGLE = 3
MAX_DISTANCE = 2
SEED = 42
BITS = 64
# Distinct fingerprints that may hold one value of a segment and still be indexed under its keys.
MOST_TOGETHER = 2048
# Shingles hashed at a time, so that a very long text needs little more than itself.
_BLOCK = 1 << 15


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The signed 64-bit fingerprint of a text's lower-cased words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        starts, ends = np.array([0]), np.array([len(joined)])
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts, ends = (ends - lengths)[: len(words) - shingle + 1], ends[shingle - 1 :]
    votes = np.zeros(BITS, np.int64)
    for i in range(0, len(ends), _BLOCK):
        spans = zip(starts[i : i + _BLOCK].tolist(), ends[i : i + _BLOCK].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        block = hashes.view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(ends), bitorder="little").view("<i8")[0])


def fingerprints(
    docs: DataFrame, shingle: int = SHINGLE, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, ``text_hash`` and the fingerprint ``h`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            values = [fingerprint(t.as_py() or b"", shingle) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(values, pa.int64())],
                names=["doc_id", "text_hash", "h"],
            )

    rows = documents(docs, doc_id, text).withColumn("text_hash", F.xxhash64("text"))
    return rows.mapInArrow(run, "doc_id bigint, text_hash bigint, h bigint")


def _flipped(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.cast("int"))


def _segments(rows: DataFrame, segments: int) -> DataFrame:
    """Each fingerprint's segments: ``h, segment, value`` (the segment's bits, from bit 0)."""
    width = BITS // segments
    ones = F.lit((1 << width) - 1 if width < BITS else -1).cast("bigint")
    values = [F.expr(f"shiftrightunsigned(h, {i * width})").bitwiseAND(ones) for i in range(segments)]
    return rows.select("h", F.posexplode(F.array(*values)).alias("segment", "value"))


def wildcard_keys(rows: DataFrame, segments: int) -> DataFrame:
    """Rows of ``_segments`` with every bit of the segment left out: ``key, h``.

    With two segments the key is one number: six bits say which bit is missing, 32 hold the rest.
    """
    width = BITS // segments
    bit = F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("bit")
    bits = rows.select("h", "segment", "value", bit)
    rest = F.col("value").bitwiseAND(F.bitwise_not(_flipped(F.col("bit"))))
    missing = F.col("segment") * width + F.col("bit")
    if segments == 1:
        return bits.select(F.struct(missing.alias("bit"), rest.alias("rest")).alias("key"), "h")
    high = F.call_function("shiftleft", missing.cast("bigint"), F.lit(width))
    return bits.select(high.bitwiseOR(rest).alias("key"), "h")


def _whole_keys(rows: DataFrame, max_distance: int) -> DataFrame:
    if max_distance == 1:
        return wildcard_keys(_segments(rows, 1), 1)
    flips = [F.col("h"), *[F.col("h").bitwiseXOR(_flipped(F.lit(i))) for i in range(BITS)]]
    return rows.select(F.explode(F.array(*flips)).alias("key"), "h")


def _without_full(rows: DataFrame, segments: int, most: int) -> tuple[DataFrame, DataFrame | None]:
    """``_segments`` rows whose value at most ``most`` fingerprints hold, and the fingerprints
    that hold another value or one a bit away from it (None: there are none).
    """
    own = ["segment", "value"]
    full = checkpointed(rows.groupBy(*own).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most).select(*own))
    if full.isEmpty():
        return rows, None
    near = [F.col("value"), *[F.col("value").bitwiseXOR(_flipped(F.lit(i))) for i in range(BITS // segments)]]
    around = full.select("segment", F.explode(F.array(*near)).alias("value")).distinct()
    return rows.join(full, own, "left_anti"), rows.join(around, own, "left_semi").select("h")


def links(distinct: DataFrame, max_distance: int = MAX_DISTANCE, most: int = MOST_TOGETHER) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints ``h`` that connect all within the distance.

    Not every such pair is listed: a group that proves its links is tied to its smallest member.
    """
    if max_distance not in (1, 2):
        raise ValueError("the distance must be 1 or 2")
    # Few bytes before, 64 times as many rows after: the adaptive plan would leave it to a few tasks.
    distinct = distinct.repartition(shuffle_partitions(distinct.sparkSession), "h")
    segments = max_distance // 2 + 1
    rows, together = _segments(distinct, segments), None
    if segments > 1:
        rows, together = _without_full(rows, segments, most)
    # Dealt by key as they are: nearly every key is met once, so reducing before would only cost.
    keys = wildcard_keys(rows, segments).repartition("key")
    shared = keys.groupBy("key").agg(F.collect_list("h").alias("members")).filter(F.size("members") > 1)
    shared = checkpointed(shared.select("members"))
    two = F.size("members") == 2
    a, b = F.array_min("members").alias("a"), F.array_max("members").alias("b")
    pairs = shared.filter(two).select(a, b).filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance)
    crowded = shared.filter(~two).select(F.explode("members").alias("h"))
    if together is not None:
        crowded = crowded.unionByName(together)
    groups = _whole_keys(crowded.distinct(), max_distance).groupBy("key").agg(F.collect_set("h").alias("members"))
    tied = groups.filter(F.size("members") > 1).select(a, F.explode("members").alias("b"))
    return pairs.unionByName(tied.filter("a <> b")).distinct()


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    max_distance: int = MAX_DISTANCE,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id``, ``text_hash``, ``h``, ``root`` and ``component_id`` per row.

    Rows of equal fingerprints are linked, so are those within the distance; the component is
    named by the smallest identifier in it (``root``: by its smallest fingerprint). Null and empty texts have fingerprint zero. A row
    with a null identifier is linked like any other and names no component; if a component
    has no identifier at all, its name is null. Repeated rows stay.
    """
    rows = checkpointed(fingerprints(docs, shingle, doc_id, text))
    distinct = checkpointed(rows.groupBy("h").agg(F.min("doc_id").alias("least")))
    roots = components(links(distinct.select("h"), max_distance)).withColumnRenamed("node", "h")
    rooted = distinct.join(roots, "h", "left").withColumn("root", F.coalesce("root", "h"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(names, "root").select("h", "root", "component_id")
    return rows.join(named, "h").select("doc_id", "text_hash", "h", "root", "component_id")


def one_of_each(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand first in their component: one row of each.

    First is the smallest identifier (a null one comes last), then the smaller fingerprint, then the smaller hash
    of the text; of repeated rows one stays. Null and empty texts are rows like any other; an empty table
    stays empty.
    """
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "h", "text_hash")
    winners = found.groupBy("root").agg(F.min(first).alias("w"))
    own_id, own_hash = unused_name(docs, "id"), unused_name(docs, "hash")
    winners = winners.select(F.col("w.doc_id").alias(own_id), F.col("w.text_hash").alias(own_hash))
    rows = docs.withColumns(
        {own_id: F.col(quoted(doc_id)).cast("bigint"), own_hash: F.xxhash64(F.col(quoted(text)))}
    )
    same = rows[own_id].eqNullSafe(winners[own_id]) & (rows[own_hash] == winners[own_hash])
    kept = rows.join(winners, same, "left_semi").dropDuplicates([own_id, own_hash])
    return kept.select(*[F.col(quoted(c)) for c in docs.columns])
