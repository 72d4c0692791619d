"""Exact repeats of ``window`` words, found through fixed-block anchors.

Every document is cut into blocks of ``(window + 1) // 2`` words from its start. A run of
``window`` words holds at least one whole block of its own document, wherever it stands, so a
repeat is found by probing the blocks with every rolling run of the same length. Around each
hit the runs of ``window`` words that hold the block are compared (96 bits and the partition
number of two independent hashes); those that occur again are joined to maximal repeats.

Documents travel in buckets of bounded size. A bucket asks each partition of the index about
its blocks and gets a bit per question, so a passage that a third of all documents hold is
asked about at most once per bucket: no group grows with the number of copies, no pairs are
made. Index partitions grow in number with the input, not in size.

Rows that repeat both identifier and text would share a bucket, so of those one goes to the
buckets, for the others to meet, and the rows themselves are answered where they are: all runs
of such a row stand in its copies too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagstream.llm.runtime import checkpointed, documents, shuffle_partitions, text_bytes
from tagstream.llm.words import BASES, U64, Words, rolling, window_starts

WINDOW = 35
# Bytes of text per bucket, and of text whose probes one index partition holds.
BUCKET_BYTES = 2 << 20
INDEX_BYTES = 6 << 20
# Repeated rows are told by their keys (16 bytes each), broadcast up to this many, else joined by a shuffle.
MAX_BROADCAST_KEYS = 1_000_000

_KEY = np.dtype([("high", "<u8"), ("low", "<u4")])
_BLOCK = np.dtype("<u4")
_QUESTIONS = "bucket int, part int, probes binary, asked binary"
_ANSWERS = "bucket int, part int, stage int, bits binary"
_RESULT = "doc_id bigint, n_words bigint, spans array<struct<start: bigint, end: bigint>>, kept_text string"


class _Bucket:
    """The blocks and runs of one bucket's documents; depends on the set of documents, not on their order."""

    def __init__(self, texts: pa.Array, window: int, parts: int):
        self.window, self.parts, self.block = window, parts, (window + 1) // 2
        self.words = Words(texts)
        self.hashes = self.words.hashes(BASES[0])
        first, counts = self.words.first, self.words.counts
        roll = rolling(self.hashes, self.block)
        valid = window_starts(first, self.block, least=window)
        place = np.arange(len(self.hashes)) - np.repeat(first[:-1], counts)
        self.anchors = np.flatnonzero(valid & (place[: len(valid)] % self.block == 0))
        self.coded = self._coded(roll)
        self.probes, times = np.unique(self.coded[valid], return_counts=True)
        self.repeated = self.probes[times > 1]
        anchors = np.unique(self.coded[self.anchors])
        self.asked = (times == 1) & _among(self.probes, anchors)

    def _coded(self, roll: np.ndarray) -> np.ndarray:
        """Index partition in the upper half, 32 bits of the hash in the lower."""
        part = (roll >> U64(32)) % U64(self.parts)
        return (part << U64(32)) | (roll & U64(0xFFFFFFFF))

    def block_questions(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """By index partition: the probes, and which of them are blocks to be asked about."""
        cuts = np.searchsorted(self.probes, np.arange(self.parts + 1, dtype=U64) << U64(32))
        low = (self.probes & U64(0xFFFFFFFF)).astype(_BLOCK)
        return [(low[a:b], self.asked[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]

    def hit_anchors(self, bits: dict[int, bytes]) -> np.ndarray:
        found = self._answered(bits, self.probes >> U64(32), self.asked)
        known = np.sort(np.concatenate([self.repeated, self.probes[found]]))
        return self.anchors[_among(self.coded[self.anchors], known)]

    def _answered(self, bits: dict[int, bytes], part: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """Positions asked about that were found again; ``part`` ascends."""
        asked = np.flatnonzero(asked)
        cuts = np.searchsorted(part[asked], np.arange(self.parts + 1, dtype=part.dtype))
        found = [asked[:0]]
        for p, answer in bits.items():
            own = asked[cuts[p] : cuts[p + 1]]
            yes = np.unpackbits(np.frombuffer(answer, np.uint8), count=len(own))
            found.append(own[yes.astype(bool)])
        return np.concatenate(found)

    def candidates(self, hits: np.ndarray) -> None:
        """Runs of ``window`` words that hold a hit block: where they start, and their keys."""
        full = window_starts(self.words.first, self.window)
        reach = np.zeros(len(full) + 1, np.int64)
        # A run must not start before its document does: blocks stand at multiples from there.
        place = np.arange(len(self.hashes)) - np.repeat(self.words.first[:-1], self.words.counts)
        begin = np.maximum(hits - (self.window - self.block), hits - place[hits])
        np.add.at(reach, np.minimum(begin, len(full)), 1)
        np.add.at(reach, np.minimum(hits + 1, len(full)), -1)
        self.starts = np.flatnonzero(full & (np.cumsum(reach[:-1]) > 0))
        high = rolling(self.hashes, self.window, BASES[0])[self.starts]
        second = rolling(self.words.hashes(BASES[1]), self.window, BASES[1])[self.starts]
        keys = np.empty(len(high), _KEY)
        keys["high"], keys["low"] = high, second & U64(0xFFFFFFFF)
        part = (second >> U64(32)) % U64(self.parts)
        order = np.lexsort((keys["low"], keys["high"], part))
        fresh = np.ones(len(order), bool)
        if len(order):
            a, b = order[1:], order[:-1]
            fresh[1:] = (keys[a] != keys[b]) | (part[a] != part[b])
        number = np.cumsum(fresh) - 1
        self.number = np.empty(len(order), np.int64)
        self.number[order] = number
        self.distinct, self.part = keys[order][fresh], part[order][fresh]
        self.times = np.bincount(number, minlength=len(self.distinct))

    def run_questions(self) -> list[tuple[np.ndarray, np.ndarray]]:
        cuts = np.searchsorted(self.part, np.arange(self.parts + 1, dtype=U64))
        asked = self.times == 1
        return [(self.distinct[a:b], asked[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]

    def repeated_starts(self, bits: dict[int, bytes]) -> np.ndarray:
        again = self.times > 1
        again[self._answered(bits, self.part, self.times == 1)] = True
        return self.starts[again[self.number]]


def _among(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)
    return sorted_set[at] == values


def _bytes(arrays) -> pa.Array:
    return pa.array([a.tobytes() for a in arrays], pa.binary())


def _bits(table: pa.Table, stage: int) -> dict[int, bytes]:
    return {r["part"]: r["bits"] for r in table.to_pylist() if r["stage"] == stage}


def _questions(key, by_part: list[tuple[np.ndarray, np.ndarray]]) -> pa.Table:
    used = [p for p, (probes, _) in enumerate(by_part) if len(probes)]
    return pa.table(
        [
            pa.array([key[0].as_py()] * len(used), pa.int32()),
            pa.array(used, pa.int32()),
            _bytes(by_part[p][0] for p in used),
            _bytes(np.packbits(by_part[p][1]) for p in used),
        ],
        names=["bucket", "part", "probes", "asked"],
    )


def _ask_blocks(window: int, parts: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        return _questions(key, _Bucket(table["text"], window, parts).block_questions())

    return run


def _held_twice(values: np.ndarray) -> np.ndarray:
    """For each value, whether it stands in the array again."""
    if values.dtype.names:
        order = np.lexsort((values["low"], values["high"]))
    else:
        order = np.argsort(values)
    ascending = values[order]
    same = np.zeros(len(values) + 1, bool)
    same[1:-1] = ascending[1:] == ascending[:-1]
    out = np.empty(len(values), bool)
    out[order] = same[1:] | same[:-1]
    return out


def _answer(dtype: np.dtype, stage: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        """A bit per question: does another bucket hold it too? A bucket sends a value once."""
        probes = [np.frombuffer(b.as_buffer(), dtype) for b in table["probes"]]
        twice = _held_twice(np.concatenate(probes))
        ends = np.cumsum([len(p) for p in probes])
        rows = []
        for bucket, end, own, asked in zip(table["bucket"].to_pylist(), ends, probes, table["asked"]):
            chosen = np.unpackbits(np.frombuffer(asked.as_buffer(), np.uint8), count=len(own)).astype(bool)
            found = twice[end - len(own) : end][chosen]
            if found.any():
                rows.append((bucket, np.packbits(found)))
        return pa.table(
            [
                pa.array([r[0] for r in rows], pa.int32()),
                pa.array([key[0].as_py()] * len(rows), pa.int32()),
                pa.array([stage] * len(rows), pa.int32()),
                _bytes(r[1] for r in rows),
            ],
            names=["bucket", "part", "stage", "bits"],
        )

    return run


def _ask_runs(window: int, parts: int):
    def run(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        bucket = _Bucket(table["text"], window, parts)
        bucket.candidates(bucket.hit_anchors(_bits(answers, 0)))
        return _questions(key, bucket.run_questions())

    return run


def _remove(window: int, parts: int):
    def run(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        bucket = _Bucket(table["text"], window, parts)
        bucket.candidates(bucket.hit_anchors(_bits(answers, 0)))
        starts = bucket.repeated_starts(_bits(answers, 1))
        words = bucket.words
        change = np.zeros(len(words.starts) + 1, np.int64)
        change[starts] += 1
        np.subtract.at(change, starts + window, 1)
        covered = np.cumsum(change[:-1]) > 0
        edges = np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))
        # A repeat ends with its document: adjoining documents may both be covered.
        border = np.zeros(len(covered) + 1, bool)
        border[words.first] = True
        opens = np.flatnonzero((edges[:-1] == 1) | (border[:-1] & covered))
        closes = np.flatnonzero((edges[1:] == -1) | (border[1:] & covered)) + 1
        first, data = words.first, words.data.tobytes()
        spans, kept = [], []
        low = np.searchsorted(opens, first)
        answered = np.flatnonzero(table["asks"].to_numpy())
        for d in answered:
            begin, end = int(first[d]), int(first[d + 1])
            text = data[words.offsets[d] : words.offsets[d + 1]]
            own = range(low[d], low[d + 1])
            spans.append([{"start": int(opens[i]) - begin, "end": int(closes[i]) - begin} for i in own])
            pieces = text.split() if end > begin else []
            for i in reversed(own):
                del pieces[opens[i] - begin : closes[i] - begin]
            kept.append(b" ".join(pieces).decode())
        doc_id = table["doc_id"].combine_chunks().take(pa.array(answered))
        return pa.table([doc_id, *_results(words.counts[answered], spans, kept)], names=_NAMES)

    return run


_NAMES = ["doc_id", "n_words", "spans", "kept_text"]


def _results(counts: np.ndarray, spans: list, kept: list[str]) -> list[pa.Array]:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return [pa.array(counts, pa.int64()), pa.array(spans, span), pa.array(kept, pa.string())]


def _remove_copies(window: int):
    """Rows that stand in the table again as they are: whole, unless they are shorter than a run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, spans, kept = [], [], []
            for text in batch.column("text").cast(pa.binary()):
                words = (text.as_py() or b"").split()
                gone = len(words) >= window
                counts.append(len(words))
                spans.append([{"start": 0, "end": len(words)}] if gone else [])
                kept.append("" if gone else b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *_results(np.array(counts, np.int64), spans, kept)], names=_NAMES
            )

    return run


def split_copies(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``doc_id, text, asks`` of each row once, and the rows that stand in the table again (None if none do).

    Where ``asks`` is false the row stands for copies.
    """
    keys = [F.xxhash64("doc_id", "text").alias("h"), F.xxhash64(F.lit(1), "text", "doc_id").alias("h2")]
    again = checkpointed(rows.select(*keys).groupBy("h", "h2").count().filter("count > 1").select("h", "h2"))
    n = again.count()
    if not n:
        return rows.withColumn("asks", F.lit(True)), None
    held = F.broadcast(again) if n <= MAX_BROADCAST_KEYS else again
    keyed = rows.select("doc_id", "text", *keys)
    single = keyed.join(held, ["h", "h2"], "left_anti").select("doc_id", "text", F.lit(True).alias("asks"))
    copies = keyed.join(held, ["h", "h2"], "left_semi").select("doc_id", "text")
    return single.unionByName(copies.distinct().withColumn("asks", F.lit(False))), copies


def in_buckets(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)).cast("int"))


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row ``doc_id``, ``n_words``, ``spans`` of removed words, and ``kept_text``.

    A word goes if a run of ``window`` words that covers it stands anywhere else too, in the
    same document included. A null or empty text has no words; a null identifier is carried
    through; repeated rows are copies of each other; an empty table gives an empty result. A very long
    text is part of one bucket, whose arrays take some 25 bytes per byte of text.
    """
    if window < 2:
        raise ValueError("the window must have at least two words")
    spark = docs.sparkSession
    rows = documents(docs, doc_id, text)
    size, least = text_bytes(rows), shuffle_partitions(spark)
    buckets = max(2 * least, size // BUCKET_BYTES + 1)
    parts = max(least, size // INDEX_BYTES + 1)
    once, copies = split_copies(rows)
    grouped = in_buckets(once, buckets).groupBy("bucket")

    block_answers = (
        grouped.applyInArrow(_ask_blocks(window, parts), _QUESTIONS)
        .groupBy("part")
        .applyInArrow(_answer(_BLOCK, 0), _ANSWERS)
    )
    run_answers = (
        grouped.cogroup(block_answers.groupBy("bucket"))
        .applyInArrow(_ask_runs(window, parts), _QUESTIONS)
        .groupBy("part")
        .applyInArrow(_answer(_KEY, 1), _ANSWERS)
    )
    answers = block_answers.unionByName(run_answers)
    removed = grouped.cogroup(answers.groupBy("bucket")).applyInArrow(_remove(window, parts), _RESULT)
    return removed if copies is None else removed.unionByName(copies.mapInArrow(_remove_copies(window), _RESULT))
