"""Token ids as ORC files, and reading them back.

Documents are dealt to tasks by ranges of their identifier and sorted there, so the files
hold them in ascending order and each file, stripe and row group covers a narrow range: its
statistics and the Bloom filter on the identifier let a reader skip what it does not need,
and stripes are read in parallel. Ids are an integer list, which ORC stores run-length
encoded. Each row says where it starts within its part; the few part totals give the rest.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tagstream.llm.runtime import documents, shuffle_partitions, text_bytes
from tagstream.llm.token_counts import byte_letters
from tagstream.llm.words import BASES, U64, Words, mixed, pieces

PART_BYTES = 16 << 20
STRIPE_BYTES = 16 << 20
ROWS_PER_INDEX = 1000
REMEMBERED = 2_000_000
# Bytes of text whose pieces are hashed together.
BATCH_BYTES = 1 << 19

_ALNUM = np.array([b < 128 and chr(b).isalnum() for b in range(256)])
_SPACE_OR_LINE_END = np.zeros(256, bool)
_SPACE_OR_LINE_END[[10, 32]] = True

FILE_SCHEMA = "part int, doc_id bigint, first bigint, n_tokens bigint, ids array<int>"

# Texts whose only blanks are single spaces and line ends fall apart at these without a pattern.
_OTHER_BLANK = re.compile(
    "[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
)
# Blanks to Python that are none to the library.
_ODD_BLANK = re.compile("[\x1c-\x1f]")
# The byte-level pattern, first coarser (a word with all that clings to it), then as it is for the
# letters that _SIMPLE allows.
_COARSE = re.compile(r" ?\S+|\s+(?!\S)|\s+")
_FINE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+")
_WORD = re.compile("( ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f]+)([.,]?)")
_SIMPLE = re.compile("[!-~\xc0-\xd6\xd8-\xf6\xf8-\u024f]+")


class ByteLevelIds:
    """Token ids of whole texts, from the ids of the pieces between their blanks.

    In a text whose blanks are single spaces and line ends between other characters, the
    pattern parts at every blank: a piece's ids depend on the piece and on what stands before
    it (nothing, a space, a line end) alone. All pieces of a batch are hashed as arrays; those
    known by both their hashes take their ids from the table, the others are encoded once.
    Other texts are taken apart by the pattern itself, or left to the library.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.spelling = byte_letters()
        self.space = self.spelling[ord(" ")]
        self.marks = {m: self._merged(m) for m in ".,"}
        self.line_end = self._merged("\n")
        self.mark_ids = np.full(256, -1, np.int64)
        for mark, ids in self.marks.items():
            if len(ids) == 4:
                self.mark_ids[ord(mark)] = int.from_bytes(ids, "little")
        self.known = _Table()

    def encoded(self, text: str) -> bytes:
        """Ids of a text that the pattern does not join with its neighbours."""
        word = _WORD.fullmatch(text)
        if word:
            ids = self._merged(word[1])
            return ids + self.marks[word[2]] if word[2] else ids
        if not _SIMPLE.fullmatch(text.removeprefix(" ")):
            return self.by_library(text)
        return b"".join([self._merged(p) for p in _FINE.findall(text)])

    def _merged(self, pre_token: str) -> bytes:
        if pre_token[1:].isalpha() and pre_token.isascii():
            spelled = pre_token.replace(" ", self.space)
        else:
            spelled = pre_token.encode().decode("latin-1").translate(self.spelling)
        return array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def by_library(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def of_texts(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text."""
        plain = [i for i, t in enumerate(texts) if self._is_plain(t)]
        out = dict(zip(plain, self._of_plain([texts[i] for i in plain])))
        return [out[i] if i in out else np.frombuffer(self._of_other(t), "<u4") for i, t in enumerate(texts)]

    def _is_plain(self, text: str) -> bool:
        return not (
            not text
            or text[0] in " \n"
            or text[-1] in " \n"
            or any(s in text for s in ("  ", "\n\n", " \n", "\n "))
            or any(s in text for s in self.special)
            or _OTHER_BLANK.search(text)
        )

    def _of_other(self, text: str) -> bytes:
        if _ODD_BLANK.search(text) or any(s in text for s in self.special):
            return self.by_library(text)
        return b"".join([self.encoded(p) for p in _COARSE.findall(text)])

    def _of_plain(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        words = Words(pa.array(texts, pa.large_string()), _SPACE_OR_LINE_END)
        # What stands before: nothing (1), a space (2), a line end (3).
        before = np.where(words.data[words.starts - 1] == 10, 3, 2).astype(U64)
        before[words.first[:-1]] = 1
        # A mark after a letter or digit is a pre-token of its own.
        last = words.data[words.ends - 1]
        marked = self.mark_ids[last] >= 0
        marked &= (words.ends - words.starts > 1) & _ALNUM[words.data[words.ends - 2]]
        marks = self.mark_ids[last[marked]]
        words.shorten(marked)
        high, low = (mixed(words.hashes(b) + before * U64(b)) for b in BASES)
        order, first, number = _distinct(high)
        if (low[order[first]][number] != low).any():
            # Two pieces of one hash: never seen, and not worth more than this.
            return [np.frombuffer(self.by_library(t), "<u4") for t in texts]
        chosen = order[first]
        data = words.data.tobytes()

        def encode(i: int) -> bytes:
            word = data[words.starts[i] : words.ends[i]].decode()
            if before[i] == 2:
                return self.encoded(" " + word)
            return self.encoded(word) if before[i] == 1 else self.line_end + self.encoded(word)

        starts, lengths, pool = self.known.look_up(high[chosen], low[chosen], chosen, encode)
        own = lengths[number]
        ends, until = np.cumsum(own + marked), np.cumsum(own)
        count = np.arange(until[-1])
        out = np.empty(ends[-1], "<u4")
        out[count + np.repeat(ends - marked - until, own)] = pool[count + np.repeat(starts[number] - until + own, own)]
        out[ends[marked] - 1] = marks
        return np.split(out, ends[words.first[1:-1] - 1])


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order that sorts the keys, where in it each distinct key begins, and each key's number."""
    order = np.argsort(keys)
    ascending = keys[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = ascending[1:] != ascending[:-1]
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(fresh) - 1
    return order, np.flatnonzero(fresh), number


class _Table:
    """Ids by two hashes, as sorted arrays: a large one, and a small one for what is new.

    About 50 bytes an entry; beyond ``REMEMBERED`` entries nothing more is kept.
    """

    def __init__(self):
        empty = np.zeros(0, U64)
        self.levels = [(empty, empty, np.zeros(0, np.int64), np.zeros(0, np.int64))] * 2
        self.pool = np.zeros(0, "<u4")

    def look_up(self, high: np.ndarray, low: np.ndarray, at: np.ndarray, encode):
        """Begin and length in the returned pool for each of the ascending hashes; what is not known is encoded."""
        starts, lengths = np.full(len(high), -1, np.int64), np.zeros(len(high), np.int64)
        for keys, checks, begins, sizes in self.levels:
            if len(keys):
                place = np.minimum(np.searchsorted(keys, high), len(keys) - 1)
                same = (keys[place] == high) & (checks[place] == low)
                starts[same], lengths[same] = begins[place[same]], sizes[place[same]]
        missing = np.flatnonzero(starts < 0)
        if not len(missing):
            return starts, lengths, self.pool
        found = [encode(i) for i in at[missing].tolist()]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts[missing], lengths[missing] = len(self.pool) + np.cumsum(sizes) - sizes, sizes
        pool = np.concatenate([self.pool, np.frombuffer(b"".join(found), "<u4")])
        if sum(len(level[0]) for level in self.levels) + len(missing) <= REMEMBERED:
            self._keep(high[missing], low[missing], starts[missing], sizes)
            self.pool = pool
        return starts, lengths, pool

    def _keep(self, *new: np.ndarray) -> None:
        main, fresh = self.levels
        fresh = _merged_levels(fresh, new)
        if len(fresh[0]) > max(1 << 15, len(main[0]) // 4):
            main, fresh = _merged_levels(main, fresh), tuple(c[:0] for c in fresh)
        self.levels = [main, fresh]


def _merged_levels(one: tuple, other: tuple) -> tuple:
    columns = [np.concatenate(pair) for pair in zip(one, other)]
    order = np.argsort(columns[0], kind="stable")
    return tuple(c[order] for c in columns)


_encoders: dict[str, ByteLevelIds] = {}


def _encoder(path: str) -> ByteLevelIds:
    if path not in _encoders:
        _encoders[path] = ByteLevelIds(path)
    return _encoders[path]


def _id_column(encoded: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0] + [len(e) for e in encoded])
    return pa.ListArray.from_arrays(
        pa.array(ends, pa.int32()), pa.array(np.concatenate(encoded).view("<i4"), pa.int32())
    )


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    doc_id: str = "doc_id",
    text: str = "text",
    part_bytes: int = PART_BYTES,
    stripe_bytes: int = STRIPE_BYTES,
    rows_per_index: int = ROWS_PER_INDEX,
) -> None:
    """Write every text's ids and the end id to ``path``, ascending by identifier.

    ``tokenizer`` is a byte-level BPE file. Null texts are empty (the end id alone), null
    identifiers come first, rows of one identifier are ordered by a hash of their text, then by the
    text, so that many of them are dealt to many tasks; an empty table gives files without rows.
    A very long text is encoded alone; its pieces and ids take some 30 bytes per byte of it.
    """
    rows = documents(docs, doc_id, text)
    parts = max(shuffle_partitions(docs.sparkSession), text_bytes(rows) // part_bytes + 1)
    end = np.array([end_id], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, first = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece in pieces(batch, "text", BATCH_BYTES, len(batch)):
                texts = [t or "" for t in piece.column("text").to_pylist()]
                encoded = [np.append(ids, end) for ids in encoder.of_texts(texts)]
                counts = np.array([len(e) for e in encoded], np.int64)
                starts = first + np.cumsum(counts) - counts
                first += int(counts.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(counts), part), pa.int32()),
                        piece.column("doc_id"),
                        pa.array(starts, pa.int64()),
                        pa.array(counts, pa.int64()),
                        _id_column(encoded),
                    ],
                    names=["part", "doc_id", "first", "n_tokens", "ids"],
                )

    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    ordered = rows.repartitionByRange(parts, "doc_id", "text_hash").sortWithinPartitions("doc_id", "text_hash", "text")
    (
        ordered.drop("text_hash").mapInArrow(run, FILE_SCHEMA)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.stripe.size", stripe_bytes)
        .option("orc.row.index.stride", rows_per_index)
        .option("compression", "zstd")
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows; a filter on ``doc_id`` skips files, stripes and row groups."""
    return spark.read.schema(FILE_SCHEMA).orc(path)


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``.

    A row of the files is a row here, null identifiers and repeated rows included; files without rows give
    none. A very long text's ids are one row's list.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            ids = lists.values.to_numpy().astype("<u4", copy=False)
            ends = lists.offsets.to_numpy()
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("part"),
                    batch.column("doc_id"),
                    batch.column("first"),
                    pa.array(np.diff(ends), pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                names=["part", "doc_id", "first", "n_tokens", "ids_crc32"],
            )

    files = read_tokens(spark, path)
    rows = files.select("part", "doc_id", "first", "ids").mapInArrow(
        run, "part int, doc_id bigint, first bigint, n_tokens bigint, ids_crc32 bigint"
    )
    # One row per part: as many as tasks wrote files.
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return rows.join(bases, "part").select(
        "doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )
