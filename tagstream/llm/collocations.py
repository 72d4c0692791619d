"""Phrase collocations mined with weighted acyclic automata.

Each task counts the phrases of its texts, block by block, in an automaton (``transducer``) that
it builds from sorted phrases and unites as it goes. When it is large it is cut by ranges of the
code of a phrase's first words, and the parts are shuffled, packed. All parts of a range are
united, which sums the weights, so a frequent phrase is one path per part and never a row per
occurrence. The states of weight ``least`` and more give the candidates; a part of a candidate
is at least as frequent, so that its weight is looked up among the same states by joins.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagstream.functions.plan import quoted
from tagstream.llm.runtime import checkpointed, ship_package, shuffle_partitions, text_bytes
from tagstream.llm.transducer import CodeCollision, Names, PhraseCounts
from tagstream.llm.words import Words, pieces

LONGEST = 3
LEAST = 10
INSIDE_PERCENT = 50
MOST = 2000
UNKNOWN_LANGUAGE = "und"
SCALE = 1_000_000

# Bytes of text per range of prefix codes, words counted together, states kept before they are sent.
RANGE_BYTES = 8 << 20
_BLOCK_BYTES = 1 << 20
_BLOCK_WORDS = 1 << 18
_MOST_STATES = 1_000_000
# Packed automata united at a time, and phrases ranked at a time.
_TOGETHER = 16
_RANKED = 10_000

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?\x0a\x0b\x0c\x0d"]] = True
_PARTING = _BREAK.copy()
_PARTING[[32, 9]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_PACKED = "part int, packed binary"
_STATES = "lang string, codes array<bigint>, f bigint, word string, clash boolean"


def _counted(piece: pa.RecordBatch, longest: int, seed: int) -> Iterator[PhraseCounts]:
    """The phrases of some texts, so many words at a time."""
    words = Words(piece.column("text"), _PARTING)
    words.data = _LOWER[words.data]
    n = len(words.starts)
    breaks = np.concatenate([[0], np.cumsum(_BREAK[words.data], dtype=np.int64)])
    joined = np.zeros(n, bool)
    joined[1:] = breaks[words.starts[1:]] == breaks[words.ends[:-1]]
    joined[words.first[:-1][words.first[:-1] < n]] = False
    names, of_text = np.unique(np.array(piece.column("lang").to_pylist(), object), return_inverse=True)
    language = np.repeat(of_text, words.counts)
    for at in range(0, n, _BLOCK_WORDS):
        own = min(_BLOCK_WORDS, n - at)
        here = slice(at, min(at + own + longest - 1, n))
        alphabet, own_names, word = _alphabet(words, here, seed)
        yield PhraseCounts.of_words(
            list(names), language[here], alphabet, own_names, word, joined[here], longest, own
        )


def _alphabet(words: Words, here: slice, seed: int) -> tuple[np.ndarray, Names, np.ndarray]:
    """The codes of a stretch's distinct words, what they are, and each word's place among them."""
    starts, ends = words.starts[here], words.ends[here]
    span = slice(int(starts[0]), int(ends[-1]))
    letters = words.data[span][words.inside[span]]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    column = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(letters.tobytes())]
    )
    encoded = column.dictionary_encode()
    distinct = encoded.dictionary.to_pylist()
    codes = np.array([xxhash.xxh64_intdigest(w, seed) for w in distinct], np.uint64)
    checks = np.array([xxhash.xxh3_64_intdigest(w, seed) for w in distinct], np.uint64)
    order = np.argsort(codes)
    if (np.diff(codes[order]) == 0).any():
        raise CodeCollision
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    names = Names(checks[order], encoded.dictionary.take(pa.array(order)))
    return codes[order], names, place[encoded.indices.to_numpy()]


class _Building:
    """Automata of growing size, united with the one before when that is not much larger."""

    def __init__(self):
        self.parts: list[PhraseCounts] = []

    def add(self, part: PhraseCounts) -> None:
        self.parts.append(part)
        while len(self.parts) > 1 and len(self.parts[-2]) <= 2 * len(self.parts[-1]):
            self.parts[-2:] = [PhraseCounts.united(self.parts[-2:])]

    def __len__(self) -> int:
        return sum(map(len, self.parts))

    def taken(self) -> PhraseCounts:
        whole, self.parts = PhraseCounts.united(self.parts), []
        return whole


def _packed_parts(texts: DataFrame, longest: int, ranges: int, seed: int) -> DataFrame:
    """``part`` and a packed automaton of the task's phrases in that range; empty bytes tell of a clash."""

    def send(whole: PhraseCounts) -> pa.RecordBatch:
        parts = whole.cut(min(2, longest), ranges)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(list(parts), pa.int32()),
                pa.array([p.packed() for p in parts.values()], pa.binary()),
            ],
            names=["part", "packed"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        building = _Building()
        try:
            for batch in batches:
                for piece in pieces(batch, "text", _BLOCK_BYTES, len(batch)):
                    for counted in _counted(piece, longest, seed):
                        building.add(counted)
                        if len(building) > _MOST_STATES:
                            yield send(building.taken())
            if len(building):
                yield send(building.taken())
        except CodeCollision:
            yield pa.RecordBatch.from_arrays(
                [pa.array([0], pa.int32()), pa.array([b""], pa.binary())], names=["part", "packed"]
            )

    return texts.mapInArrow(run, _PACKED)


def _frequent(packed: DataFrame, least: int) -> DataFrame:
    """The united automata's states of weight ``least`` and more.

    ``codes`` are the phrase's words; one word also gives its text, none the language's words.
    """

    def run(table: pa.Table) -> pa.Table:
        column = table.column("packed").combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
        whole = None
        try:
            for at in range(0, len(column), _TOGETHER):
                some = [p.as_buffer() for p in column.slice(at, _TOGETHER)]
                if not all(b.size for b in some):
                    raise CodeCollision
                read = [PhraseCounts.unpacked(b) for b in some]
                whole = PhraseCounts.united([*read, whole] if whole else read)
        except CodeCollision:
            return _state_table([""], [[]], [0], None, True)
        tables = []
        names = np.array(whole.languages, object)
        first = whole.levels[1]
        totals = np.zeros(len(whole.levels[0]), np.int64)
        np.add.at(totals, first.above, first.weight)
        tables.append(_state_table(names[whole.levels[0].label], [[]] * len(totals), totals, None, False))
        for depth in range(1, len(whole.levels)):
            which = np.flatnonzero(whole.levels[depth].weight >= least)
            language, words = whole.phrases(depth, which)
            codes = whole.alphabet[words].view(np.int64)
            text = whole.names.words.take(pa.array(which)) if depth == 1 else None
            tables.append(_state_table(names[language], codes, whole.levels[depth].weight[which], text, False))
        return pa.concat_tables(tables)

    return packed.groupBy("part").applyInArrow(run, _STATES)


def _state_table(lang, codes, f, word, clash: bool) -> pa.Table:
    n = len(lang)
    if isinstance(codes, np.ndarray):
        ends = np.arange(n + 1, dtype=np.int32) * codes.shape[1]
        codes = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(codes).reshape(-1)))
    word = pa.nulls(n, pa.string()) if word is None else pa.array(word).cast(pa.binary()).cast(pa.string())
    return pa.table(
        {
            "lang": pa.array(list(lang), pa.string()),
            "codes": pa.array(codes, pa.list_(pa.int64())),
            "f": pa.array(f, pa.int64()),
            "word": word,
            "clash": pa.array([clash] * n, pa.bool_()),
        }
    )


def phrase_counts(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """``lang, codes, f, word``: the phrases of up to ``longest`` words seen ``least`` times or more.

    A phrase is the list of its words' codes; the rows of one word hold the word too, a row
    without codes holds (in parts to be summed) the number of the language's words. A seed
    under which two words of the texts had one code is found out and replaced by the next.
    """
    ship_package(docs.sparkSession)
    texts = docs.select(
        F.coalesce(F.col(quoted(lang)).cast("string"), F.lit(UNKNOWN_LANGUAGE)).alias("lang"),
        F.col(quoted(text)).cast("string").alias("text"),
    )
    ranges = max(shuffle_partitions(docs.sparkSession), text_bytes(texts) // RANGE_BYTES + 1)
    for seed in count():
        # A task per range: hashing the few numbers would deal several to one task.
        packed = _packed_parts(texts, longest, ranges, seed).repartitionById(ranges, "part")
        states = checkpointed(_frequent(packed, least))
        if not states.filter("clash").isEmpty():
            continue
        return states.drop("clash")


def collocations(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    inside_percent: int = INSIDE_PERCENT,
    most: int = MOST,
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``most`` best phrases.

    Phrases have 2 to ``longest`` words, are read within pieces of text that ``.,;:!?`` and line
    ends part, and occur ``a`` times, ``least`` or more. Of the cuts of a phrase in two the one
    of the lowest score counts, the first of equal ones; ``l`` and ``r`` are the parts' counts, ``n`` the
    language's words, the score ``SCALE * a * a / (l * r)`` rounded down, exactly. A phrase
    whose words lie in a longer candidate with ``inside_percent`` of its occurrences or more is
    dropped. Equal scores rank by ``a``, then by the phrase's bytes.

    Null languages are ``und`` (with texts marked so), null and empty texts hold no words, repeated
    rows count each, an empty table gives no rows. Very long texts are counted so many words at
    a time; they take some 30 bytes per byte of theirs.
    """
    if longest < 2:
        raise ValueError("a phrase has two words or more")
    found = phrase_counts(docs, longest, least, text, lang)
    size = F.size("codes")
    totals = found.filter(size == 0).groupBy("lang").agg(F.sum("f").alias("n"))
    known = found.filter(size > 0).select("lang", "codes", "f")
    candidates = found.filter(size > 1).select("lang", "codes", F.col("f").alias("a"))

    cuts = candidates.select("*", F.explode(F.expr("sequence(1, size(codes) - 1)")).alias("k"))
    cuts = cuts.select(
        "*",
        F.expr("slice(codes, 1, k)").alias("left"),
        F.expr("slice(codes, k + 1, size(codes) - k)").alias("right"),
    )
    for side, name in (("left", "l"), ("right", "r")):
        looked_up = known.select("lang", F.col("codes").alias(side), F.col("f").alias(name))
        cuts = cuts.join(looked_up, ["lang", side])
    wide = {c: F.col(c).cast("decimal(16,0)") for c in ("a", "l", "r")}
    above = (wide["a"] * wide["a"]).cast("decimal(32,0)") * F.lit(SCALE).cast("decimal(7,0)")
    cuts = cuts.withColumns({"above": above.cast("decimal(38,0)"), "below": (wide["l"] * wide["r"]).cast("decimal(32,0)")})
    cuts = cuts.withColumn("score", F.expr("cast(above div below as bigint)"))
    best = cuts.groupBy("lang", "codes").agg(
        F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )

    inside = candidates.filter(size > 2).select(
        "lang",
        "a",
        F.explode(
            F.expr(
                "flatten(transform(sequence(2, size(codes) - 1), n -> "
                "transform(sequence(1, size(codes) - n + 1), i -> slice(codes, i, n))))"
            )
        ).alias("codes"),
    )
    inside = inside.groupBy("lang", "codes").agg(F.max("a").alias("longer"))
    kept = best.join(inside, ["lang", "codes"], "left").filter(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * inside_percent)
    )

    words = found.filter(size == 1).select("lang", F.col("codes")[0].alias("code"), "word")
    spelled = kept.select("lang", "codes", "a", "cut", F.posexplode("codes").alias("at", "code"))
    spelled = spelled.join(words, ["lang", "code"]).groupBy("lang", "codes").agg(
        F.first("a").alias("a"),
        F.first("cut").alias("cut"),
        F.array_join(F.expr("transform(sort_array(collect_list(struct(at, word))), x -> x.word)"), " ").alias("phrase"),
    )
    rows = checkpointed(spelled.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    best_first = [F.desc("score"), F.desc("a"), "phrase"]
    # The best of each share of a language first, then of these: no task ranks a whole language.
    shares = rows.count() // _RANKED + 1
    dealt = rows.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(shares)))
    rank = F.row_number()
    first = dealt.withColumn("rank", rank.over(Window.partitionBy("lang", "share").orderBy(*best_first)))
    ranked = first.filter(F.col("rank") <= most).drop("share").withColumn(
        "rank", rank.over(Window.partitionBy("lang").orderBy(*best_first))
    )
    ranked = ranked.filter(F.col("rank") <= most).withColumn("rank", F.col("rank").cast("bigint"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
