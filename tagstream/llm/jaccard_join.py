"""Similarity join of texts by the Jaccard coefficient of their word n-grams.

Texts of equal sets are one class, whatever their number. Classes meet by the keys of their
sketches' pieces (``parity``), which no similar pair can all lack; the parity sketches' Hamming
distance, a lower bound of the sets' symmetric difference, rules most chance meetings out; the
rest is verified on the tokens of the whole texts.

Only what decides the components is verified. Every class under a key is first held against the
smallest one there; then those that are not linked to it against all others, as long as a key
has few. A key of very many classes (a passage that a third of all texts hold, a family of
thousands of near copies) is never taken apart into pairs: if its classes are not connected by
then, all their pieces are named, and each class needs only as many keys as cannot all be lost,
so that crowded keys go. What even then meets under crowded keys alone is compared by blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagstream.llm.components import components
from tagstream.llm.parity import Sets, folded, hamming, most_different, n_pieces, similar
from tagstream.llm.runtime import checkpointed, documents, fitted
from tagstream.llm.words import U64, pieces
from tagstream.session import scratch_dir

SHINGLE = 5
PERCENT = 80
# Classes under one key that are held against each other, each with each.
FEW = 32
# Classes of one block, where crowded keys are compared by blocks.
BLOCK = 512
# Nearest sketches by which families of near copies are connected before that.
NEAREST = 4
# Classes whose names are broadcast to find their texts, 32 bytes each.
MAX_BROADCAST_CLASSES = 1_000_000

_SETS = "doc_id bigint, text_hash bigint, n bigint, digest binary, sketch binary, keys array<bigint>"
_SKETCHED = "a bigint, b bigint, n_a bigint, sketch_a binary, n_b bigint, sketch_b binary"
_EVERY_KEY = "key bigint, c bigint, band int, needed bigint, pieces bigint"
_PIECE_BYTES = 1 << 19
_PIECE_ROWS = 1 << 12
# Digests of sets a task has seen, so that copies bring no further keys.
_REMEMBERED = 100_000


def _described(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Size, digest, sketch and keys of every text; of equal sets in a task only the first has keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for piece in pieces(batch, "text", _PIECE_BYTES, _PIECE_ROWS):
                sets = Sets.of(piece.column("text"), shingle)
                keys, digests = sets.keys(percent), sets.digests()
                new = np.array([not (d in seen or seen.add(d)) for d in digests], bool)
                own = new[keys.text]
                ends = np.searchsorted(keys.text[own], np.arange(len(piece) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        piece.column("text_hash"),
                        pa.array(sets.sizes, pa.int64()),
                        pa.array(digests, pa.binary()),
                        pa.array(sets.sketches(), pa.binary()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.key[own])),
                    ],
                    names=["doc_id", "text_hash", "n", "digest", "sketch", "keys"],
                )
                if len(seen) > _REMEMBERED:
                    seen.clear()

    return docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(run, _SETS)


def _classes(described: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with the number ``c`` of their class, and per class ``c, rep, least``.

    The number is a hash of the digest. A salt under which two digests have one number is found
    out and replaced by the next.
    """
    for salt in count():
        rows = described.withColumn("c", F.xxhash64("digest", F.lit(salt)))
        classes = rows.filter("n > 0").groupBy("c").agg(
            F.min(F.struct("doc_id", "text_hash")).alias("rep"),
            F.min("doc_id").alias("least"),
            F.min("digest").alias("x"),
            F.max("digest").alias("y"),
        )
        classes = checkpointed(classes)
        if classes.filter("x <> y").isEmpty():
            return rows, classes.drop("x", "y")


class _Join:
    """Classes of equal sets (``c, rep, least``), their rows (``c, n, sketch, keys``) and what it takes to link them."""

    def __init__(
        self, docs: DataFrame, rows: DataFrame, classes: DataFrame, shingle: int, percent: int, few: int, block: int
    ):
        self.docs, self.rows, self.classes, self.shingle, self.percent = docs, rows, classes, shingle, percent
        self.few, self.block = few, block

    def links(self) -> DataFrame:
        """Verified links ``a, b`` that connect all classes that links connect."""
        met = self._met(self.rows.select("c", F.explode("keys").alias("key")))
        found = self._verified(met.filter("c <> least").select(F.col("least").alias("a"), F.col("c").alias("b")))
        tied = found.select(F.col("a").alias("least"), F.col("b").alias("c"), F.lit(True).alias("tied"))
        met = fitted(met.join(tied, ["least", "c"], "left").withColumn("tied", F.expr("tied OR c = least")))
        found = self._more(found, self._among_few(met))
        crowded = met.filter(F.col("n") > self.few)
        if crowded.filter("tied IS NULL").isEmpty():
            return found
        # Only classes under a crowded key that are not connected yet can still lack a link.
        roots = components(found).withColumnRenamed("node", "c")
        apart = fitted(_apart(crowded.select("key", "c").distinct(), roots).select("c").distinct())
        if apart.isEmpty():
            return found
        met = self._met(self._every_key(apart))
        rooted = _apart(met.filter(F.col("n") <= self.few).select("key", "c"), roots)
        found = self._more(found, self._among_rooted(rooted))
        # Crowded keys come last in the order of a class's keys, the fuller the later: a class with keys
        # enough before them has met all its like, and another needs as many as it lacks.
        crowded = met.filter(F.col("n") > self.few).groupBy("c", "band", "needed", "pieces").agg(
            F.sort_array(F.collect_list(F.struct("n", "key"))).alias("last")
        )
        lacking = (F.col("needed") - (F.col("pieces") - F.size("last"))).cast("int")
        lost = crowded.filter(lacking > 0)
        # Families of near copies fall together first: each class under its fullest key, by its nearest.
        fullest = lost.groupBy("c").agg(F.max(F.element_at("last", -1)).alias("k")).select("k.key", "c")
        apart = fitted(_apart(fullest, roots))
        if not apart.isEmpty():
            found = self._more(found, self._nearest_in_blocks(apart))
            roots = components(found).withColumnRenamed("node", "c")
        rows = lost.select("c", F.explode(F.slice("last", F.lit(1), lacking)).alias("k"))
        rows = fitted(_apart(rows.select("k.key", "c"), roots))
        if rows.isEmpty():
            return found
        return self._more(found, self._by_blocks(rows))

    def _met(self, keys: DataFrame) -> DataFrame:
        """Of the rows (``key, c`` and more) those of shared keys, with ``n`` and ``least``: how many rows, the smallest class."""
        ends = keys.groupBy("key").agg(
            F.count(F.lit(1)).alias("n"), F.min("c").alias("least"), F.max("c").alias("most")
        )
        shared = fitted(ends.filter("least <> most").drop("most"))
        return fitted(keys.join(shared, "key"))

    def _more(self, found: DataFrame, pairs: DataFrame) -> DataFrame:
        """The links, and those of the pairs that are verified."""
        pairs = fitted(pairs.distinct())
        if pairs.isEmpty():
            return found
        return fitted(found.unionByName(self._verified(pairs)).distinct())

    def _among_few(self, met: DataFrame) -> DataFrame:
        """Pairs under keys of a few classes, unless both are linked to the smallest there."""
        member = F.struct("c", F.coalesce("tied", F.lit(False)).alias("tied"))
        lists = met.filter(F.col("n") <= self.few).groupBy("key").agg(
            F.sort_array(F.collect_set(member)).alias("m"), F.max(F.col("tied").isNull()).alias("open")
        )
        lists = lists.filter("open").select("m").distinct()
        both = lists.select(F.explode(F.expr("filter(m, x -> NOT x.tied)")).alias("p"), "m")
        both = both.select(F.col("p.c").alias("p"), F.explode("m.c").alias("q")).filter("p <> q")
        return both.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"))

    def _among_rooted(self, rows: DataFrame) -> DataFrame:
        """Pairs of classes of different components under keys of a few classes."""
        lists = rows.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("c", "root"))).alias("m"))
        both = lists.select("m").distinct().select(F.explode("m").alias("p"), "m").select("p", F.explode("m").alias("q"))
        apart = both.filter("p.c < q.c AND p.root <> q.root")
        return apart.select(F.col("p.c").alias("a"), F.col("q.c").alias("b"))

    def _sketches(self, wanted: DataFrame) -> DataFrame:
        """``c, n, sketch`` of the wanted classes (a checkpointed table of ``c``)."""
        rows = self.rows.select("c", "n", "sketch").join(self._small(wanted), "c", "left_semi")
        return fitted(rows.groupBy("c").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch")))

    def _small(self, wanted: DataFrame) -> DataFrame:
        """Broadcast, if the table of classes is small enough for that."""
        return F.broadcast(wanted) if wanted.count() <= MAX_BROADCAST_CLASSES else wanted

    def _texts(self, wanted: DataFrame) -> DataFrame:
        """``c`` and a text of each of the wanted classes (a checkpointed table of ``c``)."""
        named = wanted.join(self.classes.select("c", "rep"), "c").select(
            "c", F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_hash").alias("rep_hash")
        )
        named = self._small(fitted(named))
        same = F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("text_hash") == F.col("rep_hash"))
        rows = self.docs.withColumn("text_hash", F.xxhash64("text")).join(named, same)
        return rows.select("c", "text")

    def _tokens(self, wanted: DataFrame) -> DataFrame:
        """``c`` and its tokens, as bytes; one row per class, though its text be repeated."""
        shingle = self.shingle

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in pieces(batch, "text", _PIECE_BYTES, _PIECE_ROWS):
                    sets = Sets.of(piece.column("text"), shingle)
                    tokens = [sets.of_text(d).tobytes() for d in range(len(piece))]
                    yield pa.RecordBatch.from_arrays(
                        [piece.column("c"), pa.array(tokens, pa.binary())], names=["c", "tokens"]
                    )

        rows = self._texts(wanted).mapInArrow(run, "c bigint, tokens binary")
        return rows.groupBy("c").agg(F.first("tokens").alias("tokens"))

    def _every_key(self, wanted: DataFrame) -> DataFrame:
        shingle, percent = self.shingle, self.percent

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in pieces(batch, "text", _PIECE_BYTES, _PIECE_ROWS):
                    keys = Sets.of(piece.column("text"), shingle).keys(percent, every=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(keys.key),
                            piece.column("c").take(pa.array(keys.text)),
                            pa.array(keys.band, pa.int32()),
                            pa.array(keys.needed, pa.int64()),
                            pa.array(n_pieces(keys.band, percent), pa.int64()),
                        ],
                        names=["key", "c", "band", "needed", "pieces"],
                    )

        return self._texts(wanted).mapInArrow(run, _EVERY_KEY).distinct()

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs that reach the similarity: first by their sketches, then by their tokens."""
        percent = self.percent
        pairs = fitted(pairs.distinct())
        sketches = self._sketches(fitted(pairs.select(F.explode(F.array("a", "b")).alias("c")).distinct()))
        near = fitted(
            self._both(pairs, sketches, ["n", "sketch"])
            .mapInArrow(_filter(lambda row: _may_be_similar(row, percent)), _SKETCHED)
            .select("a", "b")
        )
        if near.isEmpty():
            return near
        wanted = near.select(F.explode(F.array("a", "b")).alias("c")).distinct()
        tokens = fitted(self._tokens(fitted(wanted)), 5_000)
        verified = self._both(near, tokens, ["tokens"]).mapInArrow(
            _filter(lambda row: _is_similar(row, percent)), "a bigint, b bigint, tokens_a binary, tokens_b binary"
        )
        return fitted(verified.select("a", "b"))

    def _both(self, pairs: DataFrame, described: DataFrame, columns: list[str]) -> DataFrame:
        """Pairs with what is known of either. Many pairs name one least class ``a``, so ``b`` comes first."""
        for end in ("b", "a"):
            own = described.select(F.col("c").alias(end), *[F.col(x).alias(f"{x}_{end}") for x in columns])
            pairs = pairs.join(own, end)
        return pairs.select("a", "b", *[f"{x}_{end}" for end in ("a", "b") for x in columns])

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """The rows with ``n`` and ``sketch`` of their class and the number of ``blocks`` of their key."""
        counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows"))
        blocks = (F.floor((F.col("rows") - 1) / self.block) + 1).cast("int").alias("blocks")
        sketches = self._sketches(fitted(rows.select("c").distinct()))
        return rows.join(counts, "key").select("key", "c", "root", blocks).join(sketches, "c")

    def _nearest_in_blocks(self, rows: DataFrame) -> DataFrame:
        """Of every class the pairs with the few of other components whose sketches are nearest, in two
        random blocks of its key: not all pairs, but enough to connect what is close together."""
        percent = self.percent
        dealt = self._dealt(rows).withColumn("seed", F.explode(F.array(F.lit(1), F.lit(2))))
        dealt = dealt.withColumn("i", F.pmod(F.xxhash64("c", "seed"), F.col("blocks")).cast("int"))

        def run(table: pa.Table) -> pa.Table:
            c, allowed, differ = _compared(table, percent)
            found = []
            for x in range(len(c)):
                others = np.flatnonzero(allowed(x))
                others = others[np.argsort(differ(x)[others], kind="stable")[:NEAREST]]
                found.append(np.stack([np.full(len(others), c[x]), c[others]]))
            return _pairs(found)

        return dealt.groupBy("key", "seed", "i").applyInArrow(run, "a bigint, b bigint").distinct()

    def _by_blocks(self, rows: DataFrame) -> DataFrame:
        """Pairs of classes of different components under crowded keys, as far as their sketches allow.

        A key's classes are dealt into blocks, and a group holds two blocks of a key.
        """
        percent = self.percent
        dealt = self._dealt(rows)
        dealt = dealt.withColumn("own", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        dealt = dealt.select(
            "key", "c", "root", "own", "n", "sketch",
            F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        )

        def run(table: pa.Table) -> pa.Table:
            own, i, j = table.column("own").to_numpy(), table.column("i")[0].as_py(), table.column("j")[0].as_py()
            c, allowed, _ = _compared(table, percent)
            one, later, found = own == i, np.arange(len(c)), []
            for x in np.flatnonzero(one).tolist():
                others = np.flatnonzero(allowed(x) & ((own == j) if i != j else (later > x)))
                found.append(np.stack([np.full(len(others), c[x]), c[others]]))
            return _pairs(found)

        return checkpointed(dealt.groupBy("key", "i", "j").applyInArrow(run, "a bigint, b bigint").distinct())


def _compared(table: pa.Table, percent: int):
    """A group's classes, and for each which others of other components their sketches allow, and their distances."""
    c, root, n = (table.column(x).to_numpy() for x in ("c", "root", "n"))
    sketches = [np.frombuffer(s, np.uint8) for s in table.column("sketch").to_pylist()]
    width = min(map(len, sketches))
    bits = np.stack([folded(s, width) for s in sketches])

    def differ(x: int) -> np.ndarray:
        return np.bitwise_count(bits ^ bits[x]).sum(axis=1, dtype=np.int64)

    def allowed(x: int) -> np.ndarray:
        low, high = np.minimum(n, n[x]), np.maximum(n, n[x])
        near = (100 * low >= percent * high) & (root != root[x])
        return near & (differ(x) <= most_different(low, high, percent))

    return c, allowed, differ


def _pairs(found: list[np.ndarray]) -> pa.Table:
    pairs = np.sort(np.concatenate(found, axis=1), axis=0) if found else np.zeros((2, 0), np.int64)
    return pa.table({"a": pairs[0], "b": pairs[1]})


def _apart(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows, with the ``root`` of their ``c``, of the keys whose classes are not all connected."""
    rooted = rows.join(roots, "c", "left").withColumn("root", F.coalesce("root", "c"))
    ends = rooted.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y"))
    return rooted.join(ends.filter("x <> y").select("key"), "key", "left_semi").select(*rows.columns, "root")


def _filter(keep):
    """The rows for which ``keep`` holds, given one column as a list after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A few rows at a time: sets can be large.
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                kept = [keep(row) for row in zip(*(column.to_pylist() for column in some.columns))]
                yield some.filter(pa.array(kept, pa.bool_()))

    return run


def _may_be_similar(row: tuple, percent: int) -> bool:
    _, _, n, sketch, other_n, other = row
    low, high = sorted((n, other_n))
    return 100 * low >= percent * high and hamming(sketch, other) <= most_different(n, other_n, percent)


def _is_similar(row: tuple, percent: int) -> bool:
    one, other = (np.frombuffer(tokens, U64) for tokens in row[2:])
    shared = len(np.intersect1d(one, other, assume_unique=True))
    return similar((len(one), len(other)), shared, percent)


def similar_documents(
    docs: DataFrame,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    few: int = FEW,
    block: int = BLOCK,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id, digest`` per row.

    A text's set holds its distinct runs of ``shingle`` lower-cased (A-Z) words, or all its words as one if
    they are fewer. Two rows are linked if their sets' shared part is ``percent`` hundredths or
    more of their union; the component is named by its smallest identifier. Rows of equal sets have
    one ``digest``. Null and empty texts have no shingles and no links. A row with a null identifier
    is linked like any other and names no component (a component without any has a null name);
    repeated rows stay, an empty table gives none. A very long text takes some 150 bytes in the
    worker per word of it. Shingles are told apart by 64-bit hashes, sets by 128 bits of these.
    """
    if not 50 <= percent <= 100:
        raise ValueError("the similarity must be 50 to 100 percent")
    rows = documents(docs, doc_id, text)
    path = scratch_dir(docs.sparkSession, "jaccard")
    _described(rows, shingle, percent).write.parquet(path)
    described = docs.sparkSession.read.parquet(path)
    described, classes = _classes(described)
    found = _Join(rows, described, classes, shingle, percent, few, block).links()
    roots = components(found).withColumnRenamed("node", "c")
    rooted = classes.select("c", "least").join(roots, "c", "left").withColumn("root", F.coalesce("root", "c"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(names, "root").select("c", "component_id")
    return described.select("doc_id", F.col("n").alias("n_shingles"), "digest", "c").join(named, "c", "left").select(
        "doc_id",
        "n_shingles",
        # The empty set's rows have a name each, their own.
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        "digest",
    )
