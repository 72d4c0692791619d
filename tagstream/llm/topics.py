"""Topics learned from the texts.

Texts become TF-IDF vectors of hashed words. The leading singular vectors of all documents span a
latent space, in which all documents fall into clusters by cosine. Counts and latent vectors are
held in files; a round of the fit is a job in which each task adds up its documents and Spark adds
up the tasks, so that only sums whose size is bounded by the parameters come to the driver. The
sums are of whole numbers: they are exact, and the same however the rows lie. The model is
broadcast, and every document goes to the nearest cluster's topic.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagstream.llm.features import inverse_frequencies, tf_idf, word_counts
from tagstream.llm.quality import unit
from tagstream.llm.runtime import checkpointed, documents, fitted
from tagstream.llm.words import Words, pieces

SIZE = 1 << 11
DIMENSIONS = 32
TOPICS = 8
ROUNDS = 30
AXES_ROUNDS = 4
# Steps of a text's vector, of an axis, of a text's place on it, of a latent vector and of a centre: products
# of two of length one, and their sums over a block of rows, stay below 2**53, so doubles hold them exactly.
WORD_UNIT = float(1 << 14)
AXIS_UNIT = float(1 << 20)
PLACE_UNIT = float(1 << 14)
LATENT_UNIT = float(1 << 24)
CENTRE_UNIT = float(1 << 26)
# Latent vectors nearer than that to a centre are no start of another.
SAME = 1 - 1e-6
ENTRY = np.dtype([("feature", "<u2"), ("weight", "<f2")])
# Rows looked at together: dense rows of words take 16 KB each, latent vectors far less.
BLOCK_ROWS = {"counts": 128, "vector": 2048}
COUNTED_ROWS_PER_PARTITION = 20_000
# The topic of texts without words.
NO_TOPIC = "none"


@dataclass
class TopicModel:
    idf: np.ndarray
    axes: np.ndarray  # features by dimensions
    centres: np.ndarray  # topics by dimensions, of length one

    def topics(self, counts: np.ndarray) -> np.ndarray:
        """The nearest centre of each text, the first of equally near ones."""
        latent = unit((tf_idf(counts, self.idf) @ self.axes).astype(np.float64))
        # Rounded, so that the order of a sum does not decide.
        return np.argmax(np.round(latent @ self.centres.T, 5), axis=1)


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary values that lie one after the other in ``data``; ``ends`` are bytes, from 0."""
    buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data.tobytes())]
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, buffers)


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values one after the other, and where each begins."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return held[offsets[0] : offsets[-1]], offsets - offsets[0]


def entries(counts: np.ndarray) -> pa.Array:
    """Per text an entry for each word it has, with the logarithm of its count."""
    row, feature = np.nonzero(counts)
    out = np.empty(len(row), ENTRY)
    out["feature"], out["weight"] = feature, np.log1p(counts[row, feature])
    return _binary(out, np.searchsorted(row, np.arange(len(counts) + 1)) * ENTRY.itemsize)


def word_vectors(column: pa.Array, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of length one (or zero) in whole steps of ``1 / WORD_UNIT``."""
    data, offsets = _bytes(column)
    held = data.view(ENTRY)
    row, feature = np.repeat(np.arange(len(column)), np.diff(offsets) // ENTRY.itemsize), held["feature"]
    weight = held["weight"].astype(np.float64) * idf[feature]
    length = np.sqrt(np.bincount(row, weight * weight, len(column)))
    out = np.zeros((len(column), len(idf)))
    out[row, feature] = np.rint(weight / length[row] * WORD_UNIT)
    return out


def _blocks(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Array]:
    for batch in batches:
        for begin in range(0, len(batch), BLOCK_ROWS[column]):
            yield batch.column(column).slice(begin, BLOCK_ROWS[column])


def added(rows: DataFrame, column: str, shape: tuple[int, int], step: Callable[[pa.Array], np.ndarray]) -> np.ndarray:
    """The sum, over all rows, of the whole numbers that ``step`` makes of blocks of a column."""
    names = [f"c{i}" for i in range(shape[1])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, np.int64)
        for block in _blocks(batches, column):
            total += step(block).astype(np.int64)
        used = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), *[pa.array(c, pa.int64()) for c in total[used].T]], names=["row", *names]
        )

    schema = ", ".join(["row int", *[f"{c} bigint" for c in names]])
    sums = rows.select(column).mapInArrow(run, schema).groupBy("row").agg(*[F.sum(c).alias(c) for c in names])
    found = sums.toArrow()
    out = np.zeros(shape, np.int64)
    out[found["row"].to_numpy()] = np.column_stack([found[c].to_numpy() for c in names])
    return out


def frequencies(rows: DataFrame) -> tuple[np.ndarray, int, int]:
    """In how many texts each word occurs, the number of texts, and of those that have a word."""

    def step(block: pa.Array) -> np.ndarray:
        data, offsets = _bytes(block)
        occurs = np.bincount(data.view(ENTRY)["feature"], minlength=SIZE)
        return np.append(occurs, [len(block), np.count_nonzero(np.diff(offsets))])[:, None]

    total = added(rows, "counts", (SIZE + 2, 1), step)[:, 0]
    return total[:SIZE], int(total[SIZE]), int(total[SIZE + 1])


def leading_axes(rows: DataFrame, idf: np.ndarray, n: int, dimensions: int, rounds: int = AXES_ROUNDS) -> np.ndarray:
    """Leading right singular vectors of all rows, in whole steps, by subspace iteration from a fixed start."""
    width = min(dimensions + 16, n, len(idf))

    def turned(basis: np.ndarray) -> np.ndarray:
        """The product of the rows' transpose, the rows and the basis."""
        axes = np.rint(basis * AXIS_UNIT)

        def step(block: pa.Array) -> np.ndarray:
            vectors = word_vectors(block, idf)
            return vectors.T @ np.rint(vectors @ axes * (PLACE_UNIT / WORD_UNIT / AXIS_UNIT))

        return added(rows, "counts", basis.shape, step) / (WORD_UNIT * PLACE_UNIT)

    basis = np.linalg.qr(np.random.default_rng(7).normal(size=(len(idf), width)))[0]
    for _ in range(rounds):
        basis = np.linalg.qr(turned(basis))[0]
    inner = basis.T @ turned(basis)
    _, turn = np.linalg.eigh((inner + inner.T) / 2)
    return np.rint((basis @ turn[:, ::-1])[:, :dimensions] * AXIS_UNIT) / AXIS_UNIT


def latent_vectors(rows: DataFrame, idf: np.ndarray, axes: np.ndarray) -> DataFrame:
    """``vector``: of every row that has one its latent vector of length one, in whole steps."""
    whole = np.rint(axes * AXIS_UNIT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, "counts"):
            places = word_vectors(block, idf) @ whole
            places = places[places.any(axis=1)]
            vectors = np.rint(unit(places) * LATENT_UNIT).astype("<i4")
            ends = np.arange(len(vectors) + 1) * (vectors.shape[1] * vectors.itemsize)
            yield pa.RecordBatch.from_arrays([_binary(vectors, ends)], names=["vector"])

    return rows.select("counts").mapInArrow(run, "vector binary")


def _likeness(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return vectors @ np.rint(centres.T * CENTRE_UNIT)


def _sums(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Per centre the number of vectors nearest to it (to the first of equally near ones) and their sum."""
    own = np.argmax(_likeness(vectors, centres), axis=1)
    is_own = (own[:, None] == np.arange(len(centres))).astype(np.float64)
    return np.column_stack([is_own.sum(axis=0), is_own.T @ vectors])


def _least_like(vectors: np.ndarray, centres: np.ndarray) -> tuple[int, bytes]:
    """The vector least like every centre, of several the first by its bytes, after its likeness."""
    likeness = _likeness(vectors, centres).max(axis=1)
    least = vectors[likeness == likeness.min()].astype("<i4")
    return int(likeness.min()), min(v.tobytes() for v in least)


def _clusters(
    sums: Callable[[np.ndarray], np.ndarray],
    least_like: Callable[[np.ndarray], tuple[int, bytes]],
    dimensions: int,
    k: int,
    rounds: int,
) -> np.ndarray:
    centres = unit(sums(np.zeros((1, dimensions)))[:, 1:].astype(np.float64))
    while len(centres) < k:
        likeness, vector = least_like(centres)
        if likeness > SAME * LATENT_UNIT * CENTRE_UNIT:
            break
        centres = np.concatenate([centres, unit(np.frombuffer(vector, "<i4").astype(np.float64)[None])])
    for _ in range(rounds):
        total = sums(centres)
        moved = np.where(total[:, :1] > 0, unit(total[:, 1:].astype(np.float64)), centres)
        if np.array_equal(moved, centres):
            break
        centres = moved
    return centres


def clusters(vectors: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """``k`` centres of unit vectors by cosine (fewer for fewer distinct ones), always the same ones.

    The first centre is the mean's direction, each further one starts at the vector least like those before.
    """
    whole = np.rint(vectors * LATENT_UNIT)
    return _clusters(lambda c: _sums(whole, c), lambda c: _least_like(whole, c), whole.shape[1], k, rounds)


def clusters_of_rows(latent: DataFrame, dimensions: int, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """``clusters`` of the rows of ``latent_vectors``, a job for each look at them."""

    def vectors(block: pa.Array) -> np.ndarray:
        return _bytes(block)[0].view("<i4").reshape(-1, dimensions).astype(np.float64)

    def sums(centres: np.ndarray) -> np.ndarray:
        return added(latent, "vector", (len(centres), 1 + dimensions), lambda block: _sums(vectors(block), centres))

    def least_like(centres: np.ndarray) -> tuple[int, bytes]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            least = min((_least_like(vectors(b), centres) for b in _blocks(batches, "vector")), default=None)
            if least:
                yield pa.RecordBatch.from_pylist([dict(zip(("likeness", "vector"), least))])

        found = latent.mapInArrow(run, "likeness bigint, vector binary")
        return tuple(found.agg(F.min(F.struct("likeness", "vector"))).first()[0])

    return _clusters(sums, least_like, dimensions, k, rounds)


def learn_topics(
    docs: DataFrame,
    topics: int = TOPICS,
    max_rows: int | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
) -> TopicModel | None:
    """Fit on all documents; None if no text has a word.

    Where ``max_rows`` is given, axes and clusters are those of so many rows, by a hash of identifier and text.
    """
    counts = word_counts(SIZE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [piece.column("code"), entries(counts(piece.column("text")))], names=["code", "counts"]
                )

    rows = documents(docs, doc_id, text).select(F.xxhash64("doc_id", "text").alias("code"), "text")
    rows = fitted(rows.mapInArrow(run, "code bigint, counts binary"), COUNTED_ROWS_PER_PARTITION)
    occurs, n, n_worded = frequencies(rows)
    idf = inverse_frequencies(occurs, n)
    if max_rows is not None:
        rows = checkpointed(rows.orderBy("code", "counts").limit(max_rows))
        n_worded = frequencies(rows)[2]
    if not n_worded:
        return None
    axes = leading_axes(rows, idf, n_worded, DIMENSIONS)
    latent = fitted(latent_vectors(rows, idf, axes))
    return TopicModel(idf, axes.astype(np.float32), clusters_of_rows(latent, axes.shape[1], topics))


def with_topics(
    docs: DataFrame, model: TopicModel | None, topic: str, n_words: str, text: str = "text"
) -> DataFrame:
    """The rows with their topic and number of words, as columns of these (unused) names.

    A null or empty text has topic ``none`` and no words, as has every text without a model.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField(topic, T.StringType()), T.StructField(n_words, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        counts = word_counts(SIZE)
        for batch in batches:
            for piece in pieces(batch, text):
                words = Words(piece.column(text)).counts.astype(np.int64)
                names = np.full(len(piece), NO_TOPIC, object)
                if model:
                    found = model.topics(counts(piece.column(text)))
                    names[words > 0] = [f"topic-{t}" for t in found[words > 0]]
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns, pa.array(names, pa.string()), pa.array(words)], names=schema.names
                )

    return docs.mapInArrow(run, schema)
