"""Quality by nearest-neighbour voting in a latent-semantic space.

Texts become TF-IDF vectors of shape n-grams, with document frequencies from all documents.
The leading singular vectors of a sample of at most ``max_rows`` labelled texts span the
latent space. The sample's vectors (their size is bounded by the parameter) are broadcast, and
each task computes the exact cosines of its documents with all of them, block by block. The
labels of the nearest neighbours vote, weighted by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagstream.functions.plan import quoted
from tagstream.llm.features import document_frequencies, inverse_frequencies, shape_counts, tf_idf
from tagstream.llm.runtime import documents, remainder, ship_package
from tagstream.llm.words import pieces

SIZE = 1 << 12
MAX_ROWS = 4000
DIMENSIONS = 48
NEIGHBOURS = 15
SHARPNESS = 4
KEEP_FROM = 0.3
# The score where there is nothing to learn from.
UNKNOWN = 0.5


@dataclass
class Model:
    idf: np.ndarray
    axes: np.ndarray  # features by dimensions
    vectors: np.ndarray  # labelled vectors of length one
    labels: np.ndarray

    def latent(self, counts: np.ndarray) -> np.ndarray:
        return unit(tf_idf(counts, self.idf) @ self.axes)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Share of label 1 among the nearest, weighted by the similarity; the base rate for no vector."""
        cosines = self.latent(counts) @ self.vectors.T
        near = nearest(cosines, min(NEIGHBOURS, len(self.labels)))
        weights = np.maximum(np.take_along_axis(cosines, near, 1), 0.0).astype(np.float64) ** SHARPNESS
        total = weights.sum(axis=1)
        votes = (weights * self.labels[near]).sum(axis=1)
        base = self.labels.mean()
        return np.clip(np.where(total > 0, votes / np.where(total > 0, total, 1), base), 0, 1)


def nearest(cosines: np.ndarray, k: int) -> np.ndarray:
    """Columns of the ``k`` largest values of each row; of equal ones the first."""
    least = -np.partition(-cosines, k - 1, axis=1)[:, k - 1 : k]
    more, equal = cosines > least, cosines == least
    wanted = k - more.sum(axis=1, keepdims=True)
    chosen = more | (equal & (np.cumsum(equal, axis=1, dtype=np.int32) <= wanted))
    return np.nonzero(chosen)[1].reshape(len(cosines), k)


def unit(vectors: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(length > 1e-9, length, 1)


def rows_of(column: pa.ChunkedArray, size: int) -> np.ndarray:
    """Rows of half-precision bytes as one matrix, without a second copy of all of them."""
    matrix = np.empty((len(column), size), np.float32)
    for i, row in enumerate(column):
        matrix[i] = np.frombuffer(row.as_buffer(), np.float16)
    return matrix


def leading_axes(matrix: np.ndarray, dimensions: int, rounds: int = 4) -> np.ndarray:
    """Leading right singular vectors by subspace iteration from a fixed start."""
    width = min(dimensions + 16, *matrix.shape)
    start = np.random.default_rng(7).normal(size=(matrix.shape[1], width)).astype(np.float32)
    basis = np.linalg.qr(start)[0]
    for _ in range(rounds):
        basis = np.linalg.qr(matrix.T @ (matrix @ basis))[0]
    _, _, right = np.linalg.svd(matrix @ basis, full_matrices=False)
    return (basis @ right.T)[:, :dimensions].astype(np.float32)


def _labelled(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """Texts of at most ``max_rows`` labelled documents, always the same ones."""
    ids = labels.groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.join(F.broadcast(ids), "doc_id").select("doc_id", "label", "text")
    # An identifier that repeats must not exceed the bound, nor leave the choice to chance.
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"), "text").limit(2 * max_rows)


def train(
    docs: DataFrame,
    labels: DataFrame,
    size: int = SIZE,
    max_rows: int = MAX_ROWS,
    dimensions: int = DIMENSIONS,
) -> Model | None:
    """Fit on ``docs`` (doc_id, text) and ``labels`` (doc_id, label); None if none of them meet."""
    counts = shape_counts(size)
    frequencies, n = document_frequencies(docs, counts, size)
    idf = inverse_frequencies(frequencies, n)
    # Features that no document has are zero in every vector, so they are left out of the fit.
    used = np.flatnonzero(frequencies) if frequencies.any() else np.arange(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                rows = tf_idf(counts(piece.column("text")), idf)[:, used].astype(np.float16)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), piece.column("label"), pa.array([r.tobytes() for r in rows], pa.binary())],
                    names=["doc_id", "label", "row"],
                )

    sample = _labelled(docs, labels, max_rows).mapInArrow(run, "doc_id bigint, label int, row binary").toArrow()
    if not len(sample):
        return None
    sample = sample.sort_by([("doc_id", "ascending"), ("row", "ascending")])
    labels, matrix = sample["label"].to_numpy().astype(np.float64), rows_of(sample["row"], len(used))
    own = leading_axes(matrix, dimensions)
    axes = np.zeros((size, own.shape[1]), np.float32)
    axes[used] = own
    return Model(idf, axes, unit(matrix @ own), labels)


def score(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``score`` per row."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        counts = shape_counts(len(model.idf)) if model else None
        for batch in batches:
            for piece in pieces(batch, "text"):
                scores = model.scores(counts(piece.column("text"))) if model else np.full(len(piece), UNKNOWN)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"]
                )

    return documents(docs, doc_id, text).mapInArrow(run, "doc_id bigint, score double")


def learn_quality(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 5,
    held_out: int = 0,
    max_rows: int = MAX_ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> Model | None:
    """Learn from the labelled rows outside the held-out fold.

    Labels without an identifier or a value are left out; of several labels of one document
    the mean decides, a tie for 1.
    """
    marked = labels.select(
        F.col(quoted(doc_id)).cast("bigint").alias("doc_id"), F.col(quoted(label)).alias("label")
    ).filter((remainder(F.col("doc_id"), folds) != held_out) & F.col("label").isNotNull())
    return train(documents(docs, doc_id, text), marked, max_rows=max_rows)


def classify(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 5,
    held_out: int = 0,
    keep_from: float = KEEP_FROM,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per document.

    A null or empty text has no vector and gets the labels' base rate; without any label every
    score is 0.5. Rows without an identifier are in no fold. Repeated rows are scored each, an empty
    table gives no rows. Of equally near neighbours the one of the smaller identifier votes. A very long text is
    counted in blocks, in memory that does not grow with it.
    """
    model = learn_quality(docs, labels, folds, held_out, max_rows)
    held = F.coalesce(remainder(F.col("doc_id"), folds) == held_out, F.lit(False))
    return score(docs, model).select(
        "doc_id",
        held.alias("held_out"),
        "score",
        (F.col("score") >= keep_from).cast("int").alias("predicted"),
    )


def good_documents(
    docs: DataFrame, model: Model | None, keep_from: float = KEEP_FROM, text: str = "text"
) -> DataFrame:
    """The documents not rejected, all their columns as they were.

    Null and empty texts are scored like any other (with the labels' base rate); without a model all
    stay. Repeated rows stay or go together; an empty table stays empty. Very long texts as in ``classify``.
    """
    ship_package(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        counts = shape_counts(len(model.idf)) if model else None
        for batch in batches:
            for piece in pieces(batch, text):
                if model:
                    good = model.scores(counts(piece.column(text))) >= keep_from
                    piece = piece.filter(pa.array(good))
                yield piece

    return docs.mapInArrow(run, docs.schema)
