"""Language identification: multinomial logistic regression on TF-IDF character n-grams.

Document frequencies come from all learnable documents. The weights are fitted on a sample of
at most ``max_rows`` of them, equally many per language where there are so many, by
follow-the-regularised-leader with an elastic-net penalty (so most weights are exactly zero),
and then calibrated by one temperature on a fifth of the sample kept apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagstream.functions.plan import quoted
from tagstream.llm.features import (
    character_counts,
    document_frequencies,
    has_letter,
    inverse_frequencies,
    tf_idf,
)
from tagstream.llm.runtime import documents, remainder, ship_package
from tagstream.llm.words import pieces

SIZE = 1 << 14
MAX_ROWS = 4000
UNDETERMINED = "und"
_RESULT = "doc_id bigint, lang_pred string, score double"


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # features and a constant, by language
    temperature: float

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        logits = tf_idf(counts, self.idf) @ self.weights[:-1] + self.weights[-1]
        return softmax(logits / self.temperature)


def softmax(logits: np.ndarray) -> np.ndarray:
    powers = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return powers / powers.sum(axis=-1, keepdims=True)


class Ftrl:
    """Per-coordinate follow-the-regularised-leader (proximal), one class per column."""

    def __init__(self, features: int, classes: int, alpha=1.0, beta=1.0, l1=0.02, l2=0.001):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((features, classes))
        self.n = np.zeros((features, classes))

    def weights(self, rows=slice(None)) -> np.ndarray:
        z, n = self.z[rows], self.n[rows]
        step = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / step)

    def learn(self, features: np.ndarray, values: np.ndarray, label: int) -> None:
        weights = self.weights(features)
        error = softmax(values @ weights)
        error[label] -= 1
        gradient = values[:, None] * error
        n = self.n[features]
        grown = n + gradient**2
        self.z[features] += gradient - (np.sqrt(grown) - np.sqrt(n)) / self.alpha * weights
        self.n[features] = grown


def best_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The one of a fine grid that makes the held-out labels likeliest."""
    if not len(labels):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.02), np.log(20), 140))
    losses = [
        -np.log(np.maximum(softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean() for t in grid
    ]
    return float(grid[int(np.argmin(losses))])


def _sample(learnable: DataFrame, max_rows: int) -> DataFrame:
    """At most about ``max_rows`` rows, equally many per language where there are so many; always the same."""
    # As many rows as the model will have languages, which the driver holds anyway.
    counts = learnable.groupBy("lang").count().collect()
    shares = [(lang, max_rows / len(counts) / n) for lang, n in counts]
    known = learnable.sparkSession.createDataFrame(shares, "lang string, share double")
    place = (F.xxhash64("doc_id").bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))).alias("place")
    chosen = learnable.join(F.broadcast(known), "lang")
    chosen = chosen.withColumn("place", place).filter("place < share").drop("share")
    # Only identifiers that repeat can exceed the bound; which of their rows stay is not left to chance.
    return chosen.orderBy("place", "lang", F.xxhash64("text"), "text").limit(2 * max_rows)


def _sparse(size: int):
    counts = character_counts(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                matrix = counts(piece.column("text"))
                used = [np.flatnonzero(row).astype(np.int32) for row in matrix]
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("lang"),
                        piece.column("place"),
                        pa.array(used, pa.list_(pa.int32())),
                        pa.array([row[u] for row, u in zip(matrix, used)], pa.list_(pa.float32())),
                    ],
                    names=["lang", "place", "features", "counts"],
                )

    return run


def train(learnable: DataFrame, size: int = SIZE, max_rows: int = MAX_ROWS, epochs: int = 3) -> Model | None:
    """Fit on rows ``doc_id, text, lang``; None if there are none."""
    frequencies, n = document_frequencies(learnable, character_counts(size), size)
    idf = inverse_frequencies(frequencies, n)
    sample = _sample(learnable, max_rows).mapInArrow(
        _sparse(size), "lang string, place double, features array<int>, counts array<float>"
    ).toArrow().sort_by([("place", "ascending"), ("lang", "ascending")])
    if not len(sample):
        return None
    languages = sorted(set(sample["lang"].to_pylist()))
    labels = np.array([languages.index(x) for x in sample["lang"].to_pylist()])
    rows = []
    for features, counts in zip(sample["features"], sample["counts"]):
        f = features.values.to_numpy()
        values = np.log1p(counts.values.to_numpy()) * idf[f]
        values = values / max(np.sqrt(values @ values), 1e-12)
        rows.append((np.append(f, size), np.append(values, 1.0)))
    kept = np.arange(len(rows)) % 5 == 4
    ftrl = Ftrl(size + 1, len(languages))
    for _ in range(epochs):
        for i in np.flatnonzero(~kept):
            ftrl.learn(*rows[i], labels[i])
    weights = ftrl.weights()
    logits = np.array([values @ weights[f] for f, values in (rows[i] for i in np.flatnonzero(kept))])
    temperature = best_temperature(logits, labels[kept])
    return Model(languages, idf, weights.astype(np.float32), temperature)


def predict(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` per row; ``und`` and 0 where the text has no letter."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        count = character_counts(len(model.idf)) if model else None
        for batch in batches:
            for piece in pieces(batch, "text"):
                texts = piece.column("text")
                names = [UNDETERMINED] * len(piece)
                scores = np.zeros(len(piece))
                if model:
                    p = model.probabilities(count(texts))
                    letters = [has_letter(t) for t in texts.to_pylist()]
                    best = p.argmax(axis=1)
                    names = [model.languages[b] if ok else UNDETERMINED for b, ok in zip(best, letters)]
                    scores = np.where(letters, p.max(axis=1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=["doc_id", "lang_pred", "score"],
                )

    return documents(docs, doc_id, text).mapInArrow(run, _RESULT)


def identify(
    docs: DataFrame,
    folds: int = 4,
    held_out: int = 2,
    max_rows: int = MAX_ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """Learn from the documents outside the held-out fold, predict all of them.

    A null or letterless text gives ``und`` and score 0, and so does every text if nothing can
    be learned. Rows without an identifier are in no fold: they are predicted and not learned
    from, as are rows without a language. Repeated rows are predicted each, an empty table gives no
    rows. Of equally likely languages the first by name is taken. A very long text is counted in
    blocks, in a few times its own size.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(
        F.col(quoted(doc_id)).cast("bigint").alias("doc_id"),
        F.col(quoted(text)).alias("text"),
        F.col(quoted(lang)).alias("lang"),
    )
    fold = remainder(F.col("doc_id"), folds)
    learnable = rows.filter((fold != held_out) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    held = F.coalesce(fold == held_out, F.lit(False)).alias("held_out")
    return predict(rows, train(learnable, max_rows=max_rows)).select("doc_id", held, "lang_pred", "score")
