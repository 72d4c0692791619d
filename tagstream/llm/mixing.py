"""Mixing sources, languages and topics to target shares of tokens.

The corpus is reduced to cells (source, language, topic) with their tokens. Iterative
proportional fitting rakes the cells' weights in turn to each of the three target marginals
until none changes them any more. A document's probability is proportional to its cell's
weight per token and calibrated to the size of the sample wanted: its expected shares are the
targets, as far as the cells that must give all they have allow. Documents are drawn by a hash
of their identity, so that the same documents are drawn again on any cluster.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagstream.functions.plan import quoted
from tagstream.llm.runtime import checkpointed, unused_name
from tagstream.llm.topics import TopicModel, learn_topics, with_topics

DIMENSIONS = ("source", "lang", "topic")
# Without given targets the shares are raised to these powers: below 1 the large ones are damped.
TEMPERS = {"source": 0.5, "lang": 0.7, "topic": 0.8}
# Share of the tokens that the expected sample holds.
RATE = 0.6
TOLERANCE = 1e-6
MAX_ROUNDS = 200
MAX_LOCAL_CELLS = 100_000
MAX_BROADCAST_CELLS = 100_000
NONE = "\u0000"
WORD = r"[^\x20\x09-\x0D]+"

Targets = Mapping[str, Mapping[str | None, float]]


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def described(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    topic: str | None = None,
    model: TopicModel | None = None,
) -> DataFrame:
    """``doc_id, text_hash, source, lang, topic, n_tokens`` per row, and the row itself as ``whole``.

    Nulls are values of their own. Without a topic column each text has the topic that the model gives it.
    """

    def value(name: str) -> Column:
        return F.coalesce(F.col(f"whole.{quoted(name)}").cast("string"), F.lit(NONE))

    body = F.col(f"whole.{quoted(text)}").cast("string")
    whole = F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("whole")
    if topic:
        rows = docs.select(whole).withColumns({"topic": value(topic), "n_tokens": n_words(body)})
    else:
        own, words = unused_name(docs, "own_topic"), unused_name(docs, "own_words")
        rows = with_topics(docs, model, own, words, text)
        rows = rows.select(whole, F.col(own).alias("topic"), F.col(words).alias("n_tokens"))
    return rows.select(
        "whole",
        F.col(f"whole.{quoted(doc_id)}").cast("bigint").alias("doc_id"),
        F.xxhash64(body).alias("text_hash"),
        value(source).alias("source"),
        value(lang).alias("lang"),
        "topic",
        "n_tokens",
    )


def target_shares(cells: DataFrame, targets: Targets | None) -> dict[str, DataFrame]:
    """Per dimension ``value, share`` with shares of sum 1, over the values that hold tokens."""
    out = {}
    for d in DIMENSIONS:
        held = cells.groupBy(F.col(d).alias("value")).agg(F.sum("tokens").alias("tokens"))
        if targets and d in targets:
            given = [(NONE if k is None else k, float(v)) for k, v in targets[d].items()]
            wanted = cells.sparkSession.createDataFrame(given, "value string, wish double")
            shares = held.join(wanted, "value")
        else:
            shares = held.withColumn("wish", F.pow(F.col("tokens").cast("double"), F.lit(TEMPERS[d])))
        total = shares.agg(F.sum("wish")).first()[0]
        out[d] = checkpointed(shares.select("value", (F.col("wish") / (total or 1.0)).alias("share")))
    return out


def rake(
    cells: DataFrame,
    targets: Targets | None = None,
    tolerance: float = TOLERANCE,
    max_rounds: int = MAX_ROUNDS,
    max_local: int = MAX_LOCAL_CELLS,
) -> DataFrame:
    """``source, lang, topic, tokens, weight``: weights of sum 1 with the target marginals.

    Cells are counts by category; where they are counted to be few they are raked as arrays,
    else by Spark, with the same result. A value without a target gets weight 0. Targets that
    contradict each other (a source of one language only, say) end after ``max_rounds`` with
    the last dimension satisfied.
    """
    shares = target_shares(cells, targets)
    if cells.count() <= max_local:
        return _raked_arrays(cells, shares, tolerance, max_rounds)
    return _raked_rows(cells, shares, tolerance, max_rounds)


def _raked_arrays(
    cells: DataFrame, shares: dict[str, DataFrame], tolerance: float, max_rounds: int
) -> DataFrame:
    held = cells.select(*DIMENSIONS, "tokens").toPandas()
    weight = held["tokens"].to_numpy(dtype=float)
    marginals = []
    for d in DIMENSIONS:
        codes, values = pd.factorize(held[d])
        wanted = {r.value: r.share for r in shares[d].collect()}
        marginals.append((codes, np.array([wanted.get(v) or 0.0 for v in values])))
    for _ in range(max_rounds if len(held) else 0):
        change = 0.0
        for codes, wanted in marginals:
            sums = np.bincount(codes, weight, len(wanted))
            ratio = np.divide(wanted, sums, out=np.zeros_like(sums), where=sums > 0)[codes]
            change = max(change, np.abs(ratio - 1)[weight > 0].max(initial=0.0))
            weight = weight * ratio
        if change <= tolerance:
            break
    schema = "source string, lang string, topic string, tokens bigint, weight double"
    return cells.sparkSession.createDataFrame(held.assign(weight=weight), schema)


def _raked_rows(
    cells: DataFrame, shares: dict[str, DataFrame], tolerance: float, max_rounds: int
) -> DataFrame:
    """A round is a sum per value and a join for each dimension, then a checkpoint."""
    current = cells.withColumn("weight", F.col("tokens").cast("double"))
    for _ in range(max_rounds):
        current = current.withColumn("change", F.lit(0.0))
        for d in DIMENSIONS:
            held = current.groupBy(F.col(d).alias("value")).agg(F.sum("weight").alias("held"))
            ratio = held.join(shares[d], "value", "left").select(
                F.col("value").alias(d),
                F.when(F.col("held") > 0, F.coalesce("share", F.lit(0.0)) / F.col("held")).otherwise(0.0).alias("ratio"),
            )
            changed = F.when(F.col("weight") > 0, F.abs(F.col("ratio") - 1)).otherwise(0.0)
            current = current.join(ratio, d).select(
                *DIMENSIONS, "tokens",
                F.greatest("change", changed).alias("change"),
                (F.col("weight") * F.col("ratio")).alias("weight"),
            )
        current = checkpointed(current)
        largest = current.agg(F.max("change")).first()[0]
        if largest is None or largest <= tolerance:
            break
    return current.drop("change")


def probabilities(
    cells: DataFrame, rate: float = RATE, max_local: int = MAX_LOCAL_CELLS, steps: int = 60
) -> DataFrame:
    """Add ``probability``: proportional to the weight per token, 1 at most, 0 without tokens.

    Calibrated by bisection so that the expected sample holds ``rate`` of the tokens of all
    cells that have a weight. A cell that should give more than it has gives all.
    """
    held = cells.filter("weight > 0 AND tokens > 0").select("tokens", "weight")
    n, total, high = held.agg(
        F.count(F.lit(1)), F.sum("tokens"), F.max(F.col("tokens") / F.col("weight"))
    ).first()
    if n <= max_local:
        local = held.toPandas()
        tokens, weight = local["tokens"].to_numpy(dtype=float), local["weight"].to_numpy(dtype=float)

    def expected(scale: float) -> float:
        if n <= max_local:
            return float(np.minimum(tokens, scale * weight).sum())
        return held.agg(F.sum(F.least("tokens", scale * F.col("weight")))).first()[0]

    low, high = 0.0, high or 0.0
    for _ in range(steps if n else 0):
        middle = (low + high) / 2
        low, high = (middle, high) if expected(middle) < rate * total else (low, middle)
    share = F.least(F.lit(high) * F.col("weight") / F.col("tokens"), F.lit(1.0))
    return cells.withColumn("probability", F.when(F.col("tokens") > 0, share).otherwise(0.0))


def draw(seed: int) -> Column:
    """A number in [0, 1) that depends on the document and the seed alone."""
    code = F.call_function("shiftrightunsigned", F.xxhash64("doc_id", "text_hash", F.lit(seed)), F.lit(11))
    return code / F.lit(float(1 << 53))


def fitted(rows: DataFrame, targets: Targets | None, rate: float) -> DataFrame:
    """Weight and probability of every cell; to be broadcast only where they are counted few."""
    cells = checkpointed(rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens")))
    found = probabilities(rake(cells, targets), rate).drop("tokens")
    return F.broadcast(found) if cells.count() <= MAX_BROADCAST_CELLS else found


def _model(docs: DataFrame, columns: Mapping[str, str]) -> TopicModel | None:
    """What gives a table without a topic column its topics."""
    if columns.get("topic"):
        return None
    return learn_topics(docs, doc_id=columns.get("doc_id", "doc_id"), text=columns.get("text", "text"))


def mix(
    docs: DataFrame, targets: Targets | None = None, rate: float = RATE, seed: int = 1, **columns: str
) -> DataFrame:
    """``doc_id, source, lang, topic, n_tokens, weight, probability, selected`` per row.

    Tokens are words between blanks. A null source, language or topic is a value like any
    other (and comes back null); a null text has no tokens. A cell without tokens has
    probability 0. Repeated rows share their draw. An empty table gives an empty result. A
    very long text is looked at in blocks. ``columns`` name the table's columns where they
    differ (see ``described``); topics are learned from the texts unless a column holds them.
    """
    rows = checkpointed(described(docs, **columns, model=_model(docs, columns)).drop("whole"))
    return rows.join(fitted(rows, targets, rate), list(DIMENSIONS)).select(
        "doc_id",
        *[F.nullif(F.col(d), F.lit(NONE)).alias(d) for d in DIMENSIONS],
        "n_tokens",
        "weight",
        "probability",
        (draw(seed) < F.col("probability")).alias("selected"),
    )


def sampled(
    docs: DataFrame, targets: Targets | None = None, rate: float = RATE, seed: int = 1, **columns: str
) -> DataFrame:
    """The documents that ``mix`` selects, all their columns as they were.

    Nulls, empty and very long texts and repeated rows as in ``mix``: a document without tokens is never
    selected, rows that repeat identifier and text are selected together; an empty table stays empty.
    """
    rows = described(docs, **columns, model=_model(docs, columns))
    cells = fitted(rows, targets, rate)
    chosen = rows.join(cells, list(DIMENSIONS)).filter(draw(seed) < F.col("probability"))
    return chosen.select("whole.*")
