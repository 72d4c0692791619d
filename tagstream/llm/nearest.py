"""Approximate nearest neighbours by several shifted Hilbert orderings.

Vectors are put on a sphere (one more coordinate makes all lengths equal, which turns the
largest inner product into the smallest distance), turned by a random rotation per curve,
reduced to a few coordinates, spread evenly by their quantiles in a bounded sample, shifted,
and ordered along a Hilbert curve. Each ordering is range-partitioned into segments; a query
is sent to the segments around its own place and scored there against every vector. The best
of all windows are merged, and reranked with the original vectors in double precision.

Windows score in single precision and hand over bounds of the true score. A window, and all
windows of a query together, keep every vector whose upper bound reaches the lower bound of the
last one asked for: rounding loses none, however close the scores are, and k has no limit.

A window takes a fixed share of the ordering, not a fixed number of vectors: with vectors that
point in all directions, neighbours are hardly closer than others, and a window of fixed size
loses them as the table grows. Segments too large for one task are split by a hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagstream.functions.plan import quoted
from tagstream.llm.runtime import checkpointed, ship_package, shuffle_partitions

CURVES = 24
COORDINATES = 8
BITS = 5
# Segments an ordering has at most, of which a window takes the query's own and one to each side.
SEGMENTS = 60
LEAST_SEGMENT = 256
# Vectors that one task scores at a time, and that the quantiles are taken from.
TASK_VECTORS = 4096
SAMPLE = 8192
# Queries and windows merged by one task at a time.
TASK_MERGED = 1000
# Unit roundoff of single precision, with room for products of roundings; the least normal number.
ROUNDOFF = 1.01 * 2.0**-24
LEAST_NORMAL = 2.0**-126

_RESULT = "query_id bigint, rank int, vec_id bigint, score double"
_DATA, _QUERY = 0, 1


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of integer points (rows) with coordinates below ``2**bits``."""
    x = cells.astype(np.uint64).T.copy()
    one = np.uint64(1)
    for b in range(bits - 1, 0, -1):
        q, low = one << np.uint64(b), (one << np.uint64(b)) - one
        for i in range(len(x)):
            high = (x[i] & q) != 0
            # Where the bit is set the first coordinate is mirrored, else the two swap their lower bits.
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, 0, -1):
        q = one << np.uint64(b)
        flip ^= np.where((x[-1] & q) != 0, q - one, np.uint64(0))
    x ^= flip
    key = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, -1, -1):
        for row in x:
            key = (key << one) | ((row >> np.uint64(b)) & one)
    return key.astype(np.int64)


@dataclass
class Curve:
    axes: np.ndarray
    quantiles: np.ndarray
    shift: np.ndarray
    bits: int
    borders: np.ndarray

    def keys(self, points: np.ndarray) -> np.ndarray:
        projected = points @ self.axes
        cells = np.empty(projected.shape, np.int64)
        for j, own in enumerate(self.quantiles.T):
            even = np.searchsorted(own, projected[:, j]) / (len(own) + 1)
            cells[:, j] = (even + self.shift[j]) / 2 * (1 << self.bits)
        return hilbert_keys(np.minimum(cells, (1 << self.bits) - 1), self.bits)

    def segments(self, points: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.borders, self.keys(points), side="right")


def make_curve(seed: int, sample: np.ndarray, coordinates: int, bits: int, segments: int) -> Curve:
    """A curve of its own rotation and shift, cut into equal shares of the sample."""
    rng = np.random.default_rng(seed)
    size = sample.shape[1]
    axes = np.linalg.qr(rng.normal(size=(size, size)))[0][:, : min(coordinates, size)]
    projected = sample @ axes
    quantiles = np.quantile(projected, np.linspace(0, 1, 257)[1:-1], axis=0)
    curve = Curve(axes, quantiles, rng.random(axes.shape[1]), bits, np.zeros(0, np.int64))
    keys = np.sort(curve.keys(sample))
    curve.borders = keys[[len(keys) * s // segments for s in range(1, segments)]]
    return curve


def on_sphere(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length at most one with the coordinate that completes them to one."""
    rest = np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", vectors, vectors)))
    return np.column_stack([vectors, rest])


def directions(vectors: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.column_stack([vectors / np.where(length > 0, length, 1), np.zeros(len(vectors))])


def usable_vectors(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, v`` of the vectors that take part, one per identifier.

    Left out are null identifiers, vectors that are null, zero or hold a null or non-finite
    component, and those whose length is not the most frequent one (the larger on a tie). Of
    several vectors of one identifier the smallest counts.
    """
    rows = df.select(
        F.col(quoted(vec_id)).cast("bigint").alias("vec_id"),
        F.col(quoted(vector)).cast("array<double>").alias("v"),
    )
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("size")).count()
    usual = sizes.agg(F.max(F.struct("count", "size"))["size"]).first()[0]
    if usual is None:
        return rows
    return rows.filter(F.size("v") == usual).groupBy("vec_id").agg(F.min("v").alias("v"))


def distinct_vectors(rows: DataFrame, least: int) -> DataFrame:
    """``g, v, ids``: each vector once, with its ``least`` smallest identifiers; g is the smallest.

    Equal vectors, however many, become one; their identifiers are reduced in two steps, so
    that no list grows with the number of copies.
    """
    salts = max(16, rows.count() // 100_000)
    first = rows.groupBy("v", F.pmod(F.xxhash64("vec_id"), F.lit(salts)).alias("salt")).agg(
        F.slice(F.sort_array(F.collect_list("vec_id")), 1, least).alias("ids")
    )
    ids = F.slice(F.sort_array(F.flatten(F.collect_list("ids"))), 1, least)
    return first.groupBy("v").agg(ids.alias("ids")).select(F.element_at("ids", 1).alias("g"), "v", "ids")


def _to_matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def _in_segments(curves: list[Curve], scale: float, n_segments: int, salts: int):
    """Every vector to its segment of every curve; a query to its window of segments, all salts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            vectors = _to_matrix(batch.column("v")) / scale
            ids = batch.column("g").to_numpy()
            asks = batch.column("asks").to_numpy(zero_copy_only=False).astype(bool)
            packed = [r.tobytes() for r in vectors.astype(np.float32)]
            points, queries = on_sphere(vectors), directions(vectors[asks])
            for c, curve in enumerate(curves):
                own = curve.segments(points)
                yield _rows(c, own, ids % salts, _DATA, ids, packed)
                if not len(queries):
                    continue
                middle = curve.segments(queries)
                # Of length one, so that all scores of a query have errors in proportion to the vectors.
                asked = [r.tobytes() for r in queries[:, :-1].astype(np.float32)]
                for step in (-1, 0, 1):
                    at = middle + step
                    inside = np.flatnonzero((at >= 0) & (at < n_segments))
                    for salt in range(salts):
                        yield _rows(
                            c, at[inside], np.full(len(inside), salt), _QUERY, ids[asks][inside],
                            [asked[i] for i in inside],
                        )

    return run


def _rows(curve: int, segment, salt, role: int, g, packed) -> pa.RecordBatch:
    n = len(g)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, curve), pa.int32()),
            pa.array(segment, pa.int32()),
            pa.array(salt, pa.int32()),
            pa.array(np.full(n, role), pa.int32()),
            pa.array(g, pa.int64()),
            pa.array(packed, pa.binary()),
        ],
        names=["curve", "segment", "salt", "role", "g", "v"],
    )


def _score_window(kept: int):
    """Of a window's queries the vectors that may be among the ``kept`` best, with bounds of their scores."""

    def run(table: pa.Table) -> pa.Table:
        role = table["role"].to_numpy()
        ids = table["g"].to_numpy()
        vectors = np.stack([np.frombuffer(v.as_buffer(), np.float32) for v in table["v"]])
        data, own = vectors[role == _DATA], ids[role == _DATA]
        queries, asking = vectors[role == _QUERY], ids[role == _QUERY]
        if not len(data):
            queries, asking = queries[:0], asking[:0]
        # Rounding of both vectors and of the sum, and what is lost below the least normal number.
        size = data.shape[1]
        error = ROUNDOFF * (size + 4) * np.linalg.norm(data.astype(np.float64), axis=1) + 2 * size * LEAST_NORMAL
        counts, near, low, high = [], [], [], []
        for i in range(0, len(queries), 256):
            block = (queries[i : i + 256] @ data.T).astype(np.float64)
            least = block - error
            last = max(0, len(data) - kept)
            reached = block + error >= np.partition(least, last, axis=1)[:, last, None]
            counts.extend(reached.sum(axis=1))
            near.append(own[np.nonzero(reached)[1]])
            low.append(least[reached])
            high.append((block + error)[reached])
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
        none = [np.zeros(0)]
        lists = [
            pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x + none), kind))
            for x, kind in ((low, pa.float64()), (high, pa.float64()))
        ]
        found = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(near + [own[:0]]), pa.int64()))
        return pa.table([pa.array(asking, pa.int64()), found, *lists], names=["q", "g", "low", "high"])

    return run


def _merge_windows(kept: int):
    """Of the queries' windows the vectors that may be among the ``kept`` best of all, each once."""

    def run(table: pa.Table) -> pa.Table:
        column = {c: table[c].combine_chunks() for c in ("g", "low", "high")}
        q = np.repeat(table["q"].to_numpy(), column["g"].value_lengths().to_numpy())
        g, low, high = (column[c].flatten().to_numpy() for c in ("g", "low", "high"))
        order = np.lexsort((g, q))
        q, g = q[order], g[order]
        first = np.flatnonzero(np.concatenate([[True], (q[1:] != q[:-1]) | (g[1:] != g[:-1])])[: len(q)])
        # Each window's bounds hold, so the closest of them do.
        low, high = np.maximum.reduceat(low[order], first), np.minimum.reduceat(high[order], first)
        q, g = q[first], g[first]
        begin = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
        sizes = np.diff(np.append(begin, len(q)))
        falling = low[np.lexsort((-low, q))]
        reached = high >= np.repeat(falling[begin + np.minimum(sizes, kept) - 1], sizes)
        return pa.table([pa.array(q[reached], pa.int64()), pa.array(g[reached], pa.int64())], names=["q", "g"])

    return run


def search(
    df: DataFrame,
    is_query: Column | str,
    k: int,
    curves: int = CURVES,
    coordinates: int = COORDINATES,
    bits: int = BITS,
    segments: int = SEGMENTS,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found of each query, nearest first.

    ``is_query`` is a condition on ``vec_id``. Nearest is the largest inner product; ties go to
    the smaller identifier; a query is no candidate of its own. Equal vectors are indexed once,
    so copies of one vector, however many, cost nothing and hide nothing. An empty table gives
    an empty result, fewer candidates than k in a query's windows give them all; no other limit
    holds for k.
    """
    ship_package(df.sparkSession)
    rows = checkpointed(usable_vectors(df, vec_id, vector))
    distinct = checkpointed(distinct_vectors(rows, k + 1))
    n, largest = distinct.agg(
        F.count(F.lit(1)), F.max(F.array_max(F.transform("v", lambda x: F.abs(x))))
    ).first()
    if not n:
        return df.sparkSession.createDataFrame([], _RESULT)
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + (x / largest) * (x / largest))
    scale = largest * distinct.agg(F.sqrt(F.max(squares))).first()[0] * (1 + 1e-9)
    sample = _to_matrix(
        distinct.orderBy(F.xxhash64("g")).limit(SAMPLE).select("v").toArrow()["v"].combine_chunks()
    )
    n_segments = max(1, min(segments, n // LEAST_SEGMENT))
    sphere = on_sphere(sample / scale)
    made = [make_curve(c, sphere, coordinates, bits, n_segments) for c in range(curves)]
    salts = max(1, n // n_segments // TASK_VECTORS)

    asking = rows.filter(is_query).join(distinct.select("g", "v"), "v").select("vec_id", "g")
    asked = asking.select("g").distinct().withColumn("asks", F.lit(True))
    points = distinct.join(asked, "g", "left").select("g", "v", F.coalesce("asks", F.lit(False)).alias("asks"))
    placed = points.mapInArrow(
        _in_segments(made, scale, n_segments, salts),
        "curve int, segment int, salt int, role int, g bigint, v binary",
    )
    windows = placed.groupBy("curve", "segment", "salt").applyInArrow(
        _score_window(k + 1), "q bigint, g array<bigint>, low array<double>, high array<double>"
    )
    buckets = max(shuffle_partitions(df.sparkSession), n * salts // TASK_MERGED)
    bucket = F.pmod(F.xxhash64("q"), F.lit(buckets)).cast("int")
    merged = windows.withColumn("bucket", bucket).groupBy("bucket")
    pairs = merged.applyInArrow(_merge_windows(k + 1), "q bigint, g bigint")
    pairs = pairs.join(distinct, "g").select("q", "v", "ids")
    pairs = pairs.join(distinct.select(F.col("g").alias("q"), F.col("v").alias("w")), "q")
    product = F.aggregate(F.zip_with("v", "w", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    scored = pairs.select("q", "ids", product.alias("score")).select(
        "q", F.explode("ids").alias("vec_id"), (-F.col("score")).alias("away")
    )
    nearest = scored.groupBy("q").agg(
        F.slice(F.sort_array(F.collect_list(F.struct("away", "vec_id"))), 1, k + 1).alias("near")
    )
    answers = asking.select(F.col("vec_id").alias("query_id"), F.col("g").alias("q")).join(nearest, "q")
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return answers.select("query_id", F.posexplode(others).alias("place", "x")).select(
        "query_id",
        (F.col("place") + 1).cast("int").alias("rank"),
        F.col("x.vec_id").alias("vec_id"),
        (-F.col("x.away")).alias("score"),
    )
