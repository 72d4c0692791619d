import numpy as np
import pytest

from tagstream.llm.nearest import hilbert_keys, search
from tests.llm.tables import clashing

IS_QUERY = "vec_id % 20 = 0"


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")


def brute(rows, k):
    """By identifier: the nearest of the given vectors (dict of identifier and vector)."""
    ids = sorted(rows)
    matrix = np.array([rows[i] for i in ids], np.float32).astype(float)
    out = {}
    for i, v in zip(ids, matrix):
        if i % 20 == 0:
            scores = matrix @ v
            order = [j for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
            out[i] = [(ids[j], scores[j]) for j in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        own = out.setdefault(r.query_id, [])
        own.append((r.vec_id, r.score))
        assert r.rank == len(own)
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("bits,size", [(1, 3), (3, 2), (2, 3), (2, 4)])
def test_hilbert_curve_visits_neighbours(bits, size):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * size, indexing="ij"), -1).reshape(-1, size)
    keys = hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_small_table_is_exact(spark):
    rng = np.random.default_rng(1)
    rows = {i: (rng.normal(size=8) * rng.choice([0.1, 1, 30])).astype(np.float32).tolist() for i in range(-40, 200)}
    same(found(search(clashing(frame(spark, [(i, v, 0) for i, v in rows.items()])), IS_QUERY, 20)), brute(rows, 20))


def test_copies_and_ties(spark):
    rng = np.random.default_rng(2)
    centre = [1.0, 0.5, 0.0, 0.25]
    rows = {i: centre if i % 3 else rng.normal(size=4).astype(np.float32).tolist() for i in range(300)}
    same(found(search(frame(spark, [(i, v, 0) for i, v in rows.items()]), IS_QUERY, 20)), brute(rows, 20))


def test_what_takes_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 0), (20, [0.0, 2.0], 0), (1, [1.0, 1.0], 0), (2, None, 0), (3, [0.0, 0.0], 0), (4, [nan, 1.0], 0),
            (5, [inf, 1.0], 0), (6, [None, 1.0], 0), (7, [], 0), (8, [1.0], 0), (None, [1.0, 5.0], 0), (40, None, 0),
            (1, [1.0, 1.0], 0), (1, [3.0, 3.0], None)]
    same(found(search(frame(spark, rows), IS_QUERY, 20)), brute({0: [1, 0], 20: [0, 2], 1: [1, 1]}, 20))
    assert found(search(frame(spark, rows[:1]), IS_QUERY, 20)) == {}
    assert search(frame(spark, []), IS_QUERY, 20).collect() == []
    assert search(frame(spark, rows[3:5]), IS_QUERY, 20).collect() == []


def test_recall_beyond_one_window(spark):
    rng = np.random.default_rng(3)
    rows = {i: v.tolist() for i, v in enumerate((rng.normal(size=(6000, 24)) + 2 * rng.normal(size=(1, 24))).astype(np.float32))}
    got = found(search(frame(spark, [(i, v, 0) for i, v in rows.items()]), IS_QUERY, 20))
    want = brute(rows, 20)
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want]
    assert np.mean(hits) / 20 >= 0.9


def test_salted_segments_agree(spark, monkeypatch):
    from tagstream.llm import nearest

    rng = np.random.default_rng(4)
    rows = frame(spark, [(i, v.tolist(), 0) for i, v in enumerate(rng.normal(size=(900, 6)))])
    whole = found(search(rows, IS_QUERY, 20))
    monkeypatch.setattr(nearest, "TASK_VECTORS", 50)
    assert found(search(rows, IS_QUERY, 20)) == whole


def test_many_neighbours(spark):
    rng = np.random.default_rng(5)
    rows = {i: rng.normal(size=6).astype(np.float32).tolist() for i in range(200)}
    same(found(search(frame(spark, [(i, v, 0) for i, v in rows.items()]), IS_QUERY, 120)), brute(rows, 120))


def test_more_neighbours_than_a_window_by_far(spark):
    rng = np.random.default_rng(6)
    rows = {i: v.tolist() for i, v in enumerate((rng.normal(size=(1200, 4)) + 3).astype(np.float32))}
    got = found(search(frame(spark, [(i, v, 0) for i, v in rows.items()]), IS_QUERY, 700))
    want = brute(rows, 700)
    assert all(len(got[q]) == 700 for q in want)
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want]) / 700 >= 0.9


def test_scores_that_differ_beyond_single_precision(spark):
    place = np.random.default_rng(7).permutation(300)
    rows = [(i, [1 + int(p) * 1e-10, 0.5, 0.25]) for i, p in enumerate(place)]
    rows += [(1000 + i, [0.01 * i, 0.1, 0.0]) for i in range(5)]
    got = found(search(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), IS_QUERY, 20))
    best = [int(i) for i in np.argsort(-place)]
    for q in got:
        if q < 300:
            assert [i for i, _ in got[q]] == [i for i in best if i != q][:20]
    assert len(got) == 16


def test_lengths_of_all_sizes(spark):
    rng = np.random.default_rng(8)
    rows = {i: (rng.normal(size=5) * 10.0 ** rng.integers(-12, 12)).astype(np.float32).tolist() for i in range(200)}
    got, want = found(search(frame(spark, [(i, v, 0) for i, v in rows.items()]), IS_QUERY, 20)), brute(rows, 20)
    assert {q: [i for i, _ in n] for q, n in got.items()} == {q: [i for i, _ in n] for q, n in want.items()}
