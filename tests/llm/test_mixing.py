import random
from collections import defaultdict

import pytest

from tagstream.llm.mixing import DIMENSIONS, NONE, mix, probabilities, rake, sampled
from tests.llm.tables import DOCS, clashing


def slow_rake(cells, targets, rounds=500):
    """Weights by (source, lang, topic), by repeated scaling."""
    weights = {c: float(n) for c, n in cells.items()}
    for _ in range(rounds):
        for d, shares in enumerate(targets):
            held = defaultdict(float)
            for c, w in weights.items():
                held[c[d]] += w
            weights = {c: w * shares.get(c[d], 0) / held[c[d]] if held[c[d]] else 0 for c, w in weights.items()}
    return weights


def tempered(cells, d, power):
    held = defaultdict(float)
    for c, n in cells.items():
        held[c[d]] += n
    wish = {k: v**power for k, v in held.items()}
    return {k: v / sum(wish.values()) for k, v in wish.items() if v}


CELLS = {(s, la, t): (i * 37 % 11 + 1) * 10 for i, (s, la, t) in enumerate(
    (s, la, t) for s in "pqr" for la in "xy" for t in "tuv" if (s, t) != ("p", "v"))}


def slow_scale(cells, weights, rate):
    """Grow the scale until the expected tokens are enough."""
    scales = [i * sum(cells.values()) / 20_000 for i in range(1, 400_000)]
    low, high = 0, len(scales) - 1
    while low < high:
        middle = (low + high) // 2
        enough = sum(min(n, scales[middle] * weights[c]) for c, n in cells.items()) >= rate * sum(cells.values())
        low, high = (low, middle) if enough else (middle + 1, high)
    return scales[low]


def frame(spark, cells):
    return spark.createDataFrame([(*c, n) for c, n in cells.items()], "source string, lang string, topic string, tokens bigint")


def test_spark_rounds_agree_with_arrays(spark):
    def got(max_local):
        rows = rake(frame(spark, CELLS), max_rounds=3, max_local=max_local).collect()
        return {tuple(r[d] for d in DIMENSIONS): r.weight for r in rows}

    assert got(0) == pytest.approx(got(1000), rel=1e-9)


def test_calibration_of_many_cells(spark):
    cells = rake(frame(spark, CELLS))
    few, many = ({tuple(r[d] for d in DIMENSIONS): r.probability for r in probabilities(cells, 0.7, n, 25).collect()} for n in (1000, 0))
    assert few == pytest.approx(many, rel=1e-9)


@pytest.mark.parametrize("given", [None, {"source": {"p": 2, "q": 1, "r": 1}, "lang": {"x": 0.9, "y": 0.1}}])
def test_raking(spark, given):
    got = {tuple(r[d] for d in DIMENSIONS): r.weight for r in rake(frame(spark, CELLS), given).collect()}
    shares = [tempered(CELLS, d, p) for d, p in enumerate((0.5, 0.7, 0.8))]
    if given:
        shares[0], shares[1] = {"p": 0.5, "q": 0.25, "r": 0.25}, {"x": 0.9, "y": 0.1}
    want = slow_rake(CELLS, shares)
    assert got.keys() == want.keys()
    for c in want:
        assert got[c] == pytest.approx(want[c], rel=1e-4)
    for d, share in enumerate(shares):
        for value, s in share.items():
            assert sum(w for c, w in got.items() if c[d] == value) == pytest.approx(s, rel=1e-4)


def test_a_value_without_target_goes(spark):
    got = rake(frame(spark, CELLS), {"lang": {"x": 1.0, "zz": 3.0}}).collect()
    assert {r.lang for r in got if r.weight > 0} == {"x"}


def test_contradicting_targets_end(spark):
    cells = {("p", "x", "t"): 5, ("q", "y", "t"): 5}
    got = rake(frame(spark, cells), {"source": {"p": 0.9, "q": 0.1}, "lang": {"x": 0.1, "y": 0.9}}, max_rounds=5)
    assert sum(r.weight for r in got.collect()) == pytest.approx(1)


def rows(seed=3, n=1500):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        text = rng.choice(["w " * rng.randint(1, 60), "w " * 150, "a | b | c " * 9, "12 34 5 " * 9, "w " * 1200])
        out.append((i, text, rng.choice(["en", "en", "en", "de"]), rng.choice(["big"] * 6 + ["s1", "s2"]), 0))
    return out + [(n, None, "en", "big", 0), (n + 1, "", None, None, 0), (None, "w w", "de", None, 0), (n + 2, "x y z", None, "s1", 0), out[0], out[0]]


def test_mix(spark):
    own = rows()
    df = clashing(spark.createDataFrame(own, DOCS))
    got = mix(df).collect()
    assert len(got) == len(own)
    tokens, weight, share = defaultdict(int), {}, {}
    for r in got:
        c = (r.source, r.lang, r.topic)
        tokens[c] += r.n_tokens
        assert weight.setdefault(c, r.weight) == r.weight and share.setdefault(c, r.probability) == r.probability
    cells = {tuple(NONE if v is None else v for v in c): n for c, n in tokens.items()}
    want = slow_rake(cells, [tempered(cells, d, p) for d, p in enumerate((0.5, 0.7, 0.8))])
    scale = slow_scale(cells, want, 0.6)
    for c, n in tokens.items():
        key = tuple(NONE if v is None else v for v in c)
        assert weight[c] == pytest.approx(want[key], rel=1e-4, abs=1e-9)
        assert share[c] == pytest.approx(min(1, scale * want[key] / n) if n else 0, rel=1e-3, abs=1e-9)
    assert all(0 <= p <= 1 for p in share.values())
    expected = sum(r.n_tokens * r.probability for r in got)
    assert expected == pytest.approx(0.6 * sum(tokens.values()), rel=1e-6)
    assert {r.selected for r in got if r.doc_id == 0} in ({True}, {False})
    drawn = sum(r.n_tokens for r in got if r.selected)
    assert drawn == pytest.approx(expected, rel=0.1)
    kinds = {r.topic for r in got}
    assert "none" in kinds and 3 <= len(kinds) <= 9
    assert {r.topic for r in got if not r.n_tokens} == {"none"}


def test_sampled_keeps_columns_and_agrees(spark):
    df = clashing(spark.createDataFrame(rows(4), DOCS))
    kept = sampled(df)
    assert kept.columns == df.columns and kept.schema == df.schema
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((r.doc_id for r in mix(df).collect() if r.selected), key=str)


def test_given_topic_and_seed(spark):
    df = spark.createDataFrame(rows(5), DOCS).withColumnRenamed("n_chars", "kind")
    got = mix(df, topic="kind").collect()
    assert {r.topic for r in got} == {"0"}
    other = mix(df, topic="kind", seed=2).collect()
    assert sum(a.selected for a in got) != 0 and {r.doc_id for r in got if r.selected} != {r.doc_id for r in other if r.selected}


def test_empty(spark):
    df = spark.createDataFrame([], DOCS)
    assert mix(df).collect() == [] and sampled(df).collect() == []
    none = mix(spark.createDataFrame([(1, None, "en", "s", 0)], DOCS)).collect()
    assert [(r.probability, r.selected) for r in none] == [(0.0, False)]
