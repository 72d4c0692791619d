import math
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tagstream.llm import features, language_id, quality
from tagstream.llm.features import character_counts, document_frequencies, shape_counts
from tagstream.llm.language_id import Ftrl, best_temperature, identify, softmax
from tagstream.llm.quality import classify, good_documents, leading_axes, learn_quality
from tests.llm.tables import clashing, docs

ALPHABETS = {"aa": "abcdefgh", "bb": "hijklmnop", "cc": "pqrstuvwxyzç"}


def sentence(rng, letters, n=40):
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(n))


def languages(spark, n=200):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(ALPHABETS))
        rows.append((i, sentence(rng, ALPHABETS[lang]), lang))
    rows += [(n, None, "aa"), (n + 1, "", "bb"), (n + 2, "12 !!", "cc"), (None, rows[0][1], "bb"), (n + 3, "abc " * 40_000, None)]
    rows += [rows[1], rows[1]]
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


def test_languages(spark):
    rows, frame = languages(spark)
    got = identify(clashing(frame)).collect()
    assert len(got) == len(rows)
    truth = {i: (t, lang) for i, t, lang in rows}
    for r in got:
        text, lang = truth[r.doc_id]
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
        if not any(map(str.isalpha, text or "")):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id is not None and r.doc_id < 200 and r.held_out:
            assert r.lang_pred == lang and r.score > 0.5
    assert {r.lang_pred for r in got if r.doc_id == 203} == {"aa"}


def test_labels_of_the_held_out_fold_and_other_columns_are_not_used(spark):
    rows, frame = languages(spark)
    lie = lambda i, lang: "zz" if i is None or zlib.crc32(str(i).encode()) % 4 == 2 else lang
    changed = spark.createDataFrame([(i, t, lie(i, lang)) for i, t, lang in rows], frame.schema)
    key = lambda df: sorted(((r.doc_id, r.lang_pred, r.score) for r in identify(df).collect()), key=str)
    assert key(changed) == key(frame)


def test_nothing_to_learn(spark):
    frame = spark.createDataFrame([(1, "abc", None), (None, "abc", "aa")], "doc_id bigint, text string, lang string")
    assert {(r.lang_pred, r.score) for r in identify(frame).collect()} == {("und", 0.0)}
    assert identify(frame.limit(0)).collect() == []


def test_sample_is_bounded(spark):
    rows, frame = languages(spark)
    assert language_id._sample(frame.filter("lang is not null"), 60).count() < 110


def test_ftrl_is_sparse_and_learns():
    rng = np.random.default_rng(0)
    ftrl = Ftrl(50, 2, l1=0.5)
    for _ in range(400):
        label = int(rng.integers(2))
        ftrl.learn(np.array([label, 10 + int(rng.integers(40))]), np.array([1.0, 0.3]), label)
    weights = ftrl.weights()
    assert weights[0, 0] > 0 > weights[0, 1] and weights[1, 1] > 0
    assert (weights[10:] == 0).mean() > 0.5


def test_temperature():
    rng = np.random.default_rng(1)
    logits = rng.normal(size=(4000, 3))
    labels = np.array([rng.choice(3, p=softmax(x)) for x in logits])
    assert 0.8 < best_temperature(logits, labels) < 1.25
    assert 4 < best_temperature(logits * 5, labels) < 6.3


def junk(rng):
    return rng.choice([
        lambda: " ".join([f"W{rng.randint(0, 9)}x"] * 60),
        lambda: sentence(rng, "ABCDEFGH").replace(" ", "!! "),
        lambda: sentence(rng, "abcdefgh").replace(" ", "### "),
    ])()


def marked(spark, n=300):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.8
        rows.append((i, ". ".join(sentence(rng, "abcdefgh", 9).capitalize() for _ in range(6)) if good else junk(rng)))
        labels.append((i, int(good)))
    rows += [(n, None), (n + 1, ""), (None, rows[0][1]), rows[0], (n + 2, "Good words here. " * 9000)]
    labels += [(None, 0), (n + 2, None), (0, labels[0][1]), (9999, 1)]
    return rows, labels


def frames(spark, rows, labels):
    return docs(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int")


def test_quality(spark):
    rows, labels = marked(spark)
    documents, own = frames(spark, rows, labels)
    truth = {i: q for i, q in labels if i is not None and i < 300}
    got = classify(clashing(documents), own).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    wrong = [r.doc_id for r in got if r.held_out and r.doc_id in truth and r.predicted != truth[r.doc_id]]
    assert len(wrong) <= 1
    base = {r.score for r in got if r.doc_id in (300, 301)}
    assert len(base) == 1 and 0.6 < base.pop() < 0.95


def test_held_out_labels_are_not_used(spark):
    rows, labels = marked(spark)
    lie = [(i, 1 - q if i is not None and q is not None and zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in labels]
    key = lambda ls: sorted(((r.doc_id, r.score) for r in classify(*frames(spark, rows, ls)).collect()), key=str)
    assert key(lie) == key(labels)


def test_good_documents_keep_their_columns(spark):
    rows, labels = marked(spark)
    documents, own = frames(spark, rows, labels)
    documents = clashing(documents)
    model = learn_quality(documents, own)
    kept = good_documents(documents, model)
    assert kept.columns == documents.columns
    want = {r.doc_id for r in classify(documents, own).collect() if r.predicted}
    assert {r.doc_id for r in kept.collect()} == want
    assert good_documents(documents, None).count() == len(rows)


def test_no_labels_and_one_label(spark):
    documents, none = frames(spark, [(1, "a b"), (2, None)], [])
    assert {r.score for r in classify(documents, none).collect()} == {0.5}
    documents, one = frames(spark, [(1, "a b c"), (2, "d")], [(1, 0), (2, 0)])
    assert {r.predicted for r in classify(documents, one).collect()} == {0}
    assert classify(documents.limit(0), one).collect() == []
    documents, own = frames(spark, [(1, ""), (2, None), (3, "")], [(1, 0), (2, 1), (3, 1)])
    assert [r.score for r in classify(documents, own).collect()] == [pytest.approx(2 / 3)] * 3


def test_votes_as_brute_force():
    rng = np.random.default_rng(3)
    idf = np.ones(64, np.float32)
    model = quality.Model(idf, np.eye(64, dtype=np.float32), quality.unit(rng.random((40, 64)).astype(np.float32)), rng.integers(0, 2, 40).astype(float))
    counts = rng.integers(0, 3, (5, 64)).astype(np.float32)
    for score, vector in zip(model.scores(counts), model.latent(counts)):
        cosines = model.vectors @ vector
        near = np.argsort(-cosines)[: quality.NEIGHBOURS]
        weights = cosines[near].astype(float) ** quality.SHARPNESS
        assert score == pytest.approx(weights @ model.labels[near] / weights.sum(), rel=1e-5)


def test_axes_span_the_leading_directions():
    rng = np.random.default_rng(5)
    matrix = (rng.normal(size=(200, 4)) * [9, 7, 5, 3] @ rng.normal(size=(4, 50)) + 0.01 * rng.normal(size=(200, 50))).astype(np.float32)
    axes = leading_axes(matrix, 4)
    exact = np.linalg.svd(matrix)[2][:4]
    assert np.allclose(np.abs(np.linalg.svd(exact @ axes)[1]), 1, atol=1e-3)


def slow_characters(text):
    out = " "
    for c in (text or "").lower() + " ":
        c = c if c.isalpha() else " "
        if c != " " or out[-1] != " ":
            out += c
    return out


@pytest.mark.parametrize("make", [character_counts, shape_counts])
def test_counts_do_not_depend_on_the_batch(make):
    texts = ["Ab c!", None, "", "x x x\ny", "ÉÉ é", "12 AB!! AB!!", "z" * 500]
    together = make(1 << 10)(pa.array(texts))
    for row, t in zip(together, texts):
        assert (make(1 << 10)(pa.array([t]))[0] == row).all()


def test_number_of_grams():
    counts = character_counts(1 << 12)(pa.array(["Ab, c", None]))
    n = len(slow_characters("Ab, c"))
    assert counts[0].sum() == n + (n - 1) + (n - 2)


def test_document_frequencies(spark):
    texts = ["ab", "ab cd", None, "x"]
    counts = character_counts(1 << 10)
    frequencies, n = document_frequencies(docs(spark, texts), counts, 1 << 10)
    assert n == 4 and (frequencies == (counts(pa.array(texts)) > 0).sum(axis=0)).all()


@pytest.mark.parametrize("make", [character_counts, shape_counts])
@pytest.mark.parametrize("block", [97, 400, 4000])
def test_blocks_count_as_the_whole(make, block, monkeypatch):
    rng = random.Random(block)
    words = ["ab", "AB!", "\u00c9t\u00e9", "x1", "12", "\u03a3\u03a3", "...", "same", "\U0001f600"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", "\n", "  ", "\t"]) for _ in range(rng.randint(1, 900))) for _ in range(12)]
    whole = make(1 << 10)(pa.array(texts))
    monkeypatch.setattr(features, "BLOCK_BYTES", block)
    assert (make(1 << 10)(pa.array(texts)) == whole).all()
    assert (make(1 << 10)(pa.array([None, texts[0], ""])) == make(1 << 10)(pa.array([None, texts[0], ""]))).all()


@pytest.mark.parametrize("make", [character_counts, shape_counts])
def test_a_text_of_50_megabytes(make):
    """Memory for the text and for blocks of it, not 90 bytes for each of its bytes."""
    column = pa.array(["Some words of a very long text, " * 1_600_000])
    assert column.nbytes > 50e6
    tracemalloc.start()
    counts = make(1 << 12)(column)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6 and counts.sum() > 100e6


def test_one_word_that_fills_blocks(monkeypatch):
    monkeypatch.setattr(features, "BLOCK_BYTES", 100)
    monkeypatch.setattr(features, "_CONTEXT_BYTES", 64)
    for text in ("x" * 1000, "\u00e9" * 777, "\u4e2d" * 500 + " end"):
        for make in (character_counts, shape_counts):
            assert make(1 << 8)(pa.array([text])).sum() > 0


def test_equal_neighbours_vote_in_their_order():
    rng = np.random.default_rng(2)
    cosines = rng.integers(0, 4, (300, 30)).astype(np.float32)
    for k in (1, 5, 29, 30):
        got = quality.nearest(cosines, k)
        want = np.sort(np.argsort(-cosines, axis=1, kind="stable")[:, :k], axis=1)
        assert (np.sort(got, axis=1) == want).all()


def slow_features(text, size):
    """Counts of hashed character 1- to 3-grams, one gram at a time."""
    line, counts = slow_characters(text), {}
    for n in (1, 2, 3):
        for i in range(len(line) - n + 1):
            gram = 0
            for c in line[i : i + n]:
                gram = (gram * 0x1000193 + ord(c) + 1) % 2**64
            code = gram * 0xFF51AFD7ED558CCD * (2 * n + 1) % 2**64
            cell = code >> (64 - size.bit_length() + 1)
            counts[cell] = counts.get(cell, 0) + 1
    return counts


def slow_identify(rows, size, epochs=3, alpha=1.0, beta=1.0, l1=0.02, l2=0.001):
    """The model and its predictions from the papers' formulas, coordinate by coordinate."""
    learnable = [
        (i, t, lang) for i, t, lang in rows
        if i is not None and zlib.crc32(str(i).encode()) % 4 != 2 and t is not None and lang is not None
    ]
    held = {}
    for _, t, _ in learnable:
        for f in slow_features(t, size):
            held[f] = held.get(f, 0) + 1
    idf = lambda f: math.log((1 + len(learnable)) / (1 + held.get(f, 0))) + 1

    def vector(text):
        values = {f: math.log1p(c) * idf(f) for f, c in slow_features(text, size).items()}
        length = math.sqrt(sum(v * v for v in values.values()))
        return {**{f: v / length for f, v in values.items()}, size: 1.0}

    def place(row):
        code = xxhash.xxh64_intdigest(row[0].to_bytes(8, "little", signed=True), 42)
        return (code & (1 << 53) - 1) / (1 << 53), row[2]

    def soft(logits, t=1.0):
        powers = [math.exp((x - max(logits)) / t) for x in logits]
        return [p / sum(powers) for p in powers]

    names = sorted({lang for *_, lang in learnable})
    z, n = {}, {}

    def weight(f, k):
        own = z.get((f, k), 0.0)
        if abs(own) <= l1:
            return 0.0
        return -(own - math.copysign(l1, own)) / ((beta + math.sqrt(n.get((f, k), 0.0))) / alpha + l2)

    sample = [(vector(t), names.index(lang)) for _, t, lang in sorted(learnable, key=place)]
    for _ in range(epochs):
        for x, label in (s for i, s in enumerate(sample) if i % 5 != 4):
            old = {(f, k): weight(f, k) for f in x for k in range(len(names))}
            p = soft([sum(old[f, k] * v for f, v in x.items()) for k in range(len(names))])
            for (f, k), w in old.items():
                g = (p[k] - (k == label)) * x[f]
                grown = n.get((f, k), 0.0) + g * g
                sigma = (math.sqrt(grown) - math.sqrt(n.get((f, k), 0.0))) / alpha
                z[f, k] = z.get((f, k), 0.0) + g - sigma * w
                n[f, k] = grown
    final = {key: weight(*key) for key in z}
    logits = lambda x: [sum(final.get((f, k), 0.0) * v for f, v in x.items()) for k in range(len(names))]
    apart = [(logits(x), label) for x, label in sample[4::5]]
    grid = [math.exp(math.log(0.02) + (math.log(20) - math.log(0.02)) * i / 139) for i in range(140)]
    loss = lambda t: -sum(math.log(max(soft(x, t)[label], 1e-12)) for x, label in apart)
    t = min(grid, key=loss)
    return {i: soft(logits(vector(text)), t) for i, text, _ in rows if any(map(str.isalpha, text or ""))}, names


def test_languages_as_recomputed(spark, monkeypatch):
    """Every probability against a plain recomputation of frequencies, leader and temperature."""
    rng, size = random.Random(12), 1 << 9
    rows = []
    for i in range(70):
        lang = rng.choice(["aa", "bb"])
        letters = ALPHABETS[lang] + (ALPHABETS["bb"] if rng.random() < 0.4 else "")
        # A fifth is marked wrongly, so that no text is certain.
        rows.append((i * 7 - 30, sentence(rng, letters, rng.randint(1, 12)), lang if i % 5 else "aa"))
    monkeypatch.setattr(language_id, "SIZE", size)
    monkeypatch.setattr(language_id.train, "__defaults__", (size, language_id.MAX_ROWS, 3))
    frame = spark.createDataFrame(rows + [(1000, "never seen \u00e9 abc", None), (1001, "9", "aa")], "doc_id bigint, text string, lang string")
    want, names = slow_identify(rows + [(1000, "never seen \u00e9 abc", None), (1001, "9", "aa")], size)
    got = {r.doc_id: (r.lang_pred, r.score) for r in identify(frame).collect()}
    assert got.pop(1001) == ("und", 0.0) and got.keys() == want.keys()
    for i, p in want.items():
        assert got[i] == (names[p.index(max(p))], pytest.approx(max(p), abs=2e-3))
    assert len({round(s, 3) for _, s in got.values()}) > 10
