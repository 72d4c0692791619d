import random
import re
from collections import Counter

import pytest

from tagstream.llm.substring_dedup import remove_repeats
from tests.llm.tables import alike_words, clashing, docs

BLANK = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in BLANK.split(text or "") if w]


def brute(texts, window):
    split = [words(t) for t in texts]
    runs = Counter(tuple(w[i:i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if runs[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def found(df):
    return {r.doc_id: (r.n_words, sum(s.end - s.start for s in r.spans), r.kept_text) for r in df.collect()}


def random_texts(seed, n=60):
    rng = random.Random(seed)
    letters = ["a", "b", "ç", "dd", "e e"]
    shared = [" ".join(rng.choices(letters, k=rng.randint(3, 30))) for _ in range(6)]
    out = []
    for _ in range(n):
        pieces = [" ".join(f"u{rng.random()}" for _ in range(rng.randint(0, 9)))]
        pieces += rng.choices(shared, k=rng.randint(0, 3))
        rng.shuffle(pieces)
        out.append(rng.choice([" ", "\n", " \t "]).join(pieces))
    return out + [None, "", " \n ", "x", "x " * 400, out[0], out[1]]


@pytest.mark.parametrize("window", [2, 5, 8, 35])
def test_as_brute_force(spark, window):
    texts = random_texts(window)
    got = found(remove_repeats(docs(spark, texts), window))
    assert got == dict(enumerate(brute(texts, window)))


def test_spans_are_the_removed_words(spark):
    texts = random_texts(3)
    for r in remove_repeats(docs(spark, texts), 5).collect():
        w = words(texts[r.doc_id])
        gone = {i for s in r.spans for i in range(s.start, s.end)}
        assert " ".join(x for i, x in enumerate(w) if i not in gone) == r.kept_text


def test_many_buckets_agree_with_one(spark, monkeypatch):
    from tagstream.llm import substring_dedup

    texts = random_texts(7)
    monkeypatch.setattr(substring_dedup, "BUCKET_BYTES", 60)
    monkeypatch.setattr(substring_dedup, "INDEX_BYTES", 100)
    assert found(remove_repeats(docs(spark, texts), 5)) == dict(enumerate(brute(texts, 5)))


def test_null_identifier_repeated_rows_and_clashing_columns(spark):
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "z")]
    got = sorted(
        ((r.doc_id, r.kept_text) for r in remove_repeats(clashing(docs(spark, rows)), 3).collect()), key=str
    )
    assert got == sorted([(None, ""), (1, ""), (1, ""), (2, "z")], key=str)


def test_empty_table_and_long_word(spark):
    assert remove_repeats(docs(spark, []), 5).collect() == []
    long = "y" * 200_000
    got = found(remove_repeats(docs(spark, [f"{long} b c", f"{long} b d", f"{long}y b c"]), 2))
    assert [got[i][2] for i in range(3)] == ["", "d", f"{long}y"]


def test_repeated_rows_do_not_fill_a_bucket(spark):
    from tagstream.llm.substring_dedup import in_buckets, split_copies

    rows = [(i, f"w{i} " * 9) for i in range(50)] + [(None, "a b c d e f")] * 300 + [(7, None)] * 40 + [(None, None)] * 30
    table = docs(spark, rows).select("doc_id", "text")
    once, copies = split_copies(table)
    assert in_buckets(once, 5).groupBy("bucket").count().agg({"count": "max"}).first()[0] <= 53
    assert once.filter("not asks").count() == 3 and copies.count() == 370
    assert split_copies(table.limit(0))[1] is None


@pytest.mark.parametrize("broadcast", [0, 100])
def test_many_repeated_rows(spark, monkeypatch, broadcast):
    from tagstream.llm import substring_dedup

    monkeypatch.setattr(substring_dedup, "MAX_BROADCAST_KEYS", broadcast)
    texts = random_texts(9, 20)
    texts += [f"x y {texts[0]} z", "n o p q r", "m n o p q r s", " a  b\t", "one of its own"]
    rows = list(enumerate(texts))
    rows += [rows[0]] * 9 + [rows[-4]] * 30 + [rows[-2]] * 5 + [(None, "n o p q r")] * 20 + [(None, None)] * 3 + [(7, "")] * 2
    want = [(i, *r) for (i, _), r in zip(rows, brute([t for _, t in rows], 5))]
    got = [
        (r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), r.kept_text)
        for r in remove_repeats(docs(spark, rows), 5).collect()
    ]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_words_of_like_polynomials(spark):
    """Documents that share 34 words beside such a pair of words keep all; with the same word all 35 go."""
    texts = []
    for power in range(6, 17):
        one, other = alike_words(1 << power)
        shared = " ".join(f"s{power}x{i}" for i in range(34))
        texts += [f"{one} {shared}", f"{other} {shared}", f"{shared} {one}", f"{shared} {one}"]
    got = found(remove_repeats(docs(spark, texts), 35))
    assert got == dict(enumerate(brute(texts, 35)))
    assert [got[i][1] for i in sorted(got)] == [0, 0, 35, 35] * 11
