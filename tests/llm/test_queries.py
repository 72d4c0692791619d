import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as driver
from tagstream.llm.oracle import ORACLE
from tagstream.llm.queries import QUERIES
from tests.compare import duck, mismatch
from tests.llm.test_license_scan import slow_places, slow_words
from tests.llm.test_nearest import brute, found
from tests.llm.test_simhash import BLANK, groups, slow_fingerprint

DATA = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="needs the given tables")


def test_registered():
    assert QUERIES.items() <= driver.queries().items() and "pipeline" in driver.queries()
    assert ORACLE.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert mismatch(QUERIES[name](spark, DATA), duck(DATA), ORACLE[name]) is None


@pytest.fixture(scope="module")
def texts():
    con = duck(DATA)
    return dict(con.execute("SELECT doc_id, text FROM documents").fetchall())


def rows(spark, name):
    return {r.doc_id: r.asDict() for r in QUERIES[name](spark, DATA).collect()}


def test_token_counts(spark, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = rows(spark, "op3_token_counts")
    for i, t in texts.items():
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids)
        want = {"doc_id": i, "n_bytes": len((t or "").encode()), "n_tokens": n, "over_limit": n > 2048}
        assert got.pop(i) == want
    assert not got


def test_simhash(spark, texts):
    values = {i: slow_fingerprint(t) for i, t in sorted(texts.items())}
    names = [list(values)[g] for g in groups(list(values.values()), 2)]
    want = {i: (f"{v:016x}", c) for (i, v), c in zip(values.items(), names)}
    got = {i: (r["fingerprint"], r["component_id"]) for i, r in rows(spark, "op6_simhash").items()}
    assert got == want


def test_token_output(spark, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got, start = rows(spark, "op8_token_output"), 0
    for i, t in sorted(texts.items()):
        own = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want = {"doc_id": i, "start": start, "n_tokens": len(own), "ids_crc32": zlib.crc32(own.tobytes())}
        assert got.pop(i) == want
        start += len(own)
    assert not got


def test_language_id(spark):
    con = duck("/root/testdata/sf0.01")
    truth = dict(con.execute("SELECT doc_id, lang FROM documents WHERE lang IS NOT NULL").fetchall())
    got = QUERIES["op4_language_id"](spark, "/root/testdata/sf0.01").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.98


def test_quality(spark):
    con = duck("/root/testdata/sf0.01")
    truth = dict(con.execute("SELECT doc_id, quality FROM labels").fetchall())
    got = QUERIES["op9_quality"](spark, "/root/testdata/sf0.01").collect()
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(got) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(r.predicted == 1 for r in held if truth[r.doc_id] == 1)
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.95


def test_mixing(spark, texts):
    got = rows(spark, "op5_mixing")
    assert got.keys() == texts.keys()
    con = duck(DATA)
    for i, source, lang in con.execute("SELECT doc_id, source, lang FROM documents").fetchall():
        assert (got[i]["source"], got[i]["lang"]) == (source, lang)
        assert got[i]["n_tokens"] == len([w for w in BLANK.split(texts[i] or "") if w])
    total = sum(r["n_tokens"] for r in got.values())
    assert sum(r["n_tokens"] * r["probability"] for r in got.values()) == pytest.approx(0.6 * total, rel=1e-6)


def test_license_scan(spark, texts):
    got = rows(spark, "op7_license_scan")
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        places = slow_places(t)
        want = (len(slow_words(t)), len(places), *((places[0][1], places[-1][1]) if places else (None, None)))
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == want
        base = sorted({label for label, _ in places})
        labels = r["labels"].split(",") if r["labels"] else []
        assert r["base_labels"] == ",".join(base) and set(base) <= set(labels) and labels == sorted(set(labels))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(labels)
        assert ("cc-by-nc-4.0" in labels) == ("CC BY-NC 4.0" in (t or ""))


def test_nearest(spark):
    sf = "/root/testdata/sf0.1"
    vectors = dict(duck(sf).execute("SELECT vec_id, embedding FROM embeddings").fetchall())
    got, want = found(QUERIES["op10_nearest"](spark, sf)), brute(vectors, 20)
    assert got.keys() == want.keys()
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want]
    assert sum(hits) / len(hits) / 20 >= 0.95
    truth = {q: dict(brute_scores) for q, brute_scores in want.items()}
    assert all(s == pytest.approx(truth[q].get(i, s), rel=1e-12) for q, own in got.items() for i, s in own)
