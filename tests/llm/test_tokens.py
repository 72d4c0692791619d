import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tagstream.llm.token_counts import PieceCounts, count_tokens, prove_whole_tokens
from tagstream.llm.token_output import ByteLevelIds, read_tokens, token_index, write_tokens
from tests.llm.tables import alike_words, clashing, docs

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")

TEXTS = [
    None, "", " ", "\n", "a", "The cat, the cat's hat.\nIt'll do!!  two  spaces\t\ttabs \n\n x",
    "ÈÇÉ ñandú Straße Σίσυφος İstanbul x́ ́y a b 　 c", "<|endoftext|>", "a <|startoftext|>b",
    "3.14159 1,000 ___ a_b _x !!__", "日本語 текст 😀😀", "\x1c\x1d a\x1fb", "z" * 5000, "w " * 3000, "don't DON'T 're x'sy",
    " lead", "trail ", "a\n b", "a \nb", "  q", "ß̇ ﬁ Ⅷ ²x", "éé", "x\r\ny", "a\x85b",
]


@pytest.fixture(scope="module")
def word():
    return Tokenizer.from_file(WORD), PieceCounts(WORD, prove_whole_tokens(WORD))


@pytest.fixture(scope="module")
def byte():
    return Tokenizer.from_file(BYTE), ByteLevelIds(BYTE)


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


PIECES = st.sampled_from([" ", "  ", "\n", "\t", "The", "x", "é", "_", ".", "!!", "'s", "12", "'", "日", "\x1c", " ", "́", "ing"])
RANDOM = st.one_of(st.text(max_size=40), st.lists(PIECES, max_size=25).map("".join))


@settings(max_examples=400, deadline=None)
@given(text=RANDOM)
def test_counts_as_the_library(word, text):
    assert word[1].count(text) == len(ids(word[0], text))


@settings(max_examples=400, deadline=None)
@given(text=RANDOM)
def test_ids_as_the_library(byte, text):
    assert byte[1].of_texts([text])[0].tolist() == ids(byte[0], text)


@settings(max_examples=100, deadline=None)
@given(texts=st.lists(RANDOM, max_size=8))
def test_ids_of_a_batch(byte, texts):
    assert [x.tolist() for x in byte[1].of_texts(texts)] == [ids(byte[0], t) for t in texts]


def test_fixed_texts(word, byte):
    for t in TEXTS:
        assert word[1].count(t or "") == len(ids(word[0], t))
        assert byte[1].of_texts([t or ""])[0].tolist() == ids(byte[0], t)
    assert [x.tolist() for x in byte[1].of_texts([t or "" for t in TEXTS])] == [ids(byte[0], t) for t in TEXTS]


def test_whole_tokens_are_proved(word):
    whole = prove_whole_tokens(WORD)
    assert len(whole) > 10_000 and "the" in whole
    for text in random.Random(0).sample(sorted(whole), 300):
        assert len(ids(word[0], text)) == 1


def test_what_is_not_remembered_counts_the_same(monkeypatch):
    from tagstream.llm import token_counts, token_output

    monkeypatch.setattr(token_counts, "REMEMBERED", 0)
    monkeypatch.setattr(token_output, "REMEMBERED", 0)
    assert PieceCounts(WORD, {}).count("The cat, THE") == 4
    encoder = ByteLevelIds(BYTE)
    for _ in range(2):
        assert encoder.of_texts(["The cat\nsat"])[0].tolist() == ids(Tokenizer.from_file(BYTE), "The cat\nsat")
    assert len(encoder.known.pool) == 0


def test_a_growing_table(byte):
    rng, encoder = random.Random(8), ByteLevelIds(BYTE)
    for _ in range(12):
        words = ["".join(rng.choices("abcdefghijé", k=rng.randint(1, 8))) for _ in range(9000)]
        texts = [" ".join(words[i:i + 90]) + "\n" + words[i] + "." for i in range(0, 9000, 90)]
        got = encoder.of_texts(texts)
        i = rng.randrange(len(texts))
        assert got[i].tolist() == ids(byte[0], texts[i])
        assert sum(map(len, got)) == sum(len(ids(byte[0], t)) for t in texts)
    assert len(encoder.known.levels[0][0]) > 1 << 15


def test_count_query(spark):
    tokenizer = Tokenizer.from_file(WORD)
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in count_tokens(clashing(docs(spark, TEXTS)), WORD).collect()}
    assert got == {i: (len((t or "").encode()), len(ids(tokenizer, t))) for i, t in enumerate(TEXTS)}
    assert count_tokens(docs(spark, []), WORD).collect() == []
    assert [r.doc_id for r in count_tokens(docs(spark, [(None, "a"), (1, "a"), (1, "a")]), WORD).collect()] == [None, 1, 1]


def place(row):
    """By identifier, then by Spark's hash of the text (a null's is the seed), then by the text."""
    i, t = row
    code = 42 if t is None else np.uint64(xxhash.xxh64_intdigest(t.encode(), 42)).astype(np.int64)
    return i is not None, i or 0, code, t is not None, (t or "").encode()


def expected(rows):
    tokenizer, start, out = Tokenizer.from_file(BYTE), 0, []
    for i, t in sorted(rows, key=place):
        own = np.array(ids(tokenizer, t) + [2], "<u4")
        out.append((i, start, len(own), zlib.crc32(own.tobytes())))
        start += len(own)
    return out


def test_round_trip(spark, tmp_path):
    rows = list(enumerate(TEXTS)) + [(3, "again"), (3, "again"), (None, "no id"), (-5, "first")]
    path = str(tmp_path / "ids")
    write_tokens(clashing(docs(spark, rows)), path, BYTE, 2, part_bytes=200)
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_index(spark, path).orderBy("start").collect()]
    assert got == expected(rows)
    stored = {r.doc_id: r.ids for r in read_tokens(spark, path).filter("doc_id = 5").collect()}
    assert stored == {5: ids(Tokenizer.from_file(BYTE), TEXTS[5]) + [2]}
    plan = read_tokens(spark, path).filter("doc_id = 5")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,5)" in plan


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "ids")
    write_tokens(docs(spark, []), path, BYTE, 2)
    assert token_index(spark, path).collect() == []


def test_pieces_of_like_polynomials(byte):
    for power in range(6, 17):
        one, other = alike_words(1 << power)
        texts = [f"so {one} it", f"so {other} it", f"{one}\n{other}."]
        encoder = ByteLevelIds(BYTE)
        assert [x.tolist() for x in encoder.of_texts(texts)] == [ids(byte[0], t) for t in texts]


def test_one_identifier_is_dealt_to_several_tasks(spark, tmp_path):
    """A third of all rows may share an identifier, or have none."""
    rows = [(None if i % 3 else 7, f"text number {i}") for i in range(600)]
    write_tokens(docs(spark, rows), str(tmp_path / "t"), BYTE, 2, part_bytes=1000)
    parts = read_tokens(spark, str(tmp_path / "t")).groupBy("part").count().collect()
    assert len(parts) > 4 and max(r["count"] for r in parts) < 300
    got = token_index(spark, str(tmp_path / "t")).orderBy("start").collect()
    assert len(got) == 600 and [r.doc_id for r in got] == [None] * 400 + [7] * 200
    assert [r.start for r in got[1:]] == [a.start + a.n_tokens for a in got[:-1]]
