import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagstream.llm.fill_in_middle import BlockCounts, draws, fill_in_middle, restored
from tagstream.llm.words import text_buffer
from tests.llm.tables import clashing, docs

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def slow(doc_id, text, seed=42, rearranged=50, suffix_first=80):
    text = text or ""
    units = UNIT.findall(text)
    assert "".join(units) == text
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rearranged:
        return doc_id, n, "plain", None, None, text
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < suffix_first:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def texts(seed=1):
    rng = random.Random(seed)
    words = ["a", "Word", "h\u00e9", "\u4e2d\u6587", "\U0001f600x", "<", "<S", ">", "P>", "\u00a0", "\u2003y", "\x1c", "x" * 70]
    blanks = [" ", "  ", "\n", "\t ", " \r\n\x0b\x0c"]
    out = []
    for _ in range(120):
        text = "".join(rng.choice(words) + rng.choice(blanks) for _ in range(rng.randint(0, 60)))
        out.append(rng.choice(["", " ", "\n\n"]) + (text if rng.random() < 0.5 else text.rstrip(" \t\n\r\x0b\x0c")))
    return out + [None, "", " ", "\n \t", "one", "one ", " one", "holds <M> itself", "<P>", "ends in <", "\u00e9" * 600]


def rows(frame, *more):
    return sorted(map(tuple, frame.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", *more).collect()), key=repr)


@pytest.mark.parametrize("block", [1, 7, 64, 512])
def test_as_brute_force(spark, block):
    own = texts()
    got = fill_in_middle(clashing(docs(spark, own)), rearranged_percent=90, block_bytes=block)
    want = [slow(i, t, rearranged=90) for i, t in enumerate(own)]
    assert rows(got) == sorted(want, key=repr)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}


def test_restored(spark):
    own = texts(2)
    made = fill_in_middle(docs(spark, own), rearranged_percent=100, suffix_first_percent=50)
    back = {r.doc_id: r.text for r in made.select("doc_id", restored(F.col("output"), F.col("form")).alias("text")).collect()}
    assert back == {i: t or "" for i, t in enumerate(own)}


def test_other_markers(spark):
    marks = ("\ue000", "\ue001x", "\ue002")
    made = fill_in_middle(docs(spark, ["one two three four", "has \ue001x"]), rearranged_percent=100, markers=marks)
    back = made.select("form", restored(F.col("output"), F.col("form"), marks).alias("text")).collect()
    assert sorted((r.form == "plain", r.text) for r in back) == [(False, "one two three four"), (True, "has \ue001x")]
    for bad in (("<P>", "<P>", "<M>"), ("<P>", "", "<M>"), ("<<P>", "<S>", "<M>")):
        with pytest.raises(ValueError):
            fill_in_middle(docs(spark, []), markers=bad)


def test_nulls_repeated_rows_and_empty_table(spark):
    own = [(None, "no name here"), (None, None), (7, "a b c d e f"), (7, "a b c d e f"), (7, "other words of the same name"), (-3, "x y")]
    assert rows(fill_in_middle(docs(spark, own), rearranged_percent=100)) == sorted(
        (slow(i, t, rearranged=100) for i, t in own), key=repr
    )
    assert rows(fill_in_middle(docs(spark, []))) == []


def test_forms_by_the_percentages(spark):
    made = fill_in_middle(docs(spark, ["one two three"] * 400)).groupBy("form").count().collect()
    share = {r.form: r["count"] / 400 for r in made}
    assert abs(share["plain"] - 0.5) < 0.1 and abs(share["spm"] - 0.4) < 0.1


def test_trees_hold_every_cut():
    """Every number of units, on texts longer than what is counted together."""
    rng = random.Random(3)
    own = ["".join(rng.choice(["ab ", "\u00e9\u00e9\n", "word  "]) for _ in range(300)), "", "x" * 5000 + " y", "z"]
    data, offsets = text_buffer(pa.array(own))
    counts = BlockCounts(data, offsets, 16)
    for i, text in enumerate(own):
        ends = [m.end() for m in UNIT.finditer(text)]
        assert counts.totals()[i] == len(ends)
        ranks = np.arange(len(ends) + 1)
        at, points = counts.cut(np.full(len(ranks), i), ranks)
        assert points.tolist() == [0, *ends]
        assert at.tolist() == [len(text[:e].encode()) for e in [0, *ends]]


def test_a_very_long_text():
    text = "word \u00e9\u00e9 " * 400_000
    data, offsets = text_buffer(pa.array(["short", text]))
    counts = BlockCounts(data, offsets)
    assert counts.totals().tolist() == [1, 800_001]
    at, points = counts.cut(np.array([1, 1]), np.array([400_001, 800_001]))
    assert points.tolist() == [200_000 * 8 + 4, len(text)] and at[1] == len(text.encode())


def test_draws():
    assert draws(42, 7) == tuple(int(hashlib.sha256(b"42:7").hexdigest()[i : i + 8], 16) for i in (0, 8, 16, 24))
