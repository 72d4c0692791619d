import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tagstream.llm import collocations as module
from tagstream.llm.collocations import _counted, collocations, phrase_counts
from tagstream.llm.transducer import CodeCollision, PhraseCounts
from tests.llm.tables import DOCS, clashing

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_counts(rows, longest):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    counts[(lang or "und", tuple(words[i : i + n]))] += 1
    return counts, totals


def slow(rows, longest=3, least=10, inside=50, most=2000):
    f, totals = slow_counts(rows, longest)
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = {}
    for (lang, words), a in candidates.items():
        dropped = any(
            other == lang and len(longer) > len(words) and 100 * b >= inside * a
            and any(longer[i : i + len(words)] == words for i in range(len(longer)))
            for (other, longer), b in candidates.items()
        )
        if dropped:
            continue
        cuts = []
        for k in range(1, len(words)):
            l, r = f[lang, words[:k]], f[lang, words[k:]]
            cuts.append((1_000_000 * a * a // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r))
    return sorted(
        (lang, rank, phrase.decode(), -a, l, r, totals[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:most], 1)
    )


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, (t, lang) in enumerate(rows)], DOCS)


def rows_of(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def corpus(seed=1, n=160):
    rng = random.Random(seed)
    words = ["the", "The", "new", "York", "times", "\u00c9t\u00e9", "\u00e9t\u00e9", "x\u00a0y", "a", "b", "c", "d", "\x00", "\x1f"]
    fixed = ["new york times", "of the day", "a b c d", "see you later alligator"]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 12)):
            parts.append(rng.choice(fixed) if rng.random() < 0.4 else " ".join(rng.choices(words, k=rng.randint(1, 5))))
        text = "".join(p + rng.choice([" ", ". ", ",", "\n", "\t", "  ", " ! ", "\x0b", "\r\n"]) for p in parts)
        out.append((text, rng.choice(["en", "en", "en", "de", None, "und"])))
    return out + [(None, "en"), ("", "de"), (" .,;", None), ("one", "xx")]


@pytest.mark.parametrize("longest,least,inside", [(3, 10, 50), (2, 3, 50), (4, 5, 80), (3, 1, 1)])
def test_as_brute_force(spark, longest, least, inside):
    rows = corpus()
    got = rows_of(collocations(clashing(frame(spark, rows)), longest, least, inside))
    assert got == slow(rows, longest, least, inside) and got


def test_best_only(spark, monkeypatch):
    """Ranked in shares, and ties at the end of the list go by the phrase."""
    monkeypatch.setattr(module, "_RANKED", 7)
    rows = corpus(2)
    assert rows_of(collocations(frame(spark, rows), least=2, most=9)) == slow(rows, least=2, most=9)


def test_many_sends(spark, monkeypatch):
    """Automata that are sent in many small ones sum to the same."""
    rows = corpus(3)
    f, _ = slow_counts(rows, 3)
    pieces = pa.RecordBatch.from_pydict({"lang": [lang or "und" for _, lang in rows], "text": [t for t, _ in rows]})
    monkeypatch.setattr(module, "_BLOCK_WORDS", 37)
    parts = list(_counted(pieces, 3, 0))
    assert len(parts) > 5
    got = Counter()
    for whole in parts:
        for part in whole.cut(2, 11).values():
            got.update(states(PhraseCounts.unpacked(part.packed())))
    f = Counter({(lang, tuple(module.xxhash.xxh64_intdigest(w) for w in words)): n for (lang, words), n in f.items()})
    assert got == f
    assert states(PhraseCounts.united(parts)) == f


def states(whole):
    for label, word, weight in zip(whole.levels[1].label, whole.names.words.to_pylist(), whole.levels[1].weight):
        assert module.xxhash.xxh64_intdigest(word, 0) == whole.alphabet[label] if weight else word == b""
    out = Counter()
    for depth in range(1, len(whole.levels)):
        which = np.flatnonzero(whole.levels[depth].weight)
        language, places = whole.phrases(depth, which)
        for lang, row, weight in zip(language, places, whole.levels[depth].weight[which]):
            out[whole.languages[lang], tuple(whole.alphabet[row].tolist())] += int(weight)
    return out


def test_equal_states_are_stored_once():
    text = " . ".join(f"w{i} same end" for i in range(5000))
    batch = pa.RecordBatch.from_pydict({"lang": ["en"], "text": [text]})
    (whole,) = _counted(batch, 3, 0)
    other = pa.RecordBatch.from_pydict({"lang": ["en"], "text": [" . ".join(f"w{i} s{i} e{i}" for i in range(5000))]})
    (apart,) = _counted(other, 3, 0)
    assert len(whole.packed()) < len(apart.packed())
    assert states(PhraseCounts.unpacked(whole.packed())) == states(whole)


def test_a_phrase_lies_in_one_part():
    batch = pa.RecordBatch.from_pydict({"lang": ["en", "de"], "text": ["a b c a b d a b c", "a b c"]})
    (whole,) = _counted(batch, 3, 0)
    seen = Counter()
    for part in whole.cut(2, 5).values():
        seen.update(dict.fromkeys(states(part), 1))
    assert set(seen.values()) == {1} and seen.keys() == states(whole).keys()


def test_words_of_one_code(spark, monkeypatch):
    """Codes that clash are found out, in a block and between blocks, and another seed is taken."""
    real = module.xxhash.xxh64_intdigest

    class Weak:
        xxh3_64_intdigest = staticmethod(module.xxhash.xxh3_64_intdigest)

        @staticmethod
        def xxh64_intdigest(data, seed=0):
            return real(data, seed) if seed else real(data[:1], 0)

    batch = lambda text: pa.RecordBatch.from_pydict({"lang": ["en"], "text": [text]})
    monkeypatch.setattr(module, "xxhash", Weak)
    with pytest.raises(CodeCollision):
        list(_counted(batch("ab ac"), 3, 0))
    (one,), (other,) = _counted(batch("ab b"), 3, 0), _counted(batch("ac b"), 3, 0)
    with pytest.raises(CodeCollision):
        PhraseCounts.united([one, other])
    assert len(list(_counted(batch("ab ac"), 3, 1))) == 1


def test_a_clash_is_told(spark):
    packed = spark.createDataFrame([(0, bytearray(b"")), (1, bytearray(next(_counted(
        pa.RecordBatch.from_pydict({"lang": ["en"], "text": ["a b"]}), 3, 0)).packed()))], "part int, packed binary")
    found = module._frequent(packed, 1).collect()
    assert sum(r.clash for r in found) == 1 and len([r for r in found if not r.clash]) == 4


def test_long_words_and_texts(spark):
    """A text of many blocks; words of 70,000 letters that differ in the last."""
    long = ["x" * 70_000 + "a", "x" * 70_000 + "b"]
    rows = [("tick tock " * 300_000, "en"), (" ".join([long[0], "y", long[1], "y"] * 12), "de")]
    got = rows_of(collocations(frame(spark, rows)))
    assert got == slow(rows)


def test_empty_table(spark):
    assert collocations(frame(spark, [])).collect() == []
    assert collocations(frame(spark, [(None, None), ("", "en"), (".", "de")])).collect() == []
    with pytest.raises(ValueError):
        collocations(frame(spark, []), longest=1)


def test_counts_of_all_words(spark):
    rows = corpus(4)
    f, totals = slow_counts(rows, 3)
    found = phrase_counts(frame(spark, rows), 3, 1).collect()
    n = Counter()
    for r in found:
        if not r.codes:
            n[r.lang] += r.f
    assert +n == +totals
    assert {(r.lang, r.word): r.f for r in found if len(r.codes) == 1} == {(k[0], k[1][0]): v for k, v in f.items() if len(k[1]) == 1}
    assert sum(r.f for r in found if len(r.codes) == 3) == sum(v for k, v in f.items() if len(k[1]) == 3)
