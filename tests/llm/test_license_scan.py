import random
import re

import numpy as np
import pytest

from tagstream.llm.license_scan import BODIES, TEMPLATES, Index, phrase_places, scan_licenses, words_of
from tests.llm.tables import clashing, docs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def slow_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def slow_places(text):
    w, out = slow_words(text), []
    for phrase, label in BASE.items():
        p = phrase.split()
        out += [(label, i) for i in range(len(w)) if w[i:i + len(p)] == p]
    return sorted(out, key=lambda p: (p[1], p[0]))


def filler(rng, n):
    return " ".join("".join(rng.choices("abcdef", k=rng.randint(2, 8))) for _ in range(n))


TEXTS = [
    None, "", " - ", "MIT License", "mit licenses", "the MIT-License, the mit\nlicense mit license",
    "Apache License Apache License.", "GENERAL public_license General Public License",
    "éMIT license É mit license ü", "mit license " * 3000, "x" * 100_000 + " mit license",
]


def test_words_and_places():
    rng = random.Random(1)
    tokens = ["mit", "license", "Apache", "general", "public", "x", "-", "\n", "é", "9", "_", "'", "\x7f"]
    for t in TEXTS + ["".join(rng.choices(tokens + [" "] * 9, k=60)) for _ in range(300)]:
        own = words_of((t or "").encode())
        assert [w.decode() for w in own] == slow_words(t)
        assert phrase_places(own, BASE) == slow_places(t)


def found(df):
    return {r.doc_id: ({f.label for f in r.found}, r) for r in df.collect()}


def test_notices(spark):
    rng = random.Random(2)
    rows, want = [], {}
    for i, (label, (_, notices)) in enumerate(TEMPLATES.items()):
        for j, notice in enumerate(notices):
            key = 100 * i + j
            rows.append((key, f"{filler(rng, 300)}\n{notice}. {filler(rng, 50)}"))
            want[key] = label
    rows += [(5000 + i, f"{filler(rng, 200)} the license of this work under the terms {filler(rng, 9)}") for i in range(40)]
    got = found(scan_licenses(clashing(docs(spark, rows))))
    for key, label in want.items():
        assert label in got[key][0], label
        best = max(f.score for f in got[key][1].found if f.label == label)
        assert best > 0.99 and all(0 <= f.score <= 1 and 300 - 4 <= f.start <= f.end for f in got[key][1].found)
    assert not any(got[5000 + i][0] for i in range(40))


def test_altered_notices(spark):
    rows = [
        (1, "This work is gladly licensed under the terms of GNU General Public License, version 3."),
        (2, "This work is licensed under the GNU General Private License, version 3."),
        (3, "General things. Public places. License plates. Version control. 3 GNU."),
    ] + [(10 + i, filler(random.Random(i), 30)) for i in range(30)]
    got = found(scan_licenses(docs(spark, rows)))
    assert "gpl-3.0" in got[1][0] and not got[2][0] and not got[3][0]


def test_columns(spark):
    got = scan_licenses(docs(spark, TEXTS)).collect()
    for r in got:
        assert [(p.label, p.start) for p in r.places] == slow_places(TEXTS[r.doc_id])
        assert r.n_words == len(slow_words(TEXTS[r.doc_id]))
    again = scan_licenses(docs(spark, [(None, "MIT License"), (1, "MIT License"), (1, "MIT License")])).collect()
    assert [len(r.places) for r in again] == [1, 1, 1]
    assert scan_licenses(docs(spark, [])).collect() == []


@pytest.mark.parametrize("n", [0, 10])
def test_index_weights(n):
    index = Index(TEMPLATES)
    index.weigh({b"the": n}, n)
    assert index.idf[b"apache"] >= index.idf[b"the"] > 0


def weighed():
    """An index with the weights of a corpus in which common words are common."""
    index = Index(TEMPLATES)
    common = [b"the", b"of", b"and", b"in", b"is", b"work", b"under", b"this", b"may", b"for", b"not", b"you"]
    index.weigh({w: 900 for w in common}, 1000)
    return index


def labels(index, text):
    return {label for label, *_ in index.find(words_of(text.encode()))}


def test_all_notices_in_one_file():
    rng, index = random.Random(4), weighed()
    for pick in (0, -1):
        for gap in (0, 40):
            text = "".join(f"{notices[pick]}. {filler(rng, gap)}\n" for _, notices in TEMPLATES.values())
            assert labels(index, text) == set(TEMPLATES)


def test_long_file_with_much_licence_vocabulary():
    rng, index = random.Random(5), weighed()
    vocabulary = sorted(w.decode() for w in index.vocabulary)
    for label, (_, notices) in TEMPLATES.items():
        for notice in notices:
            around = [" ".join(rng.choices(vocabulary, k=3000)) for _ in range(2)]
            text = f"{around[0]} {filler(rng, 9)} {notice} {filler(rng, 9)} {around[1]}"
            start = len(words_of(text[: text.index(notice)].encode())) if text.count(notice) == 1 else None
            at = [(a, s) for a, s, _, score in index.find(words_of(text.encode())) if score > 0.99]
            assert (label, start) in at if start is not None else label in {a for a, _ in at}


def test_words_between_part_the_votes():
    index = Index(TEMPLATES)
    assert labels(index, "Released a under b CC0 c 1 d 0 e Universal") == {"cc0-1.0"}


def slow_finds(words, idf):
    """``(label, start, share)`` of every start at which a notice passes, by what the README says and no index.

    70 % of the notice's weight within three words of its place, each key phrase within the notice's
    stretch, three words more on either side, and not as a part of a longer name of another licence.
    """
    notices = [(label, text, keys) for label, (keys, texts) in TEMPLATES.items() for text in texts]
    notices += [(label, text, keys) for label, keys, texts in BODIES for text in texts]
    phrases = [(label, " ".join(slow_words(k))) for label, _, keys in notices for k in keys]
    out = []
    for label, text, keys in notices:
        own = slow_words(text)
        total = sum(idf[w] for w in own)
        for start in range(-len(own) - 3, len(words) + 4):
            share = sum(idf[w] for i, w in enumerate(own) if w in words[max(0, start + i - 3) : max(0, start + i + 4)]) / total
            if share < 0.7 - 1e-12:
                continue
            low, high = max(0, start - 3), start + len(own) + 3
            for key in (slow_words(k) for k in keys):
                mine = {p for a, p in phrases if a == label}
                names = [p.split() for _, p in phrases if p not in mine and "license" in key and f" {' '.join(key)} " in f" {p} "]
                inside = {
                    (j + k, j + k + len(key))
                    for name in names for j in range(len(words)) if words[j : j + len(name)] == name
                    for k in range(len(name)) if name[k : k + len(key)] == key
                }
                if not any(
                    words[j : j + len(key)] == key and j + len(key) <= high and (j, j + len(key)) not in inside
                    for j in range(low, min(high, len(words)))
                ):
                    break
            else:
                out.append((label, start, share))
    return out


@pytest.mark.parametrize("seed", range(12))
def test_every_start_that_passes_is_found(seed):
    """Against a plain scan of all starts: nothing that passes is missed, nothing else is found."""
    rng = random.Random(seed)
    index = Index(TEMPLATES, BODIES)
    common = [b"the", b"of", b"and", b"in", b"is", b"work", b"under", b"this", b"may", b"for", b"not", b"you", b"license"]
    index.weigh({w: rng.randrange(500, 1000) for w in common}, 1000)
    idf = {w.decode(): x for w, x in index.idf.items()}
    vocabulary = sorted(idf)
    texts = [n for _, notices in TEMPLATES.values() for n in notices] + [t for *_, own in BODIES for t in own]
    words = []
    for _ in range(5):
        piece = rng.choice(texts).split()
        for _ in range(rng.randrange(6)):
            at = rng.randrange(len(piece))
            piece[at : at + rng.randrange(2)] = [rng.choice([*vocabulary, *["x"] * 30])]
        words += piece + rng.choices(vocabulary, k=rng.randrange(8))
    own = slow_words(" ".join(words))
    want = slow_finds(own, idf)
    got = index.find(words_of(" ".join(words).encode()))
    assert {a for a, *_ in got} == {a for a, *_ in want}
    # Each find is one that passes, with its score; each start that passes is a find or near one.
    for label, begin, end, score in got:
        assert any(a == label and abs(share - score) < 1e-9 and s - 3 <= begin <= end for a, s, share in want)
    for label, start, _ in want:
        assert any(a == label and begin - 9 <= start <= end for a, begin, end, _ in got)


def test_rarest_words_are_looked_up_first():
    """Of a notice's words only the rarest vote, as many as a find cannot all lack."""
    index = weighed()
    text = TEMPLATES["apache-2.0"][1][0]
    words = words_of(text.encode())
    places = {w: np.array([i for i, x in enumerate(words) if x == w]) for w in set(words) & index.vocabulary}
    notice = next(i for i, (a, w, _) in enumerate(index.notices) if a == "apache-2.0" and w == words)
    voted = index._votes([notice], places)[notice]
    rarest = sorted(places, key=lambda w: -index.idf[w])
    assert 0 < len(voted) < len(words) and all(0 in v for v in voted)
    weight, k = 0.0, 0
    while weight <= 0.3 * index.totals[notice]:
        weight += index.idf[rarest[k]] * words.count(rarest[k])
        k += 1
    assert len(voted) == sum(words.count(w) for w in rarest[:k])


@pytest.mark.parametrize("name,label", [("Lesser", "lgpl-3.0"), ("Affero", "agpl-3.0")])
def test_a_longer_name_is_not_the_shorter_licence(name, label):
    index = Index(TEMPLATES, BODIES)
    header = (
        "redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software "
        "Foundation, either version 3 of the License, or any later version"
    )
    got = labels(index, header.format(f"{name} General Public License"))
    assert "gpl-3.0" not in got and (label in got or label == "agpl-3.0")
    assert "gpl-3.0" in labels(index, header.format("General Public License"))
    both = header.format(f"{name} General Public License") + ". " + filler(random.Random(1), 30) + header.format("General Public License")
    assert "gpl-3.0" in labels(index, both)


MIT_BODY = """Copyright (c) 2020 A. Person

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""
ISC_BODY = """# Permission to use, copy, modify, and/or distribute this software for any
# purpose with or without fee is hereby granted, provided that the above
# copyright notice and this permission notice appear in all copies."""
LGPL_BODY = """ * This library is free software; you can redistribute it and/or
 * modify it under the terms of the GNU Lesser General Public
 * License as published by the Free Software Foundation; either
 * version 2.1 of the License, or (at your option) any later version."""
UNLICENSE_BODY = "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy"


def test_bodies_of_licences(spark):
    rng = random.Random(7)
    own = {1: (MIT_BODY, "mit"), 2: (ISC_BODY, "isc"), 3: (LGPL_BODY, "lgpl-2.1"), 4: (UNLICENSE_BODY, "unlicense")}
    for i, (label, _, texts) in enumerate(BODIES):
        own |= {100 + 10 * i + j: (t, label) for j, t in enumerate(texts)}
    rows = [(i, f"{filler(rng, 50)}\n{t}\n{filler(rng, 50)}") for i, (t, _) in own.items()]
    got = found(scan_licenses(docs(spark, rows + [(5000 + i, filler(rng, 60)) for i in range(40)])))
    for i, (_, label) in own.items():
        assert got[i][0] == {label}
    assert not any(got[5000 + i][0] for i in range(40))
