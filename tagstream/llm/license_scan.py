"""License notices by the places of their words, weighted by rarity.

Templates are short notices. A word weighs by its rarity over the whole corpus, and has postings:
the notices that hold it, and where. A file's licence words are looked up by falling rarity, and
each posting votes for the start that its place in the file would give the notice, give or take a
few words. A notice is looked up until the words that are missing or were looked up weigh more
than a find may lack: then every find starts where one of them has voted. At these starts the
postings of all words of the notice are intersected by position. What enough of its weight
stands at, and holds its mandatory key phrases, is a find. This leaves out no start that would
pass, however long the file is and whatever else it holds.

A key phrase that is part of another licence's longer name, where that name stands, does not count.

Only the texts of TEMPLATES and BODIES are sought: notices as they stand in a file's head, and
titles and opening passages of the usual licences. Other licences get no label but a phrase's.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagstream.llm.runtime import documents

# Phrases that name a licence, and the label of each.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Label, key phrases that must stand in a find, notices as commonly written.
TEMPLATES: dict[str, tuple[list[str], list[str]]] = {
    "agpl-3.0": (
        ["affero general public license"],
        [
            "licensed under the GNU Affero General Public License, version 3",
            "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        ],
    ),
    "apache-2.0": (
        ["apache license"],
        [
            "Licensed under the Apache License, Version 2.0",
            "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
            "except in compliance with the License",
        ],
    ),
    "bsd": (
        ["redistribution and use"],
        ["Redistribution and use in source and binary forms, with or without modification, are permitted"],
    ),
    "cc-by-4.0": (["cc by 4 0"], ["Licensed under CC BY 4.0"]),
    "cc-by-nc-4.0": (["cc by nc"], ["Licensed under CC BY-NC 4.0"]),
    "cc-by-sa-4.0": (["cc by sa"], ["Licensed under CC BY-SA 4.0"]),
    "cc0-1.0": (["cc0"], ["Released under CC0 1.0 Universal"]),
    "gpl-2.0": (
        ["general public license", "version 2"],
        ["This work is licensed under the GNU General Public License, version 2"],
    ),
    "gpl-3.0": (
        ["general public license", "version 3"],
        [
            "This work is licensed under the GNU General Public License, version 3",
            "under the terms of the GNU General Public License as published by the Free Software "
            "Foundation, either version 3 of the License",
        ],
    ),
    "mit": (
        ["mit license"],
        ["Released under the MIT License", "Licensed under the MIT License"],
    ),
    "mpl-2.0": (
        ["mozilla public license"],
        ["subject to the terms of the Mozilla Public License, v. 2.0"],
    ),
}

_HEADER = "redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation; {}"

# Label, key phrases that must stand in a find, titles and opening passages of licences.
BODIES: list[tuple[str, list[str], list[str]]] = [
    ("0bsd", ["with or without fee is hereby granted the software is provided"], [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted. THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES",
    ]),
    ("agpl-3.0", ["gnu affero general public license"], ["GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"]),
    ("apache-2.0", ["apache license", "version 2 0"], ["Apache License Version 2.0, January 2004"]),
    ("bsl-1.0", ["any person or organization obtaining a copy"], [
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the "
        "software and accompanying documentation covered by this license",
    ]),
    ("cc-by-4.0", ["creative commons attribution 4 0 international"], [
        "Creative Commons Attribution 4.0 International Public License",
    ]),
    ("cc-by-nc-4.0", ["creative commons attribution noncommercial 4 0 international"], [
        "Creative Commons Attribution-NonCommercial 4.0 International Public License",
    ]),
    ("cc-by-sa-4.0", ["creative commons attribution sharealike 4 0 international"], [
        "Creative Commons Attribution-ShareAlike 4.0 International Public License",
    ]),
    ("cc0-1.0", ["cc0 1 0 universal"], ["Creative Commons Legal Code CC0 1.0 Universal"]),
    ("epl-2.0", ["eclipse public license", "2 0"], [
        "Eclipse Public License - v 2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public "
        "License 2.0",
    ]),
    ("gpl-2.0", ["gnu general public license", "version 2"], [
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
        _HEADER.format("General Public License", "either version 2 of the License"),
    ]),
    ("gpl-3.0", ["gnu general public license", "version 3"], ["GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"]),
    ("isc", ["with or without fee is hereby granted provided that"], [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    ]),
    ("lgpl-2.1", ["gnu lesser general public license", "version 2 1"], [
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
        _HEADER.format("Lesser General Public License", "either version 2.1 of the License"),
    ]),
    ("lgpl-3.0", ["gnu lesser general public license", "version 3"], [
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        _HEADER.format("Lesser General Public License", "either version 3 of the License"),
    ]),
    ("mit", ["permission is hereby granted free of charge", "deal in the software without restriction"], [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software",
    ]),
    ("mpl-2.0", ["mozilla public license", "2 0"], ["Mozilla Public License Version 2.0"]),
    ("unlicense", ["unencumbered software released into the public domain"], [
        "This is free and unencumbered software released into the public domain",
    ]),
    ("zlib", ["permission is granted to anyone to use this software"], [
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, "
        "and to alter it and redistribute it freely",
    ]),
]

# Shares of a notice's weight that stand exactly at a start for it to be a find beside a better one within
# SLACK words, and that must stand there at all; words a place may differ by.
VOTE_SHARE = 0.2
LEAST_SHARE = 0.7
SLACK = 3
# Sums of weights in another order may differ by this share; what passes with it is verified.
ROUNDING = 1e-9
# The score of a file in which a phrase stands but no notice.
PHRASE_SCORE = 0.5

_RESULT = (
    "doc_id bigint, n_words bigint, places array<struct<label: string, start: bigint>>, "
    "found array<struct<label: string, start: bigint, end: bigint, score: double>>"
)


def _blanks() -> bytes:
    """A to Z in lower case, every other ASCII character that is no letter or digit as a blank."""
    keep = set(range(ord("0"), ord("9") + 1)) | set(range(ord("a"), ord("z") + 1)) | set(range(128, 256))
    table = bytearray(c if c in keep else 32 for c in range(256))
    for c in range(ord("A"), ord("Z") + 1):
        table[c] = c + 32
    return bytes(table)


_TABLE = _blanks()


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def phrase_places(words: list[bytes], phrases: Mapping[str, str]) -> list[tuple[str, int]]:
    """Label and first word of every place where a phrase stands."""
    line = b" " + b" ".join(words) + b" "
    places = []
    for phrase, label in phrases.items():
        sought = b" " + phrase.encode() + b" "
        at, seen, word = line.find(sought), 0, 0
        while at >= 0:
            word += line.count(b" ", seen, at)
            places.append((label, word))
            seen, at = at, line.find(sought, at + 1)
    return sorted(places, key=lambda p: (p[1], p[0]))


class Index:
    """The notices and their words, weighted by how rare each word is in the corpus."""

    def __init__(
        self,
        templates: Mapping[str, tuple[list[str], list[str]]],
        bodies: Sequence[tuple[str, list[str], list[str]]] = (),
    ):
        self.notices = [
            (label, words_of(text.encode()), [words_of(k.encode()) for k in keys])
            for label, keys, texts in [*((label, *t) for label, t in templates.items()), *bodies]
            for text in texts
        ]
        self.vocabulary = frozenset(w for _, words, _ in self.notices for w in words)
        self.postings: dict[bytes, list[tuple[int, int]]] = {w: [] for w in self.vocabulary}
        for notice, (_, words, _) in enumerate(self.notices):
            for at, word in enumerate(words):
                self.postings[word].append((notice, at))
        names: dict[str, list[list[bytes]]] = {}
        for label, _, keys in self.notices:
            names.setdefault(label, []).extend(keys)
        # Longer names that hold a key phrase that is a name, and are none of the same licence's.
        self.longer = {
            (label, tuple(key)): [
                (at, other)
                for others in names.values()
                for other in others
                if b"license" in key and len(other) > len(key) and other not in names[label]
                for at in _places(other, key)
            ]
            for label, _, keys in self.notices
            for key in keys
        }
        self.weigh(Counter(), 0)

    def weigh(self, frequencies: Mapping[bytes, int], n: int) -> None:
        self.idf = {w: float(np.log((2 + n) / (1 + frequencies.get(w, 0)))) for w in self.vocabulary}
        self.totals = [sum(self.idf[w] for w in words) for _, words, _ in self.notices]

    def find(self, words: list[bytes]) -> list[tuple[str, int, int, float]]:
        """Label, first word, last word and score of every notice found."""
        own = self.vocabulary.intersection(words)
        # A notice is out of reach if all its words that the file has weigh too little.
        reach = [sum(self.idf[w] for w in template if w in own) for _, template, _ in self.notices]
        near = [n for n, (r, t) in enumerate(zip(reach, self.totals)) if 0 < LEAST_SHARE * t <= r + ROUNDING * t]
        if not near:
            return []
        places: dict[bytes, list[int]] = {w: [] for w in own}
        for place, word in enumerate(words):
            if word in own:
                places[word].append(place)
        arrays = {w: np.array(p, np.int64) for w, p in places.items()}
        found = []
        for notice, voted in self._votes(near, arrays).items():
            found += self._found(words, notice, voted, arrays)
        best: dict[tuple[str, int, int], float] = {}
        for label, begin, end, score in found:
            best[label, begin, end] = max(score, best.get((label, begin, end), 0.0))
        return sorted((label, begin, end, score) for (label, begin, end), score in best.items())

    def _votes(self, near: list[int], places: Mapping[bytes, np.ndarray]) -> dict[int, list[np.ndarray]]:
        """Starts that the file's rarest words give each of the notices."""
        voted: dict[int, list[np.ndarray]] = {n: [] for n in near}
        # What is missing from a find weighs 1 - LEAST_SHARE at most, so of words that weigh more one is there.
        seen = {n: sum(self.idf[w] for w in self.notices[n][1] if w not in places) for n in near}
        still = set(near)
        for word in sorted(places, key=lambda w: (-self.idf[w], w)):
            for notice, at in self.postings[word]:
                if notice in still:
                    voted[notice].append(places[word] - at)
                    seen[notice] += self.idf[word]
            still = {n for n in still if seen[n] <= (1 - LEAST_SHARE + ROUNDING) * self.totals[n]}
            if not still:
                break
        return voted

    def _found(self, words: list[bytes], notice: int, voted: list[np.ndarray], places: Mapping[bytes, np.ndarray]):
        """Finds of one notice. Of starts within SLACK words of each other the one with most weight exactly
        there is taken, and those with VOTE_SHARE of it; every start that passes is one of these or near one."""
        starts, exact, held = self._starts(notice, voted, places)
        enough, kept, found = VOTE_SHARE * self.totals[notice], set(), []
        for i in np.lexsort((starts, -held, -exact)):
            start = int(starts[i])
            beside = any(start + d in kept for d in range(-SLACK, SLACK + 1))
            if exact[i] >= enough or not beside:
                finds = self._verified(words, notice, start)
                found += finds
                if finds:
                    kept.add(start)
        return found

    def _starts(
        self, notice: int, voted: list[np.ndarray], places: Mapping[bytes, np.ndarray]
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the starts voted for those at which enough of the notice stands: start, weight exactly there,
        weight within SLACK words."""
        template, total = self.notices[notice][1], self.totals[notice]
        starts = [v[:, None] + np.arange(-SLACK, SLACK + 1) for v in voted]
        starts = np.unique(np.concatenate([s.ravel() for s in starts])) if starts else np.zeros(0, np.int64)
        exact, held = np.zeros(len(starts)), np.zeros(len(starts))
        for at, word in enumerate(template):
            own = places.get(word)
            if own is not None and len(starts):
                low = np.searchsorted(own, starts + at - SLACK)
                held += self.idf[word] * (np.searchsorted(own, starts + at + SLACK, side="right") > low)
                exact += self.idf[word] * (own[np.minimum(np.searchsorted(own, starts + at), len(own) - 1)] == starts + at)
        passing = held >= (LEAST_SHARE - ROUNDING) * total
        return starts[passing], exact[passing], held[passing]

    def _verified(self, words: list[bytes], notice: int, start: int) -> list[tuple[str, int, int, float]]:
        label, template, keys = self.notices[notice]
        begin, end = max(0, start - SLACK), start + len(template) + SLACK
        held, places = 0.0, []
        for at, word in enumerate(template):
            near = range(max(0, start + at - SLACK), min(len(words), start + at + SLACK + 1))
            place = min((p for p in near if words[p] == word), key=lambda p: abs(p - start - at), default=None)
            if place is not None:
                held += self.idf[word]
                places.append(place)
        share = held / self.totals[notice] if self.totals[notice] else 0.0
        if share < LEAST_SHARE or not all(self._names(words, begin, end, label, k) for k in keys):
            return []
        return [(label, min(places), max(places), min(share, 1.0))]

    def _names(self, words: list[bytes], begin: int, end: int, label: str, key: list[bytes]) -> bool:
        """Whether the key phrase stands between the two places, and not as a part of a longer name."""
        longer = self.longer[label, tuple(key)]
        for i in _places(words[begin:end], key):
            i += begin
            if not any(i >= at and words[i - at : i - at + len(other)] == other for at, other in longer):
                return True
        return False


def _places(words: list[bytes], phrase: list[bytes]) -> list[int]:
    return [i for i in range(len(words) - len(phrase) + 1) if words[i : i + len(phrase)] == phrase]


def _word_frequencies(rows: DataFrame, index: Index) -> tuple[dict[bytes, int], int]:
    """In how many of all documents each licence word stands; one sum per word comes back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = Counter(), 0
        for batch in batches:
            for text in batch.column("text").cast(pa.binary()):
                held.update(index.vocabulary.intersection(words_of(text.as_py() or b"")))
                n += 1
        items = [(w.decode(), c) for w, c in held.items()] + [("", n)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in items], pa.string()), pa.array([c for _, c in items], pa.int64())],
            names=["word", "n"],
        )

    sums = rows.select("text").mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counts = {w.encode(): n for w, n in sums.collect()}
    return counts, counts.pop(b"", 0)


def scan_licenses(
    docs: DataFrame,
    templates: Mapping[str, tuple[list[str], list[str]]] = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES,
    doc_id: str = "doc_id",
    text: str = "text",
    bodies: Sequence[tuple[str, list[str], list[str]]] = BODIES,
) -> DataFrame:
    """``doc_id, n_words, places, found`` per row.

    ``places`` are the phrases' places, ``found`` the notices and passages with their first and last word
    and the share of their weight that is there. A null text is empty and has neither; null
    identifiers are carried through; repeated rows are scanned each.
    """
    rows = documents(docs, doc_id, text)
    index = Index(templates, bodies)
    index.weigh(*_word_frequencies(rows, index))
    held, sought = docs.sparkSession.sparkContext.broadcast(index), dict(phrases)
    last = {p.rpartition(" ")[2].encode() for p in sought}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held.value
        for batch in batches:
            counts, places, found = [], [], []
            for text in batch.column("text").cast(pa.binary()):
                words = words_of(text.as_py() or b"")
                counts.append(len(words))
                named = not last.isdisjoint(words)
                places.append(
                    [{"label": a, "start": b} for a, b in (phrase_places(words, sought) if named else [])]
                )
                found.append(
                    [{"label": a, "start": b, "end": c, "score": d} for a, b, c, d in index.find(words)]
                )
            place = pa.struct([("label", pa.string()), ("start", pa.int64())])
            find = pa.struct(
                [("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(places, pa.list_(place)),
                    pa.array(found, pa.list_(find)),
                ],
                names=["doc_id", "n_words", "places", "found"],
            )

    return rows.mapInArrow(run, _RESULT)
