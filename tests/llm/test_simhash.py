import random
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from tagstream.llm.components import components
from tagstream.llm.simhash import _segments, fingerprint, links, near_duplicates, one_of_each, wildcard_keys
from tests.llm.tables import clashing, docs

BLANK = re.compile(r"[\x20\x09-\x0D]+")


def slow_fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in BLANK.split(lower) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, distance):
    """Smallest index reachable from each, by brute force."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def test_fingerprint():
    texts = ["", "one", "Two words", "A b C d", "ÄÖ É x\x0by\x1cz a b", "w " * 40_000, "q\n\nr\ts u v"]
    for t in texts + [" ".join(random.Random(i).choices("abcdef", k=i)) for i in range(60)]:
        assert fingerprint(t.encode()) == signed(slow_fingerprint(t))


def test_spark_hash_is_the_same(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()
    assert row[0] == signed(xxhash.xxh64(b"a b c", seed=42).intdigest())


def values(seed, crowded):
    """Fingerprints in clusters; crowded ones differ in few bits of one segment only."""
    rng = random.Random(seed)
    out = set()
    for _ in range(8):
        centre = rng.getrandbits(64)
        for _ in range(12):
            value = centre
            for _ in range(rng.randint(0, 4)):
                value ^= 1 << rng.randrange(20 if crowded else 64)
            out.add(value)
    return sorted(out | {0, 1, 3, (1 << 64) - 1})


@pytest.mark.parametrize("distance", [1, 2])
@pytest.mark.parametrize("crowded", [False, True])
def test_links_as_brute_force(spark, distance, crowded):
    own = values(distance, crowded)
    frame = spark.createDataFrame([(signed(v),) for v in own], "h bigint")
    found = {(r.a, r.b) for r in links(frame, distance).collect()}
    for a, b in found:
        assert (a ^ b).bit_count() <= distance if a >= 0 and b >= 0 else True
    joined = {r.node: r.root for r in components(links(frame, distance)).collect()}
    got = Counter(joined.get(signed(v), signed(v)) for v in own)
    want = Counter(groups(own, distance))
    assert sorted(got.values()) == sorted(want.values())
    by_group = {}
    for v, g in zip(own, groups(own, distance)):
        assert by_group.setdefault(g, joined.get(signed(v), signed(v))) == joined.get(signed(v), signed(v))


@pytest.mark.parametrize("most", [1, 2, 8])
@pytest.mark.parametrize("crowded", [False, True])
def test_full_segments_as_brute_force(spark, crowded, most):
    """Values of a segment that many fingerprints hold are not indexed, and no link is lost by it."""
    own = values(5, crowded)
    frame = spark.createDataFrame([(signed(v),) for v in own], "h bigint")
    joined = {r.node: r.root for r in components(links(frame, 2, most)).collect()}
    want, found = {}, {}
    for v, g in zip(own, groups(own, 2)):
        want.setdefault(g, set()).add(v)
        found.setdefault(joined.get(signed(v), signed(v)), set()).add(v)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, found.values()))


def test_one_key_per_bit(spark):
    frame = spark.createDataFrame([(signed(v),) for v in (0, 1 << 63, (1 << 64) - 1)], "h bigint")
    for segments in (1, 2):
        rows = wildcard_keys(_segments(frame, segments), segments).collect()
        bits = {r.key.bit if segments == 1 else r.key >> 32 for r in rows}
        assert len(rows) == 3 * 64 and bits == set(range(64))


def test_keys_are_shuffled_once(spark):
    frame = spark.createDataFrame([(signed(v),) for v in values(1, False)], "h bigint")
    keys = wildcard_keys(_segments(frame, 2), 2)
    assert dict(keys.dtypes) == {"key": "bigint", "h": "bigint"}
    groups = keys.repartition("key").groupBy("key").agg(F.collect_list("h"))
    assert groups._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1


def texts(seed=1):
    rng = random.Random(seed)
    base = [" ".join(rng.choices(["alpha", "beta", "Gamma", "delta", "eps"], k=rng.randint(0, 120))) for _ in range(25)]
    near = [t + " tail" for t in base if rng.random() < 0.5]
    return base + near + base[:5] + [None, "", " \n", "x", "X"]


def test_near_duplicates_as_brute_force(spark):
    own = texts()
    got = {r.doc_id: r.component_id for r in near_duplicates(clashing(docs(spark, own))).collect()}
    assert got == dict(enumerate(groups([slow_fingerprint(t) for t in own], 2)))


def test_kept_rows(spark):
    own = texts(2)
    frame = clashing(docs(spark, own))
    kept = one_of_each(frame, near_duplicates(frame))
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(groups([slow_fingerprint(t) for t in own], 2)))


def test_null_identifiers_and_repeated_rows(spark):
    rows = [(None, "a b c d"), (7, "a b c d"), (7, "a b c d"), (None, "quite other words"), (None, "yet more of them here")]
    frame = docs(spark, rows)
    found = near_duplicates(frame)
    assert sorted((r.component_id for r in found.collect()), key=str) == [7, 7, 7, None, None]
    assert sorted((r.text for r in one_of_each(frame, found).collect())) == ["a b c d", "quite other words", "yet more of them here"]


def test_empty_table(spark):
    frame = docs(spark, [])
    assert near_duplicates(frame).collect() == [] and one_of_each(frame, near_duplicates(frame)).collect() == []


@pytest.mark.parametrize("shape", ["path", "star", "ring", "mixed"])
def test_components(spark, shape):
    rng = random.Random(shape)
    # Long paths and rings decide the number of rounds; stars and mixed graphs take few at any size.
    n = 200 if shape in ("path", "ring") else 70
    edges = {
        "path": [(i, i + 1) for i in range(n)],
        "star": [(n, i) for i in range(n)],
        "ring": [(i, (i + 1) % n) for i in range(n)],
        "mixed": [(rng.randrange(n), rng.randrange(n)) for _ in range(n // 2)],
    }[shape]
    label = list(range(n + 1))
    for _ in range(n + 1):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got.get(i, i) == label[i] for i in range(n + 1))
    assert len(got) == sum(label[i] != i for i in range(n + 1))
