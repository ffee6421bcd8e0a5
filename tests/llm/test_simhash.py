"""Near copies: fingerprints by definition, Golay keys for every error, links and groups by brute force."""

import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from noticeboard.llm import simhash
from noticeboard.llm.common import components


def _plain_fingerprint(text, k):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)] * bool(words)
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


TEXTS = ["", None, "One", "one TWO", "a b c d e É é\x0bf g h", "x " * 9000, "the cat sat on the mat and the cat sat on the mat again"]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    for k in (1, 3, 5):
        assert simhash.majority(simhash.hashes(simhash.shingles(None if text is None else text.encode(), k))) == _plain_fingerprint(text, k)


def test_spark_hashes_shingles_alike(spark):
    parts = ["one two three", "é ü", ""]
    got = [r.h for r in spark.createDataFrame([(p,) for p in parts], "t string").select(F.xxhash64("t").alias("h")).collect()]
    assert got == [simhash.signed(xxhash.xxh64_intdigest(p.encode(), 42)) for p in parts]


def test_a_word_has_one_or_six_codewords_within_four_bits():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 1 << 23, 20_000)
    near = simhash.codewords(words)
    counts = (near >= 0).sum(1)
    assert set(counts.tolist()) == {1, 6} and abs((counts == 6).mean() - 1771 / 2048) < 0.01


def test_words_one_bit_apart_meet():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 3000)
    first = simhash.codewords(words)[:, 0]
    for bit in range(23):
        other = simhash.codewords(words ^ (1 << bit))
        assert (other == first[:, None]).any(1).all()


def _meet(x, y):
    a, b = simhash.keys(np.array([x, y], np.uint64))
    return any(a[i, 0] in b[i][b[i] >= 0] for i in range(3))


def test_every_two_errors_leave_a_common_key():
    rng = random.Random(2)
    for x in [0, (1 << 64) - 1, *(rng.getrandbits(64) for _ in range(4))]:
        for a, b in itertools.combinations(range(64), 2):
            assert _meet(x, x ^ (1 << a) ^ (1 << b)) and _meet(x, x ^ (1 << a))


def _brute_classes(fps):
    """Smallest id reachable over links of two bits at most."""
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(fps)), 2):
        if bin((fps[i] ^ fps[j]) & (1 << 64) - 1).count("1") <= 2:
            a, b = root(i), root(j)
            parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


@pytest.mark.parametrize("pairwise", [64, 2])
def test_classes(spark, monkeypatch, pairwise):
    monkeypatch.setattr(simhash, "PAIRWISE", pairwise)
    rng = random.Random(4)
    fps = [0, 0, 1, (1 << 64) - 1]
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(25):  # chains and clouds, some hot under one key
            fps.append(x)
            for _ in range(rng.randrange(0, 5)):
                x ^= 1 << rng.randrange(64)
    rows = spark.createDataFrame([(i, simhash.signed(f)) for i, f in enumerate(fps)], "doc_id long, fp long")
    got = {r.doc_id: r.component_id for r in simhash.classes(rows).collect()}
    assert [got[i] for i in range(len(fps))] == _brute_classes(fps)


def test_components_of_long_chains(spark):
    n = 300
    edges = [(i, i + 1) for i in range(n - 1)] + [(1000 + i, 1000 + (i + 1) % 50) for i in range(50)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long").repartition(4)).collect()}
    assert all(got[i] == 0 for i in range(1, n)) and 0 not in got and set(got.values()) == {0, 1000}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_near_duplicates(texts, documents):
    got = {r.doc_id: r for r in simhash.near_duplicates(texts(*TEXTS, TEXTS[-1].upper(), None)).collect()}
    for i, text in enumerate([*TEXTS, TEXTS[-1].upper(), None]):
        assert got[i].fingerprint == f"{_plain_fingerprint(text, 3):016x}"
    fps = [int(got[i].fingerprint, 16) for i in range(len(got))]
    assert [got[i].component_id for i in range(len(got))] == _brute_classes(fps)
    odd = simhash.near_duplicates(documents([(None, "a b c d", "en", "s"), (7, "a b c d", "en", "s"), (7, "a b c d", "en", "s"), (None, "zz y", "en", "s")])).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in odd) == [("7", "7"), ("7", "7"), ("None", "7"), ("None", "None")]
    assert simhash.near_duplicates(documents([])).count() == 0


def test_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = simhash.near_duplicates(docs).orderBy("doc_id").collect()
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    assert [r.fingerprint for r in rows[:60]] == [f"{_plain_fingerprint(t, 3):016x}" for t in texts[:60]]
    assert [r.component_id for r in rows] == _brute_classes([int(r.fingerprint, 16) for r in rows])


def _brute_kept(texts, k=3):
    """Places of the texts that are the first of their group, by comparing all fingerprints."""
    fps = np.array([_plain_fingerprint(t, k) for t in texts], np.uint64)
    root = list(range(len(fps)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[:i] ^ fps[i]) <= 2).tolist():
            a, b = top(i), top(j)
            root[max(a, b)] = min(a, b)
    return {i for i in range(len(fps)) if top(i) == i}


def test_deduplicate_a_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    rows = docs.orderBy("doc_id").collect()
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {rows[i].doc_id for i in _brute_kept([r.text for r in rows])}


def test_deduplicate_edited_copies(texts):
    rng = random.Random(8)
    found = []
    for n in (200, 900, 3000):
        words = [f"w{rng.randrange(3000)}" for _ in range(n)]
        for _ in range(12):
            other = list(words)
            for _ in range(rng.randrange(0, n // 100 + 1)):
                other[rng.randrange(n)] = f"x{rng.randrange(3000)}"
            found.append(" ".join(other))
    found += ["short text", "short  TEXT", "short test", "", None, " "]
    kept = {r.doc_id for r in simhash.deduplicate(texts(*found)).collect()}
    assert kept == _brute_kept(found) and len(kept) < len(found) - 12


def test_deduplicate_odd_ids(documents):
    a, b, c = "a b c d e f", "other words", "no id here"
    rows = [(None, a, "en", "s"), (None, a, "en", "s"), (3, a, "en", "s"), (3, a, "en", "s"), (2, a, "en", "s"), (2, a, "en", "s"), (9, b, "en", "s"), (9, c, "en", "s"), (None, "x y z", "en", "s"), (None, "x y z", "en", "s")]
    got = sorted((str(r.doc_id), r.text) for r in simhash.deduplicate(documents(rows)).collect())
    assert got == [("2", a), ("9", c), ("9", b), ("None", "x y z")]
    assert simhash.deduplicate(documents([])).count() == 0
