"""Toxicity: search against all examples, held-out accuracy, edge texts."""

import math
import random
import zlib
from collections import Counter

import numpy as np

from noticeboard.llm import toxicity


def _random_index(seed, n=700, kinds=40):
    rng = random.Random(seed)
    idf = {toxicity.ALL: (0, 2.0)} | {f"w{i}": (i + 1, 1 + rng.random() * 4) for i in range(kinds)}
    texts = [Counter({f"w{rng.randrange(kinds + 5)}": rng.randrange(1, 4) for _ in range(rng.randrange(0, 9))}) for _ in range(n)]
    examples = [(i, int(rng.random() < 0.3), toxicity.vector(c, idf)) for i, c in enumerate(texts)]
    return idf, examples, toxicity.build(idf, examples, 0.1, {0: 1.0, 1: 1.0}), rng


def test_the_search_is_exact():
    idf, examples, index, rng = _random_index(3)
    dense = np.zeros((len(examples), len(idf)))
    for i, _, vec in examples:
        for t, x in vec:
            dense[i, t] = x
    for _ in range(200):
        vec = toxicity.vector(Counter({f"w{rng.randrange(45)}": rng.randrange(1, 4) for _ in range(rng.randrange(1, 9))}), idf)
        q = np.zeros(len(idf))
        for t, x in vec:
            q[t] = x
        want = sorted((dense @ q)[dense @ q > 0], reverse=True)[: toxicity.NEIGHBOURS]
        found = toxicity.nearest(vec, index)
        assert np.allclose([s for s, _ in found], want)
        for s, p in found:
            assert math.isclose(s, dense[index.ids[p]] @ q)


def test_blocks_are_skipped():
    idf, examples, index, rng = _random_index(5, n=3000)
    before = [len(p) for p in index.bounds]
    assert index.peaks.shape[1] == -(-sum(bool(v) for _, _, v in examples) // toxicity.BLOCK) and before[0] == index.peaks.shape[1] + 1
    for t, (places, weights) in enumerate(index.postings):
        for b in range(index.peaks.shape[1]):
            inside = weights[(places // toxicity.BLOCK) == b]
            assert index.peaks[t, b] == (inside.max() if len(inside) else 0)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = toxicity.score_toxicity(spark.read.parquet(f"{sf}/documents.parquet"), labels).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in held)
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.93


def _rows():
    clean = [(i, f"plain words number{i % 7} here and there again", "en", "s") for i in range(60)]
    return clean + [(100 + i, f"you utter scoundrel number{i % 7} here", "en", "s") for i in range(30)]


def test_edges(spark, documents):
    rows = _rows()
    odd = [(500, None, "en", "s"), (501, "", "en", "s"), (502, "12 ?!", "en", "s"), (None, "utter scoundrel you", "en", "s"), (503, "scoundrel " * 20_000, None, None), (100, "you utter scoundrel number0 here", "en", "s")]
    labels = spark.createDataFrame([(r[0], 1, int(r[0] >= 100)) for r in rows] + [(None, 1, 1), (777, 1, 1), (0, 1, 0), (1, 1, None), (2, 1, 7)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.score_toxicity(documents(rows + odd), labels).collect()}
    assert got[None].predicted == 1 and got[503].predicted == 1 and got[100].predicted == 1 and got[0].predicted == 0
    assert got[500].score == got[501].score and got[500].evidence == []
    assert got[None].evidence and all(i >= 100 for i in got[None].evidence)


def test_nothing_to_learn_from(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.score_toxicity(documents([(1, "a", "en", "s"), (2, None, "en", "s")]), none).collect()
    assert [r.predicted for r in got] == [0, 0]
    assert toxicity.score_toxicity(documents([]), none).count() == 0


def test_of_equally_near_examples_a_blind_choice_votes():
    idf = {"*": (0, 1.0)}
    for clean, toxic in ((20, 180), (40, 40)):
        rows = [(i, int(i % (clean + toxic) >= clean), [(0, 1.0)]) for i in range(clean + toxic)]
        index = toxicity.build(idf, rows, toxic / (clean + toxic), {0: 1.0, 1: 1.0})
        share = toxicity.score(toxicity.nearest([(0, 1.0)], index), index)
        assert abs(share - toxic / (clean + toxic)) < 0.25
