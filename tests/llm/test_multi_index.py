"""Multi-index: the walk against sorting all cells, recall and ranks against brute force."""

import math

import numpy as np
import pytest

from noticeboard.llm import multi_index


def test_the_walk_takes_cells_by_distance():
    rng = np.random.default_rng(0)
    for _ in range(50):
        a, b = rng.random(9), rng.random(6)
        counts = rng.integers(0, 5, 54)
        wanted = int(rng.integers(1, counts.sum() + 1))
        order = np.argsort((a[:, None] + b).ravel(), kind="stable")
        full = order[counts[order] > 0]
        n = np.searchsorted(np.cumsum(counts[full]), wanted) + 1
        assert multi_index.walk(a, b, counts, wanted) == full[:n].tolist()


def _brute(rows, every=50, k=5):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good.setdefault(i, np.array(v, np.float32).astype(float))
    out = {}
    for q, x in good.items():
        if q % every == 0:
            scored = [(-multi_index._cosine(x, y), i) for i, y in good.items() if i != q]
            out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def _got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def _vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, rank string")


def test_recall_and_scores_on_a_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    want, got = _brute(rows), _got(multi_index.search(table))
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (5 * len(want)) >= 0.9
    exact = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    for q, found in got.items():
        assert all(math.isclose(s, exact[q] @ exact[i] / np.linalg.norm(exact[q]) / np.linalg.norm(exact[i]), abs_tol=1e-12) for i, s in found)
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))


def test_everything_visited_is_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=7).tolist()) for i in range(300)]
    rows += [(300 + i, rows[i % 3][1]) for i in range(60)]  # ties
    assert _got(multi_index.search(_vectors(spark, rows), share=1.0)) == _brute(rows)


def test_odd_vectors_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (50, [0.0, 0.0]), (100, None), (150, [float("nan"), 1.0]), (200, [1.0, None]), (250, [float("inf"), 1.0]), (300, []), (None, [1.0, 1.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [1.0, 2.0, 3.0]), (350, [0.0, 1.0])]
    got = _got(multi_index.search(_vectors(spark, rows), share=1.0))
    assert {q: [i for i, _ in v] for q, v in got.items()} == {0: [1, 350], 350: [1, 0]}


def test_one_hot_vector(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [1.0, 2.0, 3.0, 4.0] if i % 3 else rng.normal(size=4).tolist()) for i in range(600)]
    got = _got(multi_index.search(_vectors(spark, rows), share=1.0))
    assert got == _brute(rows)
    assert [i for i, _ in got[50]] == [1, 2, 4, 5, 7]


def test_nothing_that_grows_is_broadcast(spark):
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(600)]
    found = multi_index.search(_vectors(spark, rows), share=1.0)
    assert _got(found) == _brute(rows)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind", ["float", "double"])
def test_many_shards(spark, monkeypatch, kind):
    monkeypatch.setattr(multi_index, "LEAST", 16)
    rng = np.random.default_rng(11)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(500)]
    rows += [(500 + i, rows[i % 50][1]) for i in range(100)]  # ties, queries among them
    table = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    assert _got(multi_index.search(table, every=7, share=1.0)) == _brute(rows, every=7)
    assert multi_index.search(table, every=7).groupBy("query_id").count().filter("count != 5").count() == 0


def test_shards_are_bounded_and_in_order():
    rng = np.random.default_rng(13)
    for size in (1, 7, 50):
        counts = rng.integers(0, 30, 80) * rng.integers(0, 2, 80)
        counts[40] = 333
        first, last = multi_index.shards(counts, size)
        assert (np.diff(first) >= 0).all() and (np.diff(last) >= 0).all() and (first <= last).all()
        held = np.zeros(last.max() + 1)
        for c, (a, b) in enumerate(zip(first, last)):
            held[a : b + 1] += counts[c] / (b - a + 1)
        assert held.sum() == pytest.approx(counts.sum()) and held.max() <= 2 * size


def test_the_nearest_of_pieces(monkeypatch):
    rng = np.random.default_rng(17)
    for piece in (1, 5, 64, 1000):
        monkeypatch.setattr(multi_index, "PIECE", piece)
        x, cell = rng.normal(size=(200, 5)).astype(np.float32), np.sort(rng.integers(0, 9, 200))
        x[100:140] = x[60:100] * 2  # the same direction
        vec, seen = rng.permutation(200), rng.random((6, 9)) < 0.6
        seen[5] = False
        ids, q = np.array([*vec[:3], 900, 901, 902]), np.concatenate((x[:3], rng.normal(size=(3, 5)))).astype(float)
        got = list(multi_index.nearest(list(multi_index.pieces(vec, cell, x)), ids, q, seen, 4))
        want = []
        for r, query in enumerate(ids.tolist()):
            scored = [(-multi_index._cosine(q[r], x[i].astype(float)), int(vec[i])) for i in range(200) if seen[r, cell[i]] and vec[i] != query]
            want += [(query, v, -s) for s, v in sorted(scored)[:4]]
        assert got == want


@pytest.mark.parametrize("rows", [[], [(0, [1.0])], [(1, [1.0]), (2, [2.0])]])
def test_tiny_tables(spark, rows):
    assert _got(multi_index.search(_vectors(spark, rows))) == {}
