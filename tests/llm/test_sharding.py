"""Sharding: the matrix's laws, exact shard sizes, all rows kept."""

import zlib
from collections import Counter
from math import comb

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from noticeboard.llm import sharding


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=9), st.integers(1, 5), st.integers(1, 9), st.integers(0, 99))
def test_rows_and_columns_of_the_matrix_sum_up(counts, shards, bucket, seed):
    sizes = sharding.layout(sum(counts), shards, bucket)["size"].to_numpy(np.int64)
    matrix = sharding.Matrix(np.array(counts), sizes, seed)
    rows = np.array([matrix.row(b) for b in range(len(counts))])
    assert (rows >= 0).all() and rows.sum(0).tolist() == sizes.tolist() and rows.sum(1).tolist() == counts
    for b in range(len(counts)):
        assert np.bincount(matrix.deal(b), minlength=len(sizes)).tolist() == rows[b].tolist()


def test_cells_are_hypergeometric():
    counts, sizes = np.array([4, 3, 5]), np.array([6, 6])
    seen = Counter(int(sharding.Matrix(counts, sizes, seed).row(1)[0]) for seed in range(4000))
    for k in range(4):
        expected = comb(6, k) * comb(6, 3 - k) / comb(12, 3)
        assert abs(seen[k] / 4000 - expected) < 0.03


@pytest.mark.parametrize("good,bad,taken", [(30, 50, 20), (5, 200, 100), (400, 3, 200), (7, 9, 16), (7, 9, 0)])
def test_own_draws_follow_the_law(good, bad, taken):
    rng = np.random.default_rng(5)
    seen = Counter(sharding.draw(good, bad, taken, rng, limit=1) for _ in range(5000))
    for k in range(good + 1):
        expected = comb(good, k) * comb(bad, taken - k) / comb(good + bad, taken) if 0 <= taken - k <= bad else 0
        assert abs(seen[k] / 5000 - expected) < 0.03
        assert expected or not seen[k]


def test_large_sums_are_split_exactly():
    sizes = np.array([3 * 10**9, 2, 5 * 10**9 + 1, 0])
    got = sharding.split(sizes, 4 * 10**9, np.random.default_rng(1))
    assert got.sum() == 4 * 10**9 and (got <= sizes).all() and abs(got[0] - 1.5e9) < 10**6


def _check(rows, got, shards):
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(shards)) <= 1
    for shard, n in sizes.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))


def test_documents_in_shards(documents):
    rows = [(i if i % 9 else None, [None, "", "same", "é" * i][i % 4], "en", "s") for i in range(500)] + [(7, "same", "en", "s")] * 30
    got = sharding.shard_documents(documents(rows), 16).collect()
    _check(rows, got, 16)
    text = lambda t: (t or "").encode()
    assert Counter((r.size, r.text_crc32, r.law, r.grown_shard) for r in got) == Counter((len(text(r[1])) + 1, zlib.crc32(text(r[1])), "rows", None) for r in rows)


def test_small_blocks_and_buckets_and_all_columns(spark, documents):
    rows = [(i, f"text {i}", "en", "hot" if i % 3 else "s") for i in range(400)]
    docs = documents(rows).repartition(7)
    out = sharding.shuffle(docs.withColumnRenamed("row", "shard"), 3, bucket=10, block_bits=4)
    assert out.columns == [c for c in docs.columns if c != "row"] + ["shard", "slot"]
    got = out.collect()
    _check(rows, got, 3)
    assert all(r.text == f"text {r.doc_id}" for r in got)


def test_every_place_is_as_likely(spark):
    docs = spark.range(8).selectExpr("id AS doc_id", "'t' AS text").coalesce(2)
    seen = Counter()
    for seed in range(60):
        for r in sharding.shuffle(docs, 2, seed, bucket=3, block_bits=1).collect():
            seen[r.doc_id, r.shard] += 1
    assert all(14 <= seen[d, s] <= 46 for d in range(8) for s in range(2))


def test_no_rows_and_more_shards_than_rows(documents):
    assert sharding.shard_documents(documents([])).count() == 0
    rows = [(i, "t", "en", "s") for i in range(3)]
    _check(rows, sharding.shard_documents(documents(rows)).collect(), 16)
