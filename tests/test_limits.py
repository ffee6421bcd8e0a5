"""Limits against a row-by-row replay, with one site holding most rows."""

import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from noticeboard.model import Limits
from noticeboard.operators import limits


def _rows(seed=3, n=4000):
    rng = random.Random(seed)
    rows, pos = [], {}
    for key in range(n):
        site = "hot" if rng.random() < 0.6 else f"s{rng.randrange(12)}"
        page = rng.randrange(3000) if site == "hot" else rng.randrange(6)
        item = pos[site, page] = pos.get((site, page), -1) + 1
        rows.append((key, site, f"c{rng.randrange(3)}", page, item * (1 if page % 2 else 700), rng.random() < 0.01))
    return rows


ROWS = _rows()


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, "key int, site string, category string, page_no int, item_pos int, hit boolean").repartition(6)


def _keys(df):
    return {r.key for r in df.select("key").collect()}


def _by_site(rows):
    ordered = sorted(rows, key=lambda r: (r[1], r[3], r[4]))
    return {site: list(group) for site, group in groupby(ordered, key=lambda r: r[1])}


def test_paging_stops_after_the_page_with_a_hit(df):
    expected = set()
    for rows in _by_site(ROWS).values():
        for _, page in groupby(rows, key=lambda r: r[3]):
            page = list(page)
            expected |= {r[0] for r in page}
            if any(r[5] for r in page):
                break
    assert _keys(limits.paging_stop(df, ["site"], F.col("hit"))) == expected


def test_categories_stop_on_their_own(df):
    got = _keys(limits.paging_stop(df, ["site", "category"], F.col("hit")))
    expected = set()
    for r in ROWS:
        earlier = [x for x in ROWS if (x[1], x[2]) == (r[1], r[2]) and x[3] < r[3] and x[5]]
        expected |= set() if earlier else {r[0]}
    assert got == expected


@pytest.mark.parametrize("n", [1, 17, 500, 10_000])
def test_site_cap_takes_the_first_rows(df, n):
    expected = {r[0] for rows in _by_site(ROWS).values() for r in rows[:n]}
    assert _keys(limits.site_cap(df, ["site"], n)) == expected


def test_running_rank_with_an_outer_loop(df):
    ranked = limits.with_running_rank(df, ["site"], "rank", outer=["category"])
    ordered = sorted(ROWS, key=lambda r: (r[1], r[2], r[3], r[4]))
    expected = {r[0]: n for _, g in groupby(ordered, key=lambda r: r[1]) for n, r in enumerate(g, 1)}
    assert {r.key: r.rank for r in ranked.collect()} == expected


def test_page_cap_keeps_the_row_that_reaches_it(df):
    expected = set()
    for rows in _by_site(ROWS).values():
        for _, page in groupby(rows, key=lambda r: r[3]):
            for r in page:
                expected.add(r[0])
                if r[4] - 0 + 1 >= 300:
                    break
    assert _keys(limits.page_cap(df, ["site"], 300)) == expected


def test_growing_lists_count_each_position_once(df):
    got = _keys(limits.new_positions(df, ["site"]))
    first = {}
    for r in sorted(ROWS, key=lambda r: r[3]):
        first.setdefault((r[1], r[4]), r[0])
    assert got == set(first.values())
    plan = limits.new_positions(df, ["site"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # one of them ahead of the shuffle


def test_effective_limits(spark):
    config = spark.createDataFrame([("a", 7, 3, 4), ("b", None, 3, None), ("c", None, None, 9)], "site string, n_days int, n_pages int, n_jobs int")
    got = {r.site: tuple(r)[1:] for r in limits.effective_limits(config, Limits(30, 100, 200, 50)).collect()}
    assert got == {"a": (7, 1000, 10000, 50), "b": (30, 3, 200, 50), "c": (30, 100, 9, 50)}


def test_fresh_as_a_comparison_equals_whole_days(spark):
    from datetime import datetime, timedelta

    from noticeboard.functions import dates

    now = datetime(2024, 3, 10, 12)
    seconds = [d * 86400 + s for d in range(-2, 6) for s in (-1, 0, 1)]
    rows = [(i, now - timedelta(seconds=s)) for i, s in enumerate(seconds)] + [(99, None)]
    df = spark.createDataFrame(rows, "i int, d timestamp_ntz")
    for n in (0, 1, 3, 1_000_000, 2**31 - 1):
        by_comparison = {r.i for r in limits.fresh(df, "d", dates.ntz(now), n).collect()}
        by_days = {r.i for r in limits.fresh(df, "d", dates.ntz(now), F.lit(n)).collect()}
        assert by_comparison == by_days and 99 in by_days


def test_missing_numbers_are_values_and_ties_stay_within_the_cap(spark):
    rows = [("a", None, 0, "u"), ("a", None, 1, "u"), ("a", 0, 0, "u"), ("a", 0, 0, "v"), ("a", 0, None, "v"), (None, 1, 0, "u"), (None, 1, 1, "u")]
    df = spark.createDataFrame(rows, "site string, page_no int, item_pos int, url string")
    ranked = limits.with_running_rank(df, ["site"], "n", tie=["url"]).collect()
    assert len(ranked) == len(rows)
    assert sorted((r.site or "", r.n) for r in ranked) == [("", 1), ("", 2), ("a", 1), ("a", 2), ("a", 3), ("a", 4), ("a", 5)]
    assert limits.site_cap(df, ["site"], 1, tie=["url"]).count() == 2


def test_a_repeated_id_of_the_index_doubles_nothing(spark):
    rows = spark.createDataFrame([("1",), ("2",)], "id string")
    assert limits.mark_known(rows, spark.createDataFrame([("1",), ("1",)], "id string")).count() == 2


def test_rows_behind_the_page_cap_are_never_looked_at(spark):
    df = spark.createDataFrame([("s", 0, i, i == 4) for i in range(6)], "site string, page_no int, item_pos int, old boolean")
    assert [r.item_pos for r in limits.page_cap(df, ["site"], 3, accepted=~F.col("old")).orderBy("item_pos").collect()] == [0, 1, 2]
    assert limits.page_cap(df, ["site"], 5, accepted=~F.col("old")).count() == 6  # the one at the cap is old
