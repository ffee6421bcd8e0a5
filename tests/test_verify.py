from datetime import datetime

import pytest

from pyspark.sql import functions as F

from noticeboard.operators import sieve, verify

AS_OF = datetime(2024, 1, 31, 12)
SCHEMA = "id string, job_company string, job_url string, verify_single boolean, job_expire_date timestamp_ntz"
PAST, FUTURE = datetime(2024, 1, 1), datetime(2024, 2, 20)


def _candidates(spark, *rows):
    return spark.createDataFrame([(i, c, f"u{i}", single, date) for i, c, single, date in rows], SCHEMA)


def _alive(spark, *ids):
    return spark.createDataFrame([(f"u{i}",) for i in ids], "url string")


def _outcomes(df):
    return {r.id: r.outcome for r in df.select("id", "outcome").collect()}


@pytest.fixture
def checked(spark):
    df = _candidates(
        spark,
        ("1", "none", False, None), ("2", "none", False, FUTURE),
        ("3", "some", False, None), ("4", "some", False, PAST),
        ("5", "all", False, None), ("6", "all", False, PAST), ("7", "all", False, FUTURE),
        ("8", "single", True, None), ("9", "single", True, None),
        ("10", "dated", False, PAST), ("11", "lonely", False, None),
    )
    return verify.with_expiry(verify.with_batch(df), _alive(spark, 1, 2, 3), AS_OF)


def test_guard(checked):
    assert _outcomes(verify.guard(checked)) == {
        "1": "alive", "2": "alive", "3": "alive", "4": "confirmed", "5": "held", "6": "confirmed", "7": "held",
        "8": "confirmed", "9": "confirmed", "10": "confirmed", "11": "held",
    }


def test_next_offset_leaves_out_date_expired_rows_of_suspicious_batches(checked):
    assert tuple(verify.next_offset(checked, 400, 200).first()) == (2, 598)


def test_expiry_needs_a_whole_day(spark):
    df = _candidates(spark, ("1", "c", False, datetime(2024, 1, 30, 12)), ("2", "c", False, datetime(2024, 1, 30, 13)))
    got = {r.id: r.expired_date for r in verify.with_expiry(verify.with_batch(df), _alive(spark), AS_OF).collect()}
    assert got == {"1": True, "2": False}


@pytest.mark.parametrize(("accept", "last"), [(True, "confirmed"), (False, "alarm")])
def test_recheck_rounds(spark, checked, accept, last):
    held = verify.guard(checked).where("outcome = 'held'")
    got = _outcomes(verify.recheck(held, [_alive(spark), _alive(spark, 5)], AS_OF, accept))
    assert got == {"5": "alive", "7": "confirmed", "11": last}
    assert _outcomes(verify.recheck(held, [], AS_OF, accept)) == {"5": last, "7": last, "11": last}


def test_route_reports_unknown_companies(spark):
    df = _candidates(spark, ("1", "a", False, None), ("2", "b", False, None)).drop("verify_single")
    sites = spark.createDataFrame([("a", "site-a", True)], "job_company string, site string, verify_single boolean")
    known, unknown = verify.route(df, sites)
    assert [r.site for r in known.collect()] == ["site-a"] and [r.id for r in unknown.collect()] == ["2"]


def test_a_sieve_lets_all_wanted_values_pass_and_few_others(spark):
    keys = spark.range(500).select(F.concat(F.lit("http://a/"), "id").alias("k")).unionAll(spark.createDataFrame([(None,)], "k string"))
    rows = spark.range(20_000).select(F.concat(F.lit("http://a/"), "id").alias("k")).unionAll(keys.where("k IS NULL"))
    passed = sieve.sifted(rows, "k", keys, "k")
    assert passed.columns == ["k"]
    assert passed.where(F.regexp_extract("k", r"(\d+)$", 1).cast("int") < 500).count() == 500
    assert passed.count() < 600
    assert sieve.sifted(rows, "k", keys.limit(0), "k").count() == 0


def test_a_sieve_grows_with_the_keys_and_moves_no_row(spark):
    numbers = spark.range(400_000).select(F.col("id").cast("string").alias("k"))
    keys = numbers.where(F.col("k").cast("int") < 200_000)
    passed = sieve.sifted(numbers, "k", keys, "k")
    assert 200_000 <= passed.count() < 202_000  # under 1 % of the others
    plan = passed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # Ten million keys: the same bits a key, in some 20 MB.
    assert sieve.blocks_for(200_000) > 50 and sieve.blocks_for(10**7) * 4096 < 21_000_000
    assert sieve.blocks_for(10**12) == sieve.MOST_BLOCKS
    few = sieve.filter_blocks(keys, "k", 2)  # far more keys than it has room for: all still pass
    assert [len(r.words) for r in few.collect()] == [512, 512]
