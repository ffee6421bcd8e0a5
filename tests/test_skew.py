"""A hot key is split, and nothing is lost or doubled by dealing it out."""

import pytest
from pyspark.sql import functions as F

from noticeboard.operators import limits, skew

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def split(spark):
    before = {k: spark.conf.get(k) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture
def rows(spark):
    i = F.col("id")
    site = F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (i % 200).cast("string")))
    return spark.range(0, 120_000, 1, 8).select(
        "id", site.alias("site"), (i / 40).cast("int").alias("page_no"), (i % 40).cast("int").alias("item_pos")
    )


def _final_plan(df):
    counted = df.agg(F.count("*").alias("n"), F.countDistinct("id").alias("d"))
    row = counted.collect()[0]
    return row, counted._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_joins_keep_every_row_once(split, rows, how):
    facts = rows.where("page_no < 10").groupBy("site").agg(F.min("page_no").alias("low"))
    got, expected = skew.join_facts(rows, facts, ["site"], how), rows.join(facts, "site", how)
    assert sorted(got.columns) == sorted(expected.columns)
    assert got.exceptAll(expected.select(got.columns)).isEmpty() and got.count() == expected.count()


def test_a_hot_key_is_split_at_run_time(split, rows):
    facts = rows.groupBy("site").agg(F.min("page_no").alias("low"))
    row, plan = _final_plan(skew.join_facts(rows, facts, ["site"]))
    assert row.n == row.d == 120_000
    assert "SortMergeJoin(skew=true)" in plan


def test_site_cap_never_sorts_a_site_in_one_task(split, rows):
    row, plan = _final_plan(limits.site_cap(rows, ["site"], 5_000))
    assert row.n == row.d == 5_000 + sum(1 for i in range(120_000) if i % 3)
    windows = [line for line in plan.split("\n") if "Window [row_number()" in line]
    assert windows and all("__items" in line for line in windows)
