"""What plans must and must not hold, for every query."""

import pytest

from noticeboard import catalog

SF = "/root/testdata/sf0.001"
READS_PAGES = {
    "extract_title", "extract_links", "list_items", "extract_by_rule", "required_fields", "url_default", "int_const", "page_bounds",
    "collect_job", "collect_detail_job", "nested_loops_job", "recheck_job",
}


catalog.load()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_plan(spark, name):
    plan = _plan(catalog.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    if name != "user_function":
        assert "ArrowEvalPython" not in plan
    if name not in READS_PAGES:
        assert "MapInArrow" not in plan


@pytest.fixture
def scans(spark):
    """The scans of a query, in full."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")

    def read(name):
        plan = _plan(catalog.QUERIES[name](spark, SF))
        return [line for line in plan.split("\n") if "FileScan" in line]

    yield read
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.mark.parametrize(
    ("name", "pushed"),
    [("open_postings", "LessThanOrEqual(o_orderdate"), ("fresh_two_stage", "GreaterThan(l_shipdate"), ("mark_expired", "EqualTo(l_returnflag")],
)
def test_filters_reach_the_scan(scans, name, pushed):
    assert any(pushed in scan for scan in scans(name))


@pytest.mark.parametrize(
    ("name", "schema"),
    [
        ("paging_stop", "struct<event_id:bigint,user_id:bigint>"),
        ("site_cap", "struct<event_id:bigint,user_id:bigint>"),
        ("company_lookup", "struct<o_orderkey:bigint,o_custkey:bigint>"),
        ("src_pages", "struct<page_id:bigint,url:string,html:string>"),
        ("sibling_groups", "struct<l_orderkey:bigint,l_linenumber:int,l_returnflag:string,l_shipdate:timestamp_ntz>"),
    ],
)
def test_scans_read_the_columns_they_need(scans, name, schema):
    assert any(f"ReadSchema: {schema}" in scan for scan in scans(name))


def test_plan_of_rules_does_not_grow_with_sites(spark):
    from datetime import datetime

    from noticeboard.catalog.cleaning import _site_spec
    from noticeboard.operators import clean

    rows = spark.createDataFrame([("site1", "", {"job_title": ["2-x"]})], "site string, url string, raw map<string,array<string>>")
    sizes = []
    for n in (6, 61):
        specs = [_site_spec(k) for k in range(n)]
        specs = [type(s)(s.site, list_rules=s.list_rules[:3]) for s in specs]  # no place lookups
        df = clean.with_fields(rows, specs, "list", None, datetime(2024, 1, 31))
        sizes.append(len(df._jdf.queryExecution().optimizedPlan().treeString()))
    assert abs(sizes[0] - sizes[1]) < 0.01 * sizes[0]


def test_rules_are_worked_out_once_and_not_again_in_filters(spark):
    plan = catalog.QUERIES["many_sites"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("map_from_entries(") == 1
    assert max(len(line) for line in plan.split("\n") if "Filter (" in line) < 5000
