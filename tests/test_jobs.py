"""Whole jobs on small made pages, against what reading them by hand gives."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from noticeboard.model import FieldRule, Limits, Loop, SiteSpec
from noticeboard.operators.lookup import Dictionary
from noticeboard.plans import collect, daily, recheck, schedule
from noticeboard.session import new_folder
from noticeboard.sources import seeds

AS_OF = datetime(2024, 1, 31, 10, 20)
PAGES = "site string, url string, page_no int, html string"


def _listing(*items):
    rows = "".join(f"<li><a href='{url}'>{title}</a><i>{date}</i></li>" for url, title, date in items)
    return f"<ul id=list>{rows}</ul><b class=pg>1</b><b class=pg>2</b><b class=pg>3</b>"


def _spec(site, **more):
    rules = (
        FieldRule("job_title", "a"),
        FieldRule("job_url", "a", method="getAttribute", value="href"),
        FieldRule("job_post_date", "i", is_fatal=False),
    )
    return SiteSpec(site, items=Loop("//ul[@id='list']/li", more.pop("kind", "job")), list_rules=rules, **more)


@pytest.fixture
def dictionaries(spark):
    cities = Dictionary(spark.createDataFrame([("beijing", "北京")], "a string, c string"), "a", "c")
    names = Dictionary(spark.createDataFrame([("A", "Company A")], "k string, v string"), "k", "v")
    return cities, names


def _titles(df):
    return sorted(r.job_title for r in df.collect())


def test_outdated_row_ends_paging_and_caps_apply(spark, dictionaries):
    pages = spark.createDataFrame([
        ("A", "p0", 0, _listing(("/1", "one", "2024-01-30"), ("/2", "two", "2024-01-20"))),
        ("A", "p1", 1, _listing(("/3", "old", "2023-01-01"), ("/4", "four", "2024-01-02"))),
        ("A", "p2", 2, _listing(("/5", "five", "2024-01-30"))),
        ("B", "q0", 0, _listing(("/6", "six", "2024-01-30"), ("/7", "seven", "x"), ("/8", "eight", "2024-01-30"))),
    ], PAGES)
    specs = [_spec("A", n_days=30), _spec("B", n_jobs=2)]
    rows = collect.collect_postings(pages, specs, AS_OF, *dictionaries)
    assert _titles(rows) == ["four", "one", "seven", "six", "two"]
    got = {r.job_title: r for r in rows.collect()}
    assert got["one"].job_company == "Company A" and got["six"].job_company == "unknown"
    assert got["seven"].post_date_guessed and got["seven"].job_post_date == datetime(2024, 1, 31, 10)
    assert not got["one"].post_date_guessed and not got["one"].job_expired


def test_known_posting_ends_paging_and_is_still_written(spark, dictionaries):
    import hashlib

    pages = spark.createDataFrame([
        ("A", "p0", 0, _listing(("/1", "one", "2024-01-30"))), ("A", "p1", 1, _listing(("/2", "two", "2024-01-30"))),
        ("B", "q0", 0, _listing(("/1", "uno", "2024-01-30"))), ("B", "q1", 1, _listing(("/2", "due", "2024-01-30"))),
    ], PAGES)
    known = spark.createDataFrame([(hashlib.md5(b"/1").hexdigest(),)], "id string")
    rows = collect.collect_postings(pages, [_spec("A", check_index=True), _spec("B")], AS_OF, *dictionaries, index_ids=known)
    assert _titles(rows) == ["due", "one", "uno"]


def test_page_bounds_growing_lists_and_outer_loops(spark, dictionaries):
    old = ("/0", "old", "2020-01-01")
    pages = spark.createDataFrame([
        # three pager nodes, the first and the last left out
        *(("A", f"p{n}", 0, n, _listing((f"/a{n}", f"a{n}", "2024-01-30"))) for n in range(4)),
        # each page repeats the rows before
        *(("B", f"q{n}", 0, n, _listing(*((f"/b{i}", f"b{i}-{n}", "2024-01-30") for i in range(n + 1)))) for n in range(3)),
        # an old row ends its own outer loop only
        ("C", "r0", 0, 0, _listing(old, ("/c0", "c0", "2024-01-30"))), ("C", "r1", 0, 1, _listing(("/c1", "c1", "2024-01-30"))),
        ("C", "r2", 1, 0, _listing(("/c2", "c2", "2024-01-30"))), ("C", "r3", 1, 1, _listing(("/c3", "c3", "2024-01-30"))),
        # and no loop at all where the pages are a loop of other things
        ("D", "s0", 0, 0, _listing(old)), ("D", "s1", 0, 1, _listing(("/d1", "d1", "2024-01-30"))),
    ], "site string, url string, outer_no int, page_no int, html string")
    specs = [
        _spec("A", pages=Loop("//b[@class='pg']", "page", begin_from=1, end_to=-1)),
        _spec("B", kind="job_addon"), _spec("C"), _spec("D", pages=Loop(None, "other")),
    ]
    rows = collect.collect_postings(pages, specs, AS_OF, *dictionaries, defaults=Limits(n_days=30))
    assert _titles(rows) == ["a1", "b0-0", "b1-1", "b2-2", "c0", "c2", "c3", "d1"]
    capped = collect.collect_postings(pages, specs, AS_OF, *dictionaries, defaults=Limits(30, 1, 2, 5000))
    assert _titles(capped) == ["a1", "b0-0", "c0", "c2", "d1"]


def test_details_join_by_address(spark, dictionaries):
    pages = spark.createDataFrame([("A", "p0", 0, _listing(*((f"/{n}", f"t{n}", "2024-01-30") for n in range(5))))], PAGES)
    detail = "<h1>{0}</h1><p class=place>{1}</p><div id=text><p>long {0}</p></div><i>{2}</i>"
    details = spark.createDataFrame([
        ("A", "/0", 0, datetime(2024, 1, 2), detail.format("new zero", "Beijing", "2024-01-30")),
        ("A", "/0", 0, datetime(2024, 1, 1), detail.format("old zero", "nowhere", "2024-01-30")),
        ("A", "/1", 0, datetime(2024, 1, 1), detail.format("one", "x", "2020-01-01")),
        ("A", "/2", 0, datetime(2024, 1, 1), "<h1>no place</h1>"),
        ("A", "/3", 0, datetime(2024, 1, 1), detail.format("three", "Beijing or x", "2024-01-30")),
    ], "site string, url string, page_no int, fetched_at timestamp_ntz, html string")
    groups = (
        (FieldRule("job_category_domain", how="url"), FieldRule("job_title", "h1", "TAG_NAME"), FieldRule("job_location", "place", "CLASS_NAME")),
        (FieldRule("job_description", "text", "ID"), FieldRule("job_post_date", "//i", is_fatal=False)),
    )
    base = _spec("A")
    # the place is in the list too, which does not make up for a detail page without it
    spec = SiteSpec("A", base.items, (*base.list_rules[:2], FieldRule("job_location", "a")), groups)
    rows = {r.job_url: r for r in collect.collect_postings(pages, [spec], AS_OF, *dictionaries, details=details).collect()}
    assert set(rows) == {"/0", "/3"}  # 1 is old, 2 lacks its place, 4 has no page
    assert rows["/0"].job_category_domain == "/0"
    assert rows["/0"].job_title == "new zero" and rows["/0"].job_location == "北京"
    assert rows["/3"].job_description == "<p>long three</p>" and rows["/3"].job_description_stripped.strip() == "long three"


def test_list_values_stay_where_the_detail_page_has_none(spark, dictionaries):
    pages = spark.createDataFrame([("A", "p", 0, _listing(("/1", "one", "2024-01-20"), ("/2", "two", "odd")))], PAGES)
    details = spark.createDataFrame([("A", "/1", 0, "<i>-</i>"), ("A", "/2", 0, "<u>2024-01-25</u>"), ("B", "/9", 0, "")], PAGES)
    dated = SiteSpec("A", _spec("A").items, _spec("A").list_rules, ((FieldRule("job_post_date", "//u", is_fatal=False),),))
    other = SiteSpec("B", _spec("B").items, _spec("B").list_rules, ((FieldRule("job_title", "//b"),),))
    rows = collect.collect_postings(pages, [dated, other], AS_OF, *dictionaries, details=details)
    got = {r.job_title: (r.job_post_date, r.post_date_guessed) for r in rows.collect()}
    assert got == {"one": (datetime(2024, 1, 20), False), "two": (datetime(2024, 1, 25), False)}


def test_seeds_and_regular_plan(spark):
    lines = ["# off", "", "  ", "never", "late 2023-01-01T00:00:00.000Z true", "late 2022-01-01T00:00:00.000Z true",
             "fresh 2024-01-30T00:00:00.000Z false 3.7 42", "#x 1 2", "bad yesterday true"]
    parsed = seeds.seeds(spark.createDataFrame([(x,) for x in lines], "line string"))
    got = {r.site: tuple(r)[1:] for r in parsed.collect()}
    assert got == {
        "never": (None, False, None, 0), "late": ("2023-01-01T00:00:00.000Z", True, None, None),
        "fresh": ("2024-01-30T00:00:00.000Z", False, "3.7", 42), "bad": ("yesterday", True, None, None),
    }
    limits = spark.createDataFrame([("never", 30), ("late", 30), ("fresh", 30), ("bad", 30)], "site string, n_days int")
    plan = {r.site: (r.action, r.n_days) for r in schedule.regular_plan(parsed, limits, AS_OF).collect()}
    assert plan == {"never": ("run", 30), "late": ("run", 396), "fresh": ("carry", None), "bad": ("carry", None)}
    specs = [SiteSpec("never"), SiteSpec("late", n_pages=3), SiteSpec("fresh"), SiteSpec("elsewhere")]
    todo = schedule.specs_to_run(specs, schedule.regular_plan(parsed, limits, AS_OF))
    assert {s.site: s.n_days for s in todo} == {"never": None, "late": 396}


def test_daily_routine(spark, dictionaries):
    cities, companies = dictionaries
    table = daily.posting_table(spark, new_folder(spark, "daily"), buckets=4)
    text = FieldRule("job_description", "text", "ID")
    specs = [_spec("A", detail_groups=((text,),)), _spec("B", detail_groups=((text,),))]
    old = "2023-12-20"
    pages = spark.createDataFrame([
        ("A", "p0", 0, _listing(("/1", "one", old), ("/2", "two", old), ("/2", "two again", old))),
        ("B", "q0", 0, _listing(("/3", "three", old))),
    ], PAGES)
    more = spark.createDataFrame([("C", "r0", 0, _listing(("/4", "four", old)))], PAGES)
    details = lambda *urls: spark.createDataFrame([(s, u, 0, "<p id=text>x</p>") for s, u in urls], PAGES)
    every = details(("A", "/1"), ("A", "/2"), ("B", "/3"))
    wrote = daily.collect_and_index(table, 0, pages, specs, AS_OF, cities=cities, companies=companies, details=every)
    assert wrote.count() == 4
    assert {r.job_url: r.job_title for r in table.current().collect()} == {"/1": "one", "/2": "two again", "/3": "three"}
    # 1 has gone from its site, 3 is all its site has
    outcome = daily.recheck_and_index(table, 1, [details(("A", "/2"))] * 2, specs, AS_OF, cities)
    assert sorted(r.outcome for r in outcome.collect()) == ["alarm", "alive", "confirmed"]
    # the postings of a site without detail rules are not looked at
    daily.collect_and_index(table, 2, more, [_spec("C")], AS_OF, cities=cities, companies=companies)
    again = daily.recheck_and_index(table, 3, [details(("A", "/2"))], [*specs, _spec("C")], AS_OF, cities)
    assert sorted(r.outcome for r in again.collect()) == ["alarm", "alive", "skipped"]
    rows = {r.job_url: r for r in table.current().where("site <> 'C'").collect()}
    assert {u: r.job_expired for u, r in rows.items()} == {"/1": True, "/2": False, "/3": False}
    assert rows["/1"].job_title == "one" and rows["/1"].job_description == "x"


def test_recheck_writes_back_confirmed_rows_only(spark):
    day = datetime(2023, 1, 1)
    postings = spark.createDataFrame(
        [("1", "u1", "A", day, None, False), ("2", "u2", "A", day, None, False), ("3", "u3", "B", day, None, False),
         ("4", "u4", "C", day, None, False), ("5", "u5", "A", datetime(2024, 1, 30), None, False), ("6", "u6", "A", day, None, True)],
        "id string, job_url string, job_company string, job_post_date timestamp_ntz, job_expire_date timestamp_ntz, job_expired boolean",
    )
    sites = spark.createDataFrame([("A", "A", False), ("B", "B", False)], "job_company string, site string, verify_single boolean")
    pages = spark.createDataFrame([("A", "u1", 0, "<h1>x</h1>"), ("A", "u2", 0, "gone")], PAGES)
    spec = SiteSpec("A", detail_groups=((FieldRule("job_title", "h1", "TAG_NAME"),),))
    alive = recheck.alive_urls(pages, [spec], None, AS_OF)
    outcome = recheck.recheck_postings(postings, sites, [alive, alive], AS_OF)
    assert {r.id: r.outcome for r in outcome.collect()} == {"1": "alive", "2": "confirmed", "3": "alarm", "4": "skipped"}
    flags = {r.id: r.job_expired for r in recheck.apply_outcome(postings, outcome).collect()}
    assert flags == {"1": False, "2": True, "3": False, "4": False, "5": False, "6": True}


def test_relative_links_lead_to_details_and_ids_of_their_own(spark, dictionaries):
    rows = [(site, f"https://{site.lower()}.org/jobs/list?p=1", 0, _listing(("/j/1", f"{site} one", "2024-01-30"), ("../k#x", f"{site} two", "2024-01-30"))) for site in "AB"]
    pages = spark.createDataFrame(rows, PAGES)
    found = collect.collect_postings(pages, [_spec("A"), _spec("B")], AS_OF, *dictionaries).collect()
    assert {r.job_url for r in found} == {f"https://{h}.org/{p}" for h in "ab" for p in ("j/1", "k#x")}
    assert len({r.id for r in found}) == 4
    details = spark.createDataFrame([("A", f"https://{h}.org/{p}", 0, "<h1>shown</h1>") for h in "ab" for p in ("j/1", "k#x")], PAGES)
    groups = ((FieldRule("job_category_domain", "h1", "TAG_NAME"),),)
    specs = [SiteSpec(s, _spec(s).items, _spec(s).list_rules, groups) for s in "AB"]
    details = details.withColumn("site", F.when(F.contains("url", F.lit("/a.")), "A").otherwise("B"))
    joined = collect.collect_postings(pages, specs, AS_OF, *dictionaries, details=details).collect()
    assert len(joined) == 4 and {r.id for r in joined} == {r.id for r in found} and {r.job_category_domain for r in joined} == {"shown"}


def test_page_numbers_may_be_missing_or_shared(spark, dictionaries):
    lost = spark.createDataFrame([("A", "p", None, _listing(("/1", "one", "2024-01-30"))), (None, "https://a.org/q", 0, _listing(("/2", "two", "2024-01-30")))], PAGES)
    assert _titles(collect.collect_postings(lost, [_spec("A"), _spec("a.org")], AS_OF, *dictionaries)) == ["one", "two"]
    shared = spark.createDataFrame([("A", u, 0, _listing((f"/{u}", u, "2024-01-30"))) for u in "pqr"] * 2, PAGES)
    assert collect.collect_postings(shared, [_spec("A", n_jobs=1)], AS_OF, *dictionaries).count() == 1
    assert collect.collect_postings(shared, [_spec("A", n_jobs=2)], AS_OF, *dictionaries).count() == 2


def test_the_newest_snapshot_of_a_listing_counts(spark, dictionaries):
    pages = spark.createDataFrame([
        ("A", "p", 0, datetime(2024, 1, 1), _listing(("/1", "one", "2024-01-30"), ("/2", "two", "2024-01-30"))),
        ("A", "p", 0, datetime(2024, 1, 2), _listing(("/2", "two", "2024-01-30"))),
        ("A", "q", 1, datetime(2024, 1, 1), _listing(("/3", "three", "2024-01-30"))),
        ("A", "q", 1, datetime(2024, 1, 3), "<p>closed</p>"),
        (None, None, 2, None, None),
    ], "site string, url string, page_no int, fetched_at timestamp_ntz, html string")
    assert _titles(collect.collect_postings(pages, [_spec("A")], AS_OF, *dictionaries)) == ["two"]


def test_an_old_detail_page_that_fails_still_ends_paging(spark, dictionaries):
    pages = spark.createDataFrame([("A", f"p{n}", n, _listing((f"/{n}", f"t{n}", "-"))) for n in range(3)], PAGES)
    shown = {0: "<h1>x</h1><i>2024-01-30</i>", 1: "<i>2020-01-01</i>", 2: "<h1>x</h1><i>2024-01-30</i>"}
    details = spark.createDataFrame([("A", f"/{n}", 0, html) for n, html in shown.items()], PAGES)
    groups = ((FieldRule("job_category_domain", "h1", "TAG_NAME"), FieldRule("job_post_date", "//i", is_fatal=False)),)
    spec = SiteSpec("A", _spec("A").items, _spec("A").list_rules[:2], groups)
    assert _titles(collect.collect_postings(pages, [spec], AS_OF, *dictionaries, details=details)) == ["t0"]


def test_html_is_never_moved(spark, dictionaries):
    pages = spark.createDataFrame([("A", "p", 0, datetime(2024, 1, 1), _listing(("/1", "one", "2024-01-30")))], "site string, url string, page_no int, fetched_at timestamp_ntz, html string")
    from noticeboard.operators.extract import extract

    for level, spec in (("list", _spec("A")), ("detail", SiteSpec("A", detail_groups=((FieldRule("job_title", "a"),),)))):
        plan = extract(pages, [spec], level)._jdf.queryExecution().executedPlan().toString()
        moved = [line for line in plan.split("\n") if "Exchange" in line or "Sort" in line]
        below = plan[plan.index("MapInArrow"):].split("MapInArrow", 1)[1]
        assert moved and "Exchange" not in below.split("LogicalRDD")[0].split("Scan")[0] and not any("html" in line for line in moved)


def test_a_day_plans_resumes_reports_and_exports(spark, dictionaries):
    cities, companies = dictionaries
    folder = new_folder(spark, "day")
    table = daily.posting_table(spark, f"{folder}/table", buckets=4)
    item = lambda site, n: (f"https://{site}.org/{n}", f"{site}{n}", "2024-01-30")
    pages = spark.createDataFrame([(s, f"https://{s}.org/p{n}", n, _listing(item(s, 2 * n), item(s, 2 * n + 1))) for s in "ABC" for n in range(2)], PAGES)
    lines = ["A", "B 2024-01-30T00:00:00.000Z true", "C 2024-01-30T00:00:00.000Z false 0.0 7", "D"]
    listed = seeds.seeds(spark.createDataFrame([(x,) for x in lines], "line string"))
    specs = [_spec(s) for s in "ABC"]
    ended = spark.createDataFrame([("A", False)], "site string, complete boolean")
    export = (f"{folder}/out", {"job_title": "title"}, {"job_url": "link"})
    report = {r.site: r for r in daily.run_day(table, 0, pages, specs, listed, f"{folder}/runs", AS_OF, cities, companies, ended, export).collect()}
    # A is new, B ran yesterday, C goes on behind its first row, D has no spec
    assert {s: (r.complete, r.n, r.total) for s, r in report.items()} == {"A": (False, 4, 4), "C": (True, 3, 10)}
    assert _titles(table.current()) == ["A0", "A1", "A2", "A3", "C1", "C2", "C3"]
    out = spark.read.parquet(f"{folder}/out/no=0")
    assert {"title", "link"} <= set(out.columns) and out.count() == 7
    # A broke off at its last row, so nothing is left of it; C is done, and nothing is due
    later = daily.run_day(table, 1, pages, specs, listed, f"{folder}/runs", AS_OF, cities, companies).collect()
    assert {r.site: (r.complete, r.n, r.total) for r in later} == {"A": (True, 0, 4)}
    wanted = spark.createDataFrame([("Company A",)], "display_name string")
    outcome = recheck.recheck_postings(table.current(), spark.createDataFrame([("A", False), ("C", False)], "site string, verify_single boolean"), [spark.createDataFrame([], "url string")], AS_OF, 1, key="site", wanted=wanted)
    assert outcome.count() == 4


def test_an_outer_loop_keeps_the_page_loop_within_it(spark):
    from noticeboard.catalog.jobs import _NESTED
    from noticeboard.model import loop_rules
    from noticeboard.sources.specs import spec_of

    nested = spec_of(_NESTED)
    assert nested.outer.item_type == "other" and nested.pages.item_type == "page" and nested.items.selector == "//article"
    alone = spec_of({"name": "s", "procedure": {"loop": {"loop_type": "begin", "loop_item_type": "other"}, "procedure": _NESTED["procedure"]["procedure"]["procedure"]}})
    assert [r.paged for r in loop_rules(spark, [nested, alone]).collect()] == [True, False]


def test_detail_pages_that_no_row_lists_are_not_parsed(spark, dictionaries, monkeypatch):
    parsed = []

    def spy(pages, specs, level):
        if level == "detail":
            parsed.extend(r.url for r in pages.select("url").collect())
        return extract(pages, specs, level)

    extract = collect.extract
    spec = _spec("A", detail_groups=((FieldRule("job_title", "//h1"),),))
    pages = spark.createDataFrame([("A", "p0", 0, _listing(("/1", "one", "2024-01-30")))], PAGES)
    details = spark.createDataFrame([("A", f"/{i}", 0, f"<h1>t{i}</h1>") for i in range(400)] + [("A", None, 0, "<h1>none</h1>")], PAGES)
    want = [r.job_url for r in collect.collect_postings(pages, [spec], AS_OF, *dictionaries, details=details).collect()]
    monkeypatch.setattr(collect, "extract", spy)
    got = [r.job_url for r in collect.collect_postings(pages, [spec], AS_OF, *dictionaries, details=details).collect()]
    assert got == want == ["/1"] and "/1" in parsed and len(parsed) < 5
