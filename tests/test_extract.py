import json
import random

import pytest

from noticeboard.functions import markup
from noticeboard.model import FieldRule, Loop, SiteSpec, extract_rules, site_config, verify_rules
from noticeboard.operators import clean, extract
from noticeboard.sources import specs as spec_source

LIST = """<html><body><div class='job list'><table id=jobs>
<tr class=head><td>Title</td><td>Place</td></tr>
<tr class=row><td><a href='/j/1' title='one'>First <b>job</b></a><td><span>Beijing</span> &amp; more
<tr class=row><td><a href='/j/2'>Second job</a></td><td><span>Tianjin</span></td></tr>
<tr class='row new'><td></td><td name=place>Shanghai<br>Pudong</td></tr>
</table></div><p>para one<p>para <i>two</i><div id=x>out &lt;side</div>
<input name=total value=7><a>Next page</a><script>var a = '<a>Next page</a>';</script></body></html>"""


@pytest.mark.parametrize(
    ("selector", "how", "texts"),
    [
        ("//TABLE[@id='jobs']/TBODY/TR[@class='row']/TD[1]/A", "XPATH", ["First job", "Second job"]),
        ("//tr[2]/descendant::span", "XPATH", ["Beijing"]),
        ("//tr[contains(@class,'new')]/td[last()]", "XPATH", ["Shanghai\nPudong"]),
        ("//td[text()='Place']/parent::tr/following-sibling::tr[1]//a", "XPATH", ["First job"]),
        ("//a[not(@href)]", "XPATH", ["Next page"]),
        ("//a[@title='one' or contains(text(),'Second')]", "XPATH", ["First job", "Second job"]),
        ("//a[contains(text(),'job') and not(@title)]", "XPATH", ["Second job"]),
        ("//span[.='Tianjin']/../preceding-sibling::td", "XPATH", ["Second job"]),
        ("//p | //div[@id='x']", "XPATH", ["para one", "para two", "out <side"]),
        ("x", "ID", ["out <side"]),
        ("job", "CLASS_NAME", ["Title\nPlace\nFirst job\nBeijing & more\nSecond job\nTianjin\nShanghai\nPudong"]),
        ("place", "NAME", ["Shanghai\nPudong"]),
        ("P", "TAG_NAME", ["para one", "para two"]),
        ("Next page", "LINK_TEXT", ["Next page"]),
        ("cond j", "PARTIAL_LINK_TEXT", ["Second job"]),
        ("tr.row.new", "CSS", ["Shanghai\nPudong"]),
        ("div#x", "CSS", ["out <side"]),
        ("//missing", "XPATH", []),
        ("//p[*]", "XPATH", ["para two"]),
        ("//tr[3]/td[2]/preceding-sibling::*", "XPATH", ["Second job"]),
        ("//td[@name]/preceding-sibling::td | //td[last()]", "XPATH", ["Place", "Beijing & more", "Tianjin", "", "Shanghai Pudong"]),
        ("//td[contains(text(),'more')]", "XPATH", ["Beijing & more"]),
        ("//td[starts-with(.,'First')]/a/b", "XPATH", ["job"]),
        ("/html/body//span[not(contains(.,'Bei'))]", "XPATH", ["Tianjin"]),
    ],
)
def test_selectors(selector, how, texts):
    found = markup.Page(LIST).find(selector, how)
    shown = [markup.visible_text(e) for e in found]
    assert [" ".join(s.split()) for s in shown] == [" ".join(s.split()) for s in texts]


@pytest.mark.parametrize(("selector", "how"), [("//a[count(b)>1]", "XPATH"), ("//a/ancestor::b", "XPATH"), ("a > b", "CSS"), ("x", "NOPE"), ("", "ID")])
def test_unsupported_selectors_fail_when_rules_are_loaded(spark, selector, how):
    pages = spark.createDataFrame([], "site string, url string, page_no int, html string")
    with pytest.raises(ValueError):
        extract.extract(pages, [SiteSpec("s", detail_groups=((FieldRule("f", selector, how),),))], "detail")


def test_inner_html_and_depth():
    page = markup.Page("<div><p>a &lt; b<br>c</p>tail</div>" + "<font>" * 3000 + "x")
    assert markup.inner_html(page.find("//div")[0]) == "<p>a &lt; b<br>c</p>tail"
    assert "x" in markup.visible_text(page.root)
    assert markup.Page(None).find("//a") == []
    assert markup.Page("<![bad").root is not None
    deep = markup.Page("<div>" * 20_000 + "<b>x</b>")
    assert markup.visible_text(deep.root) == "x" and markup.inner_html(deep.root).endswith("</div>")
    assert len(deep.find("//div/b")) == 1


def test_odd_declarations_are_comments_and_the_page_goes_on():
    page = markup.Page("<p>a</p><![foo bar]><p>b</p><![CDATA[x]]><!ELEMENT y><p>c</p>")
    assert [markup.visible_text(p) for p in page.find("//p")] == ["a", "b", "c"]


@pytest.mark.parametrize(
    ("link", "absolute"),
    [("/j/1", "https://h.org/j/1"), ("x?y=1", "https://h.org/a/x?y=1"), (" ../z ", "https://h.org/z"), ("//o.org/p", "https://o.org/p"), ("http://o.org", "http://o.org"), ("mailto:a@b", "mailto:a@b"), ("?q", "https://h.org/a/b?q"), ("#f", "https://h.org/a/b#f")],
)
def test_links_are_absolute(spark, link, absolute):
    from pyspark.sql import functions as F

    from noticeboard.functions import ids

    assert markup.Page("<a>").address(link, "https://h.org/a/b") == absolute
    assert spark.range(1).select(ids.resolve(F.lit(link), F.lit("https://h.org/a/b")).alias("r")).first().r == absolute
    assert markup.Page("<base href='/deep/er/'>").address("x", "https://h.org/a") == "https://h.org/deep/er/x"


def test_broken_pages_never_fail_a_job():
    rng = random.Random(7)
    rules = [FieldRule("a", "//a[contains(text(),'job')]"), FieldRule("job_description", "//table"), FieldRule("b", "cond", "PARTIAL_LINK_TEXT")]
    bits = ["<", ">", "</", "<!", "<![CDATA[", "<!--", "-->", "<?", "&#x;", "&#99999999999;", "&", "'", '"', "\x00", "<a", "<table", "<script>", "]]>", "<!DOCTYPE [", "<p/>"]
    for n in range(600):
        html = LIST[: rng.randrange(len(LIST))]
        for _ in range(rng.randrange(6)):
            at = rng.randrange(len(html) + 1)
            html = html[:at] + rng.choice(bits) + html[at:]
        page = markup.Page(html)
        extract._values(page, "https://h.org/", rules)
        for element in page.root.iter():
            markup.inner_html(element)
            markup.visible_text(element)


SPEC = SiteSpec(
    "s",
    items=Loop("//table[@id='jobs']/tbody/tr", begin_from=1, end_to=-1),
    list_rules=(
        FieldRule("job_title", "td[1]/a"),
        FieldRule("job_url", "td[1]/a", method="getAttribute", value="href"),
        FieldRule("job_location", "td[2]/span | //div[@id='none']"),
        FieldRule("job_sub_company", "//p[%d]", is_fatal=False),
        FieldRule("job_category_domain", "td[1]/a", method="getAttribute", value="title", is_fatal=False),
        FieldRule("comment:job_type", "td[9]"),
    ),
    pages=Loop(None, "page", total_pages=FieldRule("page_count", "total", "NAME", method="getValue")),
)


def _pages(spark, *rows):
    return spark.createDataFrame(list(rows), "site string, url string, page_no int, html string")


def test_list_rows(spark):
    rows = extract.extract(_pages(spark, ("s", "u", 0, LIST), ("other", "v", 0, LIST)), [SPEC], "list").orderBy("item_pos").collect()
    assert [(r.item_pos, r.n_items, r.page_count, r.pager_nodes) for r in rows] == [(1, 4, "7", None), (2, 4, "7", None)]
    assert rows[0].raw["job_title"] == ["First job"] and rows[0].raw["job_location"] == ["Beijing"]
    assert rows[0].raw["job_sub_company"] == ["para two"] and "job_sub_company" not in rows[1].raw  # index 2, then 3
    assert rows[0].raw["job_category_domain"] == ["one"] and "job_category_domain" not in rows[1].raw
    assert "comment:job_type" not in rows[0].raw


def test_missing_required_fields_drop_the_row(spark):
    spec = SiteSpec("s", items=Loop("//table[@id='jobs']/tbody/tr"), list_rules=SPEC.list_rules[:2])
    rows = extract.extract(_pages(spark, ("s", "u", 0, LIST)), [spec], "list")
    from noticeboard.catalog import AS_OF

    assert rows.count() == 4
    assert {r.job_url for r in clean.with_fields(rows, [spec], "list", None, AS_OF).collect()} == {"/j/1", "/j/2"}


DOCUMENT = {
    "name": "Acme", "fetch.n.days": 9, "check_solr": True, "verify_single": True,
    "job_unique_id_calc": {"how": "url_plus_title"},
    "procedure": {
        "loop": {"loop_type": "end"},
        "procedure": {
            "loop": {"xpath_prefix": "//li", "loop_type": "begin", "begin_from": 1, "end_to": -1},
            "extracts": {"job_title": {"element": "a"}, "comment:job_url": {"element": "b"}},
            "procedures": [
                {"extracts": {"job_location": {"element": "x", "how": "ID", "transforms": [{"how": "regex_matcher", "value": "/(.)/"}]}}},
                {"extracts": {"job_type": {"how": "int", "value": "2", "isFatal": False}}},
            ],
        },
    },
}


def test_specs_from_files(spark, tmp_path):
    (tmp_path / "Acme.json").write_text(json.dumps(DOCUMENT))
    (spec,) = spec_source.read_specs(spark, str(tmp_path))
    assert (spec.site, spec.n_days, spec.check_index, spec.verify_single, spec.id_how) == ("Acme", 9, True, True, "url_plus_title")
    assert spec.items == Loop("//li", "job", 1, -1) and [r.field for r in spec.list_rules] == ["job_title"]
    assert [[r.field for r in g] for g in spec.detail_groups] == [["job_location"], ["job_type"]]
    assert spec.detail_rules()[0].transforms[0].group == 1 and not spec.detail_rules()[1].is_fatal
    rules = extract_rules(spark, [spec])
    assert rules.count() == 3 and verify_rules(rules).count() == 2
    assert site_config(spark, [spec]).first().verify_single


def test_page_bounds(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(5, None, False), (0, None, False), (None, "3", True), (None, "x", True), (None, None, True), (None, "0", True)], "n int, c string, s boolean")
    bounds = extract.page_bounds(F.col("n"), F.col("c"), F.col("s"), F.lit(1), F.lit(-1))
    got = [tuple(r.b) for r in rows.select(bounds.alias("b")).collect()]
    assert got == [(True, 1, 4), (True, 0, 1), (True, 1, 2), (False, 1, None), (True, 1, 0), (True, 0, 1)]


def test_rows_leave_a_task_in_small_batches():
    import pyarrow as pa

    from noticeboard.operators import extract as operator

    n = 400
    pages = [f"<ul><li><p>{k} {'x' * 9_000}</p></li><li><p>{k}b {'y' * 9_000}</p></li></ul>" for k in range(n)]
    columns = {"site": ["s"] * n, "url": [f"u{k}" for k in range(n)], "outer_no": [0] * n, "page_no": list(range(n)), "html": pages}
    spec = SiteSpec("*", items=Loop("//li"), list_rules=(FieldRule("job_title", "p"),))
    out = list(operator._rows_of(iter([pa.RecordBatch.from_pydict(columns)]), {"*": spec}, "list", operator._ARROW))
    assert max(batch.nbytes for batch in out) < 2 << 20
    got = [(r["page_no"], r["item_pos"], dict(r["raw"])["job_title"][0].split()[0]) for batch in out for r in batch.to_pylist()]
    assert got == [(k, i, f"{k}{'b' * i}") for k in range(n) for i in range(2)]
