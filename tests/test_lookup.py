import pytest
from pyspark.sql import functions as F

from noticeboard.model import FieldRule, SiteSpec, Transform
from noticeboard.operators import clean, lookup
from noticeboard.sources import dictionaries
from noticeboard.catalog import AS_OF

# A few dictionary lines in the form sites use.
CITY_LINES = [
    "# cities", "", "上海=SHANGHAI,浦东新区,Shang Hai", "北京=BEIJING", "天津=TIANJIN", "香港=Hongkong, Hong Kong",
    "台北=Taipei", "兰州=LANZHOU", "南京=NANJING", "西安=XIAN, Xi an,Xi'an",
]


@pytest.fixture
def cities(spark):
    lines = spark.createDataFrame([(x,) for x in CITY_LINES], "line string")
    return lookup.Dictionary(dictionaries.city_aliases(lines), "alias", "canonical")


def _run(spark, inputs, step):
    df = spark.createDataFrame(list(enumerate(inputs)), "i int, t string")
    return [r.place for r in step(df).orderBy("i").collect()]


def test_city_format(spark, cities):
    spec = r"s/([^,;]+)(?:,[^;]*)?(?:;|$)/$1,/g"
    inputs = ["hong kong", "Taipei, Taiwan", "Beijing, Beijing, China; Shanghai, Shanghai, China", "nowhere", "", None, "上海市,北京"]
    got = _run(spark, inputs, lambda d: lookup.with_city_format(d, "t", cities, "place", spec))
    assert got == ["香港", "台北", "北京,上海", "其他", "其他", None, "上海"]
    got = _run(spark, inputs, lambda d: lookup.with_city_format(d, "t", cities, "place"))
    assert got == ["香港", "台北", "北京,北京,上海", "其他", "其他", None, "上海,北京"]


def test_match_all_replacement_adds_an_empty_match(spark, cities):
    got = _run(spark, ["x"], lambda d: lookup.with_city_format(d, "t", cities, "place", "s/.*/Beijing, Tianjin/g"))
    assert got == ["北京,天津"]


def test_city_tokens(spark, cities):
    inputs = ["Lanzhou, Gansu, CN", "中国 / 江苏 / 南京市 ", "Beijing or Shang Hai (浦东新区)<BR/>Beijing", "CN", "", None, "a / or Beijing"]
    got = _run(spark, inputs, lambda d: lookup.with_city_tokens(d, "t", cities, "place"))
    assert got == ["兰州", "南京", "上海,北京", "其他", "其他", None, "其他"]


def test_display_names(spark):
    lines = spark.createDataFrame([("Audi=一汽 AUDI",), ("GE:通用 GE",), (r"Two\ Words = X Y",)], "line string")
    names = lookup.Dictionary(dictionaries.company_names(lines), "key_upper", "display_name")
    got = _run(spark, ["audi", "Ge", "two words", "x", None], lambda d: lookup.with_display_name(d, "t", names, "place"))
    assert got == ["一汽 AUDI", "通用 GE", "X Y", "unknown", "unknown"]


def test_lookups_run_no_job_while_the_plan_is_built(spark, cities):
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    lookup.with_city_format(spark.createDataFrame([("x",)], "t string"), "t", cities, "place")
    assert len(tracker.getJobIdsForGroup(None)) == before


def test_rules_of_several_sites(spark, cities):
    raw = "map<string,array<string>>"
    rows = [
        ("a", "u", {"job_location": ["上海市-静安区"], "job_post_date": ["m06a - a19b - c2014"]}),
        ("b", "u", {"job_location": ["hong kong", "taipei"], "job_post_date": ["soon"]}),
        ("c", "u", {"job_location": ["Beijing / Tianjin"], "job_title": ["x\x01y"]}),
        ("d", "u", {"job_title": ["no place"]}),
        ("a", "v", {"job_location": ["nothing here", "somewhere市"], "job_post_date": ["m06a - a19b - c2014"]}),
    ]
    df = spark.createDataFrame(rows, f"site string, url string, raw {raw}")
    place = lambda *t: FieldRule("job_location", "p", transforms=t)
    dated = FieldRule("job_post_date", "p", transforms=(Transform("dateFormat", "MM-dd-yyyy"),))
    specs = [
        SiteSpec("a", list_rules=(place(Transform("regex_matcher", "/([^-]*)市/", 1, 1)), dated)),
        SiteSpec("b", list_rules=(place(Transform("location_regex", "s/x/y/g"), Transform("appendAfter", "!"), Transform("join", "+")), dated)),
        SiteSpec("*", list_rules=(place(), FieldRule("job_title", "p", is_fatal=False), FieldRule("job_type", how="int", value="3"))),
    ]
    rows = clean.with_fields(df, specs, "list", cities, AS_OF).collect()
    assert [r.job_location for r in rows if r.url == "v"] == ["其他"]  # no match is dropped
    got = {r.site: r for r in rows if r.url == "u"}
    assert set(got) == {"a", "b", "c"}  # d lacks its required place
    assert [got[s].job_location for s in "abc"] == ["上海", "香港!+台北!", "北京,天津"]
    assert got["a"].job_post_date.year == 2014 and got["b"].job_post_date == AS_OF.replace(minute=0, second=0)
    assert got["c"].job_title == "xy" and got["c"].job_type == 3 and got["a"].job_type is None
    assert (got["a"].post_date_guessed, got["b"].post_date_guessed) == (False, True)


def test_user_functions_see_their_own_rows_only(spark):
    def strict(values):
        assert (values != "other").all()
        return values.str.upper()

    df = spark.createDataFrame(
        [("a", "u", {"job_title": ["x", "y"]}), ("b", "u", {"job_title": ["other"]}), ("a", "u", {})],
        "site string, url string, raw map<string,array<string>>",
    )
    mine = FieldRule("job_title", "p", is_fatal=False, transforms=(Transform("executeScript", "up"),))
    specs = [SiteSpec("a", list_rules=(mine,)), SiteSpec("b", list_rules=(FieldRule("job_title", "p"),))]
    got = clean.with_fields(df, specs, "list", None, AS_OF, {"up": strict}).collect()
    assert sorted(str(r.job_title) for r in got) == ["None", "X<BR/>Y", "other"]
    with pytest.raises(ValueError):
        clean.with_fields(df, specs, "list", None, AS_OF, {})


def test_user_functions_get_a_slice_of_the_rows_at_once(spark):
    def counted(values):
        return values + f" of {len(values)}"

    rows = [(i, [f"{i}", None, f"{i}b"] if i % 3 else None) for i in range(1500)]
    df = spark.createDataFrame(rows, "i int, v array<string>").coalesce(1)
    got = {r.i: r.v for r in df.withColumn("v", clean.user_function(counted)(df["v"])).collect()}
    assert {i: v and [x and x.split(" ")[0] for x in v] for i, v in got.items()} == dict(rows)
    assert max(int(x.split(" ")[-1]) for v in got.values() if v for x in v if x) <= 2 * 256
