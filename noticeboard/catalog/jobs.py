"""Whole jobs over the pages."""

import json

from pyspark.sql import functions as F

from ..model import FieldRule, Limits, Loop, SiteSpec, Transform
from ..operators.extract import ANY_SITE
from ..operators.lookup import Dictionary
from ..plans.collect import collect_postings
from ..plans.recheck import alive_urls, recheck_postings
from ..session import new_folder
from ..sources import pages as page_source
from ..sources import specs as spec_source
from . import AS_OF, query, table
from .extraction import _HREFS, _shown

# Every page is a listing with one posting, its article.
SPEC = SiteSpec(
    ANY_SITE,
    items=Loop("//article"),
    list_rules=(
        FieldRule("job_url", how="url"),
        FieldRule("job_title", "h1"),
        FieldRule("job_sub_company", "//div[@class='ad']", is_fatal=False, transforms=(Transform("regex", r"s/([^.]*)\..*/$1/g"),)),
        FieldRule("job_description", "p", method="innerHTML"),
        FieldRule("job_url_type", how="int", value="2"),
    ),
)


def _pages(spark, sf):
    read = page_source.read_pages(spark, f"{sf}/pages.parquet")
    return read.select("site", "url", F.col("page_id").cast("int").alias("page_no"), "html")


def _companies(spark, sf):
    """Hosts with a display name: those of .org addresses."""
    hosts = page_source.read_pages(spark, f"{sf}/pages.parquet").where(F.endswith("site", F.lit(".org")))
    return Dictionary(hosts.select(F.upper("site").alias("k"), F.concat(F.lit("Org "), "site").alias("v")), "k", "v")


@query(f"""WITH p AS (SELECT *, regexp_extract(url, '^https?://([^/?#]+)', 1) AS site FROM pages WHERE html LIKE '%<h1>%'),
  k AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY site ORDER BY page_id) <= 10000)
  SELECT CAST(page_id AS INTEGER) AS page_no, md5(url) AS id, url AS job_url, CASE WHEN site LIKE '%.org' THEN 'Org ' || site ELSE 'unknown' END AS job_company,
    {_shown("regexp_extract(html, '<h1>(.*?)</h1>', 1)")} AS job_title,
    regexp_replace({_shown("regexp_extract(html, '(?s)<div class=.ad.>(.*?)</div>', 1)")}, '([^.]*)\\..*', '\\1') AS job_sub_company,
    TIMESTAMP '2024-01-31 10:00:00' AS job_post_date, 0 AS job_type, 2 AS job_url_type, false AS job_expired FROM k""")
def collect_job(spark, sf):
    rows = collect_postings(
        _pages(spark, sf), [SPEC], AS_OF, Dictionary(table(spark, sf, "nation"), "n_name", "n_name"), _companies(spark, sf),
        defaults=Limits(n_pages=1_000_000_000),  # page ids stand for page numbers here
    )
    return rows.select(
        "page_no", "id", "job_url", "job_company", "job_title", "job_sub_company", "job_post_date", "job_type", "job_url_type", "job_expired"
    )


@query(f"""WITH p AS (SELECT *, regexp_extract(url, '^https?://([^/?#]+)', 1) AS site FROM pages WHERE html LIKE '%<h1>%' AND len({_HREFS}) > 4),
  s AS (SELECT site, min(page_id) AS stop FROM p WHERE page_id % 7 = 3 GROUP BY site),
  k AS (SELECT p.* FROM p LEFT JOIN s USING (site) WHERE stop IS NULL OR page_id <= stop),
  c AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY site ORDER BY page_id) <= 3)
  SELECT CAST(page_id AS INTEGER) AS page_no, md5(url) AS id, url AS job_url, {_shown("regexp_extract(html, '<h1>(.*?)</h1>', 1)")} AS job_title,
    {_shown("regexp_extract_all(html, '<li><a href=\"[^\"]*\">([^<]*)</a>', 1)[5]")} AS job_category_domain FROM c""")
def collect_detail_job(spark, sf):
    """Pages as listings of one posting and as its detail page, with some ids in the index and a cap per site."""
    spec = SiteSpec(
        ANY_SITE,
        items=Loop("//article"),
        list_rules=(FieldRule("job_url", how="url"), FieldRule("job_title", "h1")),
        detail_groups=((FieldRule("job_category_domain", "//nav/ul/li[5]/a"),),),
        check_index=True,
        n_jobs=3,
    )
    pages = _pages(spark, sf)
    known = table(spark, sf, "pages").where("page_id % 7 = 3").select(F.md5("url").alias("id"))
    rows = collect_postings(
        pages, [spec], AS_OF, Dictionary(table(spark, sf, "nation"), "n_name", "n_name"), _companies(spark, sf),
        details=pages, index_ids=known, defaults=Limits(n_pages=1_000_000_000),
    )
    return rows.select("page_no", "id", "job_url", "job_title", "job_category_domain")


# Categories around pages around postings.
_NESTED = {
    "name": ANY_SITE, "check_index": True, "fetch.n.pages": 2000,
    "procedure": {
        "loop": {"loop_type": "begin", "xpath_prefix": "//nav", "loop_item_type": "other"},
        "procedure": {
            "loop": {"loop_type": "end", "loop_item_type": "page"},
            "procedure": {
                "loop": {"loop_type": "begin", "xpath_prefix": "//article"},
                "extracts": {"job_url": {"how": "url"}, "job_title": {"element": "h1"}},
            },
        },
    },
}


@query("""WITH p AS (SELECT *, regexp_extract(url, '^https?://([^/?#]+)', 1) AS site, page_id % 3 AS outer_no FROM pages WHERE html LIKE '%<h1>%'),
  s AS (SELECT site, outer_no, min(page_id) AS stop FROM p WHERE page_id % 7 = 3 GROUP BY ALL)
  SELECT CAST(page_id AS INTEGER) AS page_no, CAST(p.outer_no AS INTEGER) AS outer_no, url AS job_url FROM p LEFT JOIN s USING (site, outer_no)
  WHERE (stop IS NULL OR page_id <= stop) AND page_id < 2000""")
def nested_loops_job(spark, sf):
    """Specs from files; each category of a site is paged on its own, up to the first known posting and the page cap."""
    folder = new_folder(spark, "specs")
    spark.createDataFrame([(json.dumps(_NESTED),)], "value string").coalesce(1).write.text(folder)
    read = spec_source.read_specs(spark, folder, "part-*")
    pages = _pages(spark, sf).withColumn("outer_no", F.col("page_no") % 3)
    known = table(spark, sf, "pages").where("page_id % 7 = 3").select(F.md5("url").alias("id"))
    rows = collect_postings(pages, read, AS_OF, Dictionary(table(spark, sf, "nation"), "n_name", "n_name"), _companies(spark, sf), index_ids=known)
    return rows.select("page_no", "outer_no", "job_url")


_RULES = (FieldRule("job_title", "h1", "TAG_NAME"), FieldRule("job_category_domain", "//nav/ul/li[5]/a"))
_LATER_RULES = (FieldRule("job_title", "h1", "TAG_NAME"), FieldRule("job_sub_company", "//nav/ul/li[6]/a"))


@query(f"""WITH p AS (SELECT CAST(page_id AS VARCHAR) AS id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS co, len({_HREFS}) > 4 AS ok,
    len({_HREFS}) > 5 AS ok2 FROM pages),
  g AS (SELECT *, NOT bool_or(ok) OVER (PARTITION BY co) AS every FROM p WHERE co NOT LIKE '%.net'),
  h AS (SELECT *, NOT bool_or(ok2) OVER (PARTITION BY co) AS every2 FROM g WHERE every)
  SELECT id, CASE WHEN ok THEN 'alive' ELSE 'confirmed' END AS outcome FROM g WHERE NOT every
  UNION ALL SELECT id, CASE WHEN every2 THEN 'alarm' WHEN ok2 THEN 'alive' ELSE 'confirmed' END FROM h
  UNION ALL SELECT id, 'skipped' FROM p WHERE co LIKE '%.net'""")
def recheck_job(spark, sf):
    """Pages as old postings; their own pages are looked at again, twice."""
    pages = _pages(spark, sf)
    postings = page_source.read_pages(spark, f"{sf}/pages.parquet").select(
        F.col("page_id").cast("string").alias("id"),
        F.col("url").alias("job_url"),
        F.col("site").alias("job_company"),
        F.lit("2023-01-01").cast("timestamp_ntz").alias("job_post_date"),
        F.lit(None).cast("timestamp_ntz").alias("job_expire_date"),
        F.lit(False).alias("job_expired"),
    )
    sites = pages.where(~F.endswith("site", F.lit(".net"))).select(
        F.col("site").alias("job_company"), "site", F.lit(False).alias("verify_single")
    ).distinct()
    alive = [alive_urls(pages, [SiteSpec(ANY_SITE, detail_groups=(rules,))], None, AS_OF) for rules in (_RULES, _LATER_RULES)]
    return recheck_postings(postings, sites, alive, AS_OF, 15)
