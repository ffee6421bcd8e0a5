"""Extraction from page snapshots."""

from pyspark.sql import functions as F

from .. import model
from ..functions import ids, text
from ..model import FieldRule, Loop, SiteSpec
from ..operators import clean, extract
from ..sources import pages
from . import AS_OF, query, table

_NAV = "//nav/ul/li"


def _pages(spark, sf):
    read = pages.read_pages(spark, f"{sf}/pages.parquet")
    return read.select("site", "url", F.col("page_id").cast("int").alias("page_no"), "html")


def _detail(spark, sf, *rules):
    spec = SiteSpec(extract.ANY_SITE, detail_groups=(rules,))
    return extract.extract(_pages(spark, sf), [spec], "detail"), [spec]


def _raw(name, position=1):
    return F.try_element_at(F.try_element_at("raw", F.lit(name)), F.lit(position))


_DECODE = "regexp_replace(replace(replace(replace({}, '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'), '&amp;?', '&', 'g')"


def _decoded(sql):
    return _DECODE.format(sql)


def _absolute(sql):
    """A link of the pages, seen from their address: those here begin with a slash."""
    return f"regexp_extract(url, '^https?://[^/?#]+') || {_decoded(sql)}"


def _shown(sql):
    """Text as shown: entities decoded, blanks collapsed."""
    return f"trim(regexp_replace({_decoded(sql)}, '\\s+', ' ', 'g'))"


@query(f"SELECT CAST(page_id AS INTEGER) AS page_no, url, {_shown("regexp_extract(html, '<title>(.*?)</title>', 1)")} AS job_title FROM pages")
def extract_title(spark, sf):
    rows, _ = _detail(spark, sf, FieldRule("job_title", "title", "TAG_NAME"))
    return rows.select("page_no", "url", _raw("job_title").alias("job_title"))


_LINKS_SQL = f"""links AS (
  SELECT page_id, url, unnest(regexp_extract_all(html, '<li><a href="([^"]*)">', 1)) AS href,
         unnest(regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a>', 1)) AS label,
         unnest(range(len(regexp_extract_all(html, '<li><a ')))) AS pos, len(regexp_extract_all(html, '<li><a ')) AS n FROM pages)"""


def _links(spark, sf, begin_from=0, end_to=0):
    spec = SiteSpec(
        extract.ANY_SITE,
        items=Loop(_NAV, begin_from=begin_from, end_to=end_to),
        list_rules=(
            FieldRule("job_url", "a", method="getAttribute", value="href"),
            FieldRule("job_title", "a"),
        ),
    )
    return extract.extract(_pages(spark, sf), [spec], "list")


@query(f"""WITH {_LINKS_SQL}
  SELECT CAST(page_id AS INTEGER) AS page_no, CAST(pos AS INTEGER) AS item_pos, {_absolute('href')} AS href, {_shown('label')} AS label FROM links""")
def extract_links(spark, sf):
    return _links(spark, sf).select("page_no", "item_pos", _raw("job_url").alias("href"), _raw("job_title").alias("label"))


@query(f"""WITH {_LINKS_SQL}
  SELECT CAST(page_id AS INTEGER) AS page_no, CAST(n AS INTEGER) AS n_items, CAST(pos AS INTEGER) AS item_pos, {_shown('label')} AS label
  FROM links WHERE pos >= 1 AND pos < n - 1""")
def list_items(spark, sf):
    rows = _links(spark, sf, begin_from=1, end_to=-1)
    return rows.select("page_no", "n_items", "item_pos", _raw("job_title").alias("label"))


@query(f"""WITH p AS (SELECT *, regexp_extract_all(html, '<li><a href="([^"]*)">', 1) AS hrefs,
                          regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a>', 1) AS labels FROM pages)
  SELECT CAST(page_id AS INTEGER) AS page_no, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang,
         {_shown("regexp_extract(html, '<h1>(.*?)</h1>', 1)")} AS heading,
         {_shown("regexp_extract(html, '(?s)<div class=.ad.>(.*?)</div>', 1)")} AS notice,
         {_shown('labels[1]')} AS first_label, {_absolute('hrefs[-1]')} AS last_href, {_absolute('hrefs[2]')} AS second_href,
         CAST(len(hrefs) AS INTEGER) AS n_links, {_shown("regexp_extract(html, '<footer>([^<]*)</footer>', 1)")} AS footer,
         {_decoded("regexp_extract(html, '(?s)<div class=.ad.>(.*?)</div>', 1)")} AS inner_notice
  FROM p""")
def extract_by_rule(spark, sf):
    """Every kind of selector and read method the pages can show, in one pass."""
    rows, _ = _detail(
        spark, sf,
        FieldRule("lang", "//HTML", method="getAttribute", value="lang"),
        FieldRule("heading", "//article/h1[1]"),
        FieldRule("notice", "ad", "CLASS_NAME"),
        FieldRule("first_label", f"{_NAV}[1]/a"),
        FieldRule("last_href", f"{_NAV}[last()]/descendant::A", method="getAttribute", value="href"),
        FieldRule("second_href", "//li[1]/following-sibling::li[1]/a[starts-with(@href,'/')]", method="getAttribute", value="href"),
        FieldRule("links", "//nav//a[contains(@href,'/') and not(@id)]"),
        FieldRule("footer", "footer", "CSS"),
        FieldRule("inner_notice", "//div[@class='ad' or @class='notice'] | //div[@id='ad']", method="innerHTML"),
    )
    return rows.select(
        "page_no",
        *(_raw(c).alias(c) for c in ("lang", "heading", "notice", "first_label", "last_href", "second_href")),
        F.size(F.try_element_at("raw", F.lit("links"))).alias("n_links"),
        _raw("footer").alias("footer"),
        _raw("inner_notice").alias("inner_notice"),
    )


@query("""SELECT CAST(doc_id AS VARCHAR) AS job_url, lang, CAST(quality AS VARCHAR) AS source, CAST(toxic AS VARCHAR) AS toxic
  FROM documents JOIN labels USING (doc_id)""")
def list_detail(spark, sf):
    """Documents as listing rows, labels as their detail pages; detail fields win."""
    listed = table(spark, sf, "documents").select(
        F.lit("s").alias("site"), F.col("doc_id").cast("string").alias("job_url"), "lang", "source"
    )
    detail = table(spark, sf, "labels").select(
        F.col("doc_id").cast("string").alias("url"),
        F.create_map(
            F.lit("source"), F.array(F.col("quality").cast("string")), F.lit("toxic"), F.array(F.col("toxic").cast("string"))
        ).alias("raw"),
    )
    joined = extract.list_with_detail(listed, detail)
    spec = SiteSpec("s", detail_groups=((FieldRule("source", "p"), FieldRule("toxic", "p"), FieldRule("lang", "p", is_fatal=False)),))
    return clean.with_fields(joined, [spec], "detail", None, AS_OF).select("job_url", "lang", "source", "toxic")


_LABELS = """regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a>', 1)"""


@query(f"""SELECT CAST(page_id AS INTEGER) AS page_no, {_shown(_LABELS + '[5]')} AS job_category_domain,
       CASE WHEN len({_LABELS}) > 5 THEN {_shown(_LABELS + '[6]')} END AS job_sub_company
  FROM pages WHERE len({_LABELS}) > 4""")
def required_fields(spark, sf):
    """Pages without a fifth link lack a required field; a missing sixth one is allowed."""
    rows, specs = _detail(
        spark, sf,
        FieldRule("job_category_domain", f"{_NAV}[5]/a"),
        FieldRule("job_sub_company", f"{_NAV}[6]/a", is_fatal=False),
    )
    return clean.with_fields(rows, specs, "detail", None, AS_OF).select("page_no", "job_category_domain", "job_sub_company")


_HREFS = """regexp_extract_all(html, '<li><a href="([^"]*)">', 1)"""


@query(f"SELECT CAST(page_id AS INTEGER) AS page_no, url AS page_url, CASE WHEN len({_HREFS}) > 5 THEN {_absolute(_HREFS + '[6]')} ELSE url END AS job_url FROM pages")
def url_default(spark, sf):
    rows, specs = _detail(
        spark, sf,
        FieldRule("page_url", how="url"),
        FieldRule("job_url", f"{_NAV}[6]/a", method="getAttribute", value="href", is_fatal=False),
    )
    cleaned = clean.with_fields(rows, specs, "detail", None, AS_OF)
    return cleaned.select("page_no", "page_url", ids.url_or_page(F.col("job_url"), F.col("url")).alias("job_url"))


@query("SELECT CAST(page_id AS INTEGER) AS page_no, 2 AS job_url_type, CAST(NULL AS INTEGER) AS job_type FROM pages")
def int_const(spark, sf):
    rows, specs = _detail(
        spark, sf,
        FieldRule("job_url_type", how="int", value="2"),
        FieldRule("job_type", how="int", value="two", is_fatal=False),
    )
    return clean.with_fields(rows, specs, "detail", None, AS_OF).select("page_no", "job_url_type", "job_type")


@query("""WITH d AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: x <> '') AS v FROM documents)
  SELECT doc_id, array_to_string(v, '<BR/>') AS joined, array_to_string(v, ',') AS listed FROM d""")
def join_values(spark, sf):
    lines = F.split("text", "\n")
    return table(spark, sf, "documents").select(
        "doc_id", text.join_values(lines).alias("joined"), text.join_values(lines, ",").alias("listed")
    )


@query("""WITH p AS (SELECT page_id, CAST(len(regexp_extract_all(html, '<li>')) AS INTEGER) AS nodes,
         nullif(regexp_extract(url, '(?:page|utm_source)=([^&]*)', 1), '') AS page_count FROM pages)
  SELECT CAST(page_id AS INTEGER) AS page_no, 1 AS nodes_from, nodes - 1 AS nodes_to,
         page_count IS NULL OR TRY_CAST(page_count AS INTEGER) IS NOT NULL AS usable, 0 AS stated_from,
         CASE WHEN page_count IS NULL THEN 1 ELSE TRY_CAST(page_count AS INTEGER) END AS stated_to FROM p""")
def page_bounds(spark, sf):
    """Page ranges by pager nodes (second to last but one) and by a stated count, which may be absent or no number."""
    spec = SiteSpec(extract.ANY_SITE, detail_groups=((),), pages=Loop(_NAV, "page"))
    rows = extract.extract(_pages(spark, sf), [spec], "detail")
    stated = F.nullif(F.regexp_extract("url", r"(?:page|utm_source)=([^&]*)", 1), F.lit(""))
    none = F.lit(None).cast("string")
    by_nodes = extract.page_bounds(F.col("pager_nodes"), none, F.lit(False), F.lit(1), F.lit(-1))
    by_count = extract.page_bounds(F.col("pager_nodes"), stated, F.lit(True), F.lit(0), F.lit(0))
    both = rows.select("page_no", by_nodes.alias("n"), by_count.alias("s"))
    return both.select(
        "page_no", F.col("n.from_page").alias("nodes_from"), F.col("n.to_page").alias("nodes_to"),
        F.col("s.usable").alias("usable"), F.col("s.from_page").alias("stated_from"), F.col("s.to_page").alias("stated_to"),
    )


@query("""WITH r AS (SELECT l_orderkey, min(CASE WHEN l_returnflag = 'R' THEN l_linenumber END) AS f,
    min(CASE WHEN l_shipdate < TIMESTAMP '1996-01-01' THEN l_linenumber END) AS o, max(l_linenumber) AS m FROM lineitem GROUP BY 1),
  s AS (SELECT l_orderkey, coalesce(f, m) AS last_run, coalesce(o <= coalesce(f, m), false) AS outdated, f FROM r)
  SELECT l_orderkey, last_run, outdated, f IS NULL AND NOT outdated AS kept FROM s""")
def sibling_groups(spark, sf):
    results = table(spark, sf, "lineitem").select(
        "l_orderkey",
        F.col("l_linenumber").alias("group_no"),
        (F.col("l_returnflag") != "R").alias("passed"),
        (F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp_ntz")).alias("outdated"),
    )
    return extract.first_failed_group(results, ["l_orderkey"])


@query("""SELECT CAST(l_orderkey AS VARCHAR) AS site, l_linenumber AS group_no, l_returnflag AS field FROM lineitem
  WHERE l_linenumber > 1 AND l_linestatus = 'O'""")
def verify_rules(spark, sf):
    """Line items as rules: the first line is the list level, closed ones are commented out."""
    commented = F.when(F.col("l_linestatus") != "O", "comment:").otherwise("")
    rules = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("site"),
        F.when(F.col("l_linenumber") > 1, "detail").otherwise("list").alias("level"),
        F.col("l_linenumber").alias("group_no"),
        F.concat(commented, "l_returnflag").alias("field"),
    )
    return model.verify_rules(rules).select("site", "group_no", "field")
