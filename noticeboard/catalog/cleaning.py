"""Scalar cleaning."""

import re

from pyspark.sql import functions as F

from ..functions import dates, ids, text
from ..model import FieldRule, SiteSpec, Transform
from ..operators import clean, lookup
from ..sources import dictionaries
from . import AS_OF, ORDERS_AS_OF, ORDERS_AS_OF_SQL, query, table

_HOUR_SQL = "TIMESTAMP '2024-01-31 10:00:00'"
_SHORT = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
_LONG = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
_DAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def _pick(names, number):
    return F.element_at(F.split(F.lit(",".join(names)), ","), number)


def _two(number):
    return F.lpad(number.cast("string"), 2, "0")


# Date parts as text, from the wall-clock value alone.
_PARTS = {
    "y": lambda d: F.year(d).cast("string"),
    "yy": lambda d: F.substring(F.year(d).cast("string"), 3, 2),
    "M": lambda d: F.month(d).cast("string"),
    "MM": lambda d: _two(F.month(d)),
    "MMM": lambda d: _pick(_SHORT, F.month(d)),
    "MMMM": lambda d: _pick(_LONG, F.month(d)),
    "zh": lambda d: _pick(dates.CHINESE_MONTHS, F.month(d)),
    "d": lambda d: F.day(d).cast("string"),
    "dd": lambda d: _two(F.day(d)),
    "EEE": lambda d: F.substring(_pick(_DAYS, F.dayofweek(d)), 1, 3),
    "EEEE": lambda d: _pick(_DAYS, F.dayofweek(d)),
    "t": lambda d: F.substring(d.cast("string"), 12, 8),
}


def _render(date, form):
    """Fill a form such as ``{d} {MMM} {y}`` with date parts."""
    chunks = [c for c in re.split(r"(\{\w+\})", form) if c]
    return F.concat(*(_PARTS[c[1:-1]](date) if c.startswith("{") else F.lit(c) for c in chunks))


def _lines(spark, sf, field):
    """Documents as pages: the lines of a text are the elements found for ``field``."""
    raw = F.create_map(F.lit(field), F.split("text", "\n"))
    return table(spark, sf, "documents").select("doc_id", "text").select("doc_id", F.lit("").alias("url"), raw.alias("raw"))


@query("""WITH e AS (SELECT doc_id, list_transform(string_split(text, chr(10)),
      lambda x: '[' || regexp_replace(regexp_replace(x, '([A-Z])[a-z]*', '\\1', 'g'), '[aeiou]', '', 'g') || ';') AS v FROM documents)
  SELECT doc_id, array_to_string(list_filter(v, lambda x: x <> ''), ' | ') AS value FROM e""")
def transform_chain(spark, sf):
    rule = FieldRule("job_category_domain", "p", transforms=(
        Transform("regex", "s/([A-Z])[a-z]*/$1/g"), Transform("regex", "s#[aeiou]##g"),
        Transform("insertBefore", "["), Transform("appendAfter", ";"), Transform("join", " | "),
    ))
    rows = _lines(spark, sf, "job_category_domain")
    return clean.with_field(rows, rule, "value", None, AS_OF).select("doc_id", "value")


@query("SELECT o_orderkey, 'Ref: ' || o_orderpriority || ' (open)' AS value FROM orders")
def affix(spark, sf):
    value = clean.affix(F.col("o_orderpriority"), "Ref: ", " (open)")
    return table(spark, sf, "orders").select("o_orderkey", value.alias("value"))


@query("""SELECT doc_id, regexp_replace(text, '([A-Za-z]+), ([a-z]+)', '\\2/\\1', 'g') AS swapped,
  regexp_replace(text, '(?i)th', 't', 'g') AS folded FROM documents""")
def regex_sub(spark, sf):
    doc = F.col("text")
    return table(spark, sf, "documents").select("doc_id", "text").select(
        "doc_id",
        text.regex_sub(doc, r"s/([A-Za-z]+), ([a-z]+)/$2\/$1/g").alias("swapped"),
        text.regex_sub(doc, "s#th#t#gi").alias("folded"),
    )


@query("""WITH d AS (SELECT doc_id, regexp_extract_all(text, '([A-Za-z]+)([,.])', 1) AS m FROM documents)
  SELECT doc_id, array_to_string(m, ',') AS every, coalesce(m[2], '') AS second, coalesce(m[-1], '') AS last FROM d""")
def match_nth(spark, sf):
    doc, spec = F.col("text"), "/([A-Za-z]+)([,.])/"
    return table(spark, sf, "documents").select("doc_id", "text").select(
        "doc_id",
        text.match_nth(doc, spec, 0).alias("every"),
        text.match_nth(doc, spec, 2).alias("second"),
        text.match_nth(doc, spec, -1).alias("last"),
    )


# Each layout with an order date written in it, with stray letters as sites have them.
_LAYOUT_FORMS = {
    "MM-dd-yyyy": ("mm_dd_yyyy", "m{MM}a - a{dd}b - c{y}"),
    "MM dd yyyy": ("mm_dd_yyyy_blank", "on {M} . {d}, {y}"),
    "MMM dd yyyy": ("mmm_dd_yyyy", "{MMMM} a{d}b   year{y}a"),
    "MMM-dd-yyyy": ("mmm_dd_yyyy_dash", "{MMMM}-a{d}b-year{y}a"),
    "dd MM yyyy": ("dd_mm_yyyy", "d{dd}a   m{MM}b  y{y}c"),
    "yyyy-MM-dd": ("yyyy_mm_dd", "y{y}a-m{M}b - d{d}c - "),
    "yyyy MM dd": ("yyyy_mm_dd_blank", "{y}y {M}m {d}d"),
    "yyyy/MM/dd": ("yyyy_mm_dd_slash", "{y}/{MM}/{dd}"),
    "yyyyMMdd": ("yyyymmdd", "at {y}{MM}{dd}"),
}


@query("SELECT o_orderkey, " + ", ".join(f"o_orderdate AS {n}" for n, _ in _LAYOUT_FORMS.values()) + " FROM orders")
def date_layouts(spark, sf):
    date = F.col("o_orderdate")
    texts = {name: _render(date, form) for name, form in _LAYOUT_FORMS.values()}
    layouts = {name: layout for layout, (name, _) in _LAYOUT_FORMS.items()}
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return dates.with_dates(rows, texts, layouts).drop("o_orderdate")


# Default formats: name, text form, and the part of the time that is kept.
_DEFAULT_FORMS = [
    ("iso_zulu", "{y}-{MM}-{dd}T{t}Z", "second"),
    ("iso_millis", "{y}-{MM}-{dd}T{t}.25Z", "second"),
    ("iso_plain", "{y}-{M}-{d}T{t} or so", "second"),
    ("day", "'{y}-{M}-{d}'", "day"),
    ("day_and_time", "{y}-{MM}-{dd} {t}", "day"),
    ("with_zone", "{EEE} {MMM} {d} {t} EST {y}", "second"),
    ("day_month", "{d}-{MMM}-{y}", "day"),
    ("day_month_blank", "{dd} {MMMM} {y}, late", "day"),
    ("slashes", "{M}/{d}/{y}", "day"),
    ("asctime", "{EEE} {MMM} {d} {t} {y}", "second"),
    ("rfc1036", "{EEEE}, {dd}-{MMM}-{yy} {t} GMT", "second"),
    ("rfc1123", "{EEE}, {dd} {MMM} {y} {t} +0200", "second"),
]
_SHIFTS = {
    "iso_millis": "+ to_milliseconds(250)",
    "with_zone": "+ to_hours(CAST(5 - CASE WHEN hour(ts) = 12 THEN 12 ELSE 0 END AS INTEGER))",
    "rfc1123": "- to_hours(2)",
}


@query("SELECT event_id, " + ", ".join(
    f"CAST(date_trunc('{part}', ts) AS TIMESTAMP) {_SHIFTS.get(name, '')} AS {name}" for name, _, part in _DEFAULT_FORMS) + " FROM events")
def date_parse(spark, sf):
    texts = {name: _render(F.col("ts"), form) for name, form, _ in _DEFAULT_FORMS}
    return dates.with_dates(table(spark, sf, "events").select("event_id", "ts"), texts).drop("ts")


@query("SELECT o_orderkey, o_orderdate + to_milliseconds(125) AS posted FROM orders")
def epoch_ms(spark, sf):
    days = F.date_diff(F.to_date("o_orderdate"), F.lit("1970-01-01").cast("date")).cast("bigint")
    millis = (days * 86400000 + 125).cast("string")
    return table(spark, sf, "orders").select("o_orderkey", dates.parse_date(millis).alias("posted"))


@query(f"""SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN {_HOUR_SQL} ELSE o_orderdate END AS job_post_date,
  o_orderstatus = 'O' AS post_date_guessed FROM orders WHERE o_orderstatus <> 'P'""")
def date_fallback(spark, sf):
    """An unreadable post date becomes now; an unreadable expiry date drops the row when it is required."""
    date = F.col("o_orderdate")
    posted = F.when(F.col("o_orderstatus") == "O", "soon").otherwise(_render(date, "{d} {MMM} {y}"))
    expires = F.when(F.col("o_orderstatus") == "P", "31/31/2000").otherwise(_render(date, "{M}/{d}/{y}"))
    raw = F.create_map(F.lit("job_post_date"), F.array(posted), F.lit("job_expire_date"), F.array(expires))
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate").select("o_orderkey", raw.alias("raw"))
    rows = clean.with_field(rows, FieldRule("job_post_date", "p"), "job_post_date", None, AS_OF)
    rows = clean.with_field(rows, FieldRule("job_expire_date", "p"), "job_expire_date", None, AS_OF)
    return rows.where("job_expire_date is not null").select("o_orderkey", "job_post_date", "post_date_guessed")


@query("SELECT o_orderkey, o_orderdate AS posted FROM orders")
def month_names(spark, sf):
    posted = dates.parse_date(_render(F.col("o_orderdate"), "{d} {zh} {y}"))
    return table(spark, sf, "orders").select("o_orderkey", posted.alias("posted"))


def _cities(spark, sf):
    """Nations as aliases of their region; the nations of region 4 are left out."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    line = F.concat(F.col("r_name"), F.lit("="), F.col("n_name"))
    lines = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).where("n_regionkey <> 4")
    return lookup.Dictionary(dictionaries.city_aliases(lines.select(line.alias("line"))), "alias", "canonical")


_CITIES_SQL = """pairs AS (SELECT lower(n_name) AS alias, r_name AS canonical FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_regionkey <> 4
    UNION SELECT lower(r_name), r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_regionkey <> 4
    UNION SELECT lower(r_name) || '市', r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_regionkey <> 4)"""


@query(f"""WITH {_CITIES_SQL}, s AS (SELECT c_custkey, [lower('NATION_' || c_nationkey), c_mktsegment, 'NATION_' || ((c_nationkey + 6) % 25), 'asia'] AS t FROM customer),
  e AS (SELECT c_custkey, unnest(t) AS token, unnest([1, 2, 3, 4]) AS pos FROM s),
  j AS (SELECT c_custkey, string_agg(canonical, ',' ORDER BY pos) AS place FROM e JOIN pairs ON lower(trim(token)) = alias GROUP BY 1)
  SELECT c_custkey, coalesce(place, '其他') AS place,
         CASE WHEN c_nationkey % 5 = 4 THEN '其他' ELSE (SELECT r_name FROM region WHERE r_regionkey = c_nationkey % 5) END AS home
  FROM customer LEFT JOIN j USING (c_custkey)""")
def city_format(spark, sf):
    nation = F.col("c_nationkey")
    places = F.concat(
        F.lit("nation_"), nation, F.lit(","), "c_mktsegment", F.lit(", N'ATION_"), (nation + 6) % 25, F.lit("市, asia")
    )
    rows = table(spark, sf, "customer").select(
        "c_custkey", places.alias("text"), F.concat(F.lit("NATION_"), nation, F.lit("-east")).alias("home_text")
    )
    cities = _cities(spark, sf)
    rows = lookup.with_city_format(rows, "text", cities, "place")
    rows = lookup.with_city_format(rows, "home_text", cities, "home", "s/([^-]*)-.*/$1/g")
    return rows.select("c_custkey", "place", "home")


_TOKENIZE_SQL = f"""{_CITIES_SQL}, s AS (SELECT c_custkey, unnest(['nation_' || c_nationkey, 'nation_' || ((c_nationkey + 6) % 25), lower(c_mktsegment),
    'nation_' || ((c_nationkey + 11) % 25), 'nation_' || ((c_nationkey + 5) % 25)]) AS token FROM customer),
  j AS (SELECT c_custkey, string_agg(DISTINCT canonical, ',' ORDER BY canonical) AS place FROM s JOIN pairs ON token = alias GROUP BY 1)"""


def _place_text():
    nation = F.col("c_nationkey")

    def name(n):
        return F.concat(F.lit("Nation_"), (nation + n) % 25)

    return F.concat(name(0), F.lit(" / "), name(6), F.lit(" or "), "c_mktsegment", F.lit(" ("), name(11), F.lit(")<BR/>"), name(5))


@query(f"WITH {_TOKENIZE_SQL} SELECT c_custkey, coalesce(place, '其他') AS place FROM customer LEFT JOIN j USING (c_custkey)")
def city_tokenize(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", _place_text().alias("text"))
    return lookup.with_city_tokens(rows, "text", _cities(spark, sf), "place").select("c_custkey", "place")


@query(f"""WITH {_TOKENIZE_SQL} SELECT c_custkey, coalesce(place, '其他') AS job_location,
  TIMESTAMP '2014-06-01' + to_days(c_nationkey) AS job_post_date FROM customer LEFT JOIN j USING (c_custkey)""")
def default_clean(spark, sf):
    """Fields without a formatting transform: places are tokenized, dates parsed."""
    posted = _render(F.date_add(F.lit("2014-06-01").cast("date"), F.col("c_nationkey")).cast("timestamp_ntz"), "{d} {MMM} {y}")
    raw = F.create_map(F.lit("job_location"), F.array(_place_text()), F.lit("job_post_date"), F.array(posted))
    rows = table(spark, sf, "customer").select("c_custkey", raw.alias("raw"))
    rows = clean.with_field(rows, FieldRule("job_location", "p"), "job_location", _cities(spark, sf), AS_OF)
    rows = clean.with_field(rows, FieldRule("job_post_date", "p"), "job_post_date", None, AS_OF)
    return rows.select("c_custkey", "job_location", "job_post_date")


@query("SELECT doc_id, text FROM documents")
def strip_nonchar(spark, sf):
    """Documents with control and non-character code points put in come back as they were."""
    dirty = F.concat(F.lit("\x01￾"), F.replace("text", F.lit(" "), F.lit("\x0b ﷑\x1f")), F.lit("￿"))
    return table(spark, sf, "documents").select("doc_id", "text").select("doc_id", text.strip_nonchar(dirty).alias("text"))


@query("SELECT doc_id, replace(text, 'e', '') AS text FROM documents")
def clean_field(spark, sf):
    dirty = F.replace("text", F.lit("e"), F.lit("�"))
    return table(spark, sf, "documents").select("doc_id", "text").select("doc_id", text.drop_replacement(dirty).alias("text"))


def _replace_all(sql, *steps):
    for pattern, replacement in steps:
        sql = f"regexp_replace({sql}, '{pattern}', {replacement}, 'g')"
    return sql


_TEXT_SQL = _replace_all(
    "html",
    (r"(?is)<(script|style)\b.*?</(script|style)>|<!--.*?-->", "''"),
    (r"\s+", "' '"),
    (r"(?i)</a\s*>", "' ' || chr(1) || chr(2)"),
    (r"(?i)<li\b[^>]*>", "chr(10) || ' * '"),
    (r"(?i)<(p|h[1-5]|tr)\b[^>]*>", "chr(10)"),
    (r"(?i)<br\b[^>]*>|</(dd|dt|p|h[1-5])\s*>", "chr(10)"),
    (r"<[^>]*>", "''"),
    (r"\x01", "'<'"), (r"\x02", "'>'"), (" +", "' '"), ("&quot;?", "'\"'"), ("&copy;?", "'©'"), ("&middot;?", "'·'"), ("&amp;?", "'&'"),
)


@query(f"SELECT page_id, {_TEXT_SQL} AS plain FROM pages")
def html_to_text(spark, sf):
    """The pages have relative links only; links with an address are covered by the tests."""
    return table(spark, sf, "pages").select("page_id", "html").select("page_id", text.html_to_text(F.col("html")).alias("plain"))


@query("""SELECT page_id, md5(url) AS by_url, md5(url || coalesce(CASE WHEN url LIKE 'https%' THEN regexp_extract(html, '<title>(.*?)</title>', 1) END, '')) AS by_url_and_title,
  md5(regexp_replace(url, '([^?#]*)[?#].*', '\\1', 'g')) AS by_part FROM pages""")
def posting_id(spark, sf):
    url = F.col("url")
    title = F.when(F.startswith("url", F.lit("https")), F.regexp_extract("html", "<title>(.*?)</title>", 1))
    return table(spark, sf, "pages").select(
        "page_id",
        ids.posting_id(url, title).alias("by_url"),
        ids.posting_id(url, title, "url_plus_title").alias("by_url_and_title"),
        ids.posting_id(url, title, "regex_on_url", "s/([^?#]*)[?#].*/$1/g").alias("by_part"),
    )


@query(f"""SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_orderdate ELSE {_HOUR_SQL} END AS job_post_date,
  CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS job_expire_date, {_HOUR_SQL} AS job_index_date,
  0 AS job_type, CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 0 END AS job_url_type, coalesce(nullif(o_orderstatus = 'F', false), false) AS job_expired FROM orders""")
def posting_defaults(spark, sf):
    status, date = F.col("o_orderstatus"), F.col("o_orderdate")
    rows = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(status == "O", date).alias("job_post_date"),
        dates.parse_date(F.when(status == "F", dates.iso_text(date)).otherwise("")).alias("job_expire_date"),
        F.when(status == "P", 2).alias("job_url_type"),
        F.when(status == "F", True).alias("job_expired"),
    )
    columns = ["job_post_date", "job_expire_date", "job_index_date", "job_type", "job_url_type", "job_expired"]
    return clean.with_defaults(rows, AS_OF).select("o_orderkey", *columns)


_ISO_SQL = """regexp_replace(regexp_replace(strftime(date_trunc('milliseconds', {0}), '%Y-%m-%dT%H:%M:%S.%g'), '(\\.[0-9]*?)0+$', '\\1'), '\\.$', '') || 'Z'"""


@query(f"""SELECT event_id, {_ISO_SQL.format('ts')} AS iso, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS indexed,
  {_ISO_SQL.format("date_trunc('minute', ts)")} AS iso_whole FROM events""")
def iso_render(spark, sf):
    whole = F.col("ts") - F.make_dt_interval(secs=F.concat(F.lit("0"), F.substring(F.col("ts").cast("string"), 18, 9)).cast("decimal(18,6)"))
    return table(spark, sf, "events").select(
        "event_id", dates.iso_text(F.col("ts")).alias("iso"), dates.index_text(F.col("ts")).alias("indexed"), dates.iso_text(whole).alias("iso_whole")
    )


@query(f"""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 0
  ELSE CAST((epoch_us({ORDERS_AS_OF_SQL}) - epoch_us(o_orderdate)) // 86400000000 + 1 AS INTEGER) END AS days FROM orders""")
def days_delta(spark, sf):
    text_date = F.when(F.col("o_orderstatus") == "P", "unknown").otherwise(dates.iso_text(F.col("o_orderdate")))
    days = dates.days_delta(dates.parse_date(text_date), dates.ntz(ORDERS_AS_OF))
    return table(spark, sf, "orders").select("o_orderkey", days.alias("days"))


# As many sites as a large set of site files has, each with rules of its own.
_SITES = 61
_SITE_LAYOUTS = ["MM-dd-yyyy", "MMM dd yyyy", "yyyy/MM/dd"]


def _site_spec(n):
    return SiteSpec(f"site{n}", list_rules=(
        FieldRule("job_title", "h1", transforms=(Transform("regex", f"s/^([0-9])-/{n}:$1 /g"), Transform("appendAfter", f" #{n}"))),
        FieldRule("job_post_date", "i", transforms=(Transform("dateFormat", _SITE_LAYOUTS[n % 3]),)),
        FieldRule("job_sub_company", "b", transforms=(Transform("insertBefore", f"[{n}]"), Transform("join", f" {n} "))),
        FieldRule("job_category_domain", "p", is_fatal=n % 2 == 0, transforms=(Transform("regex_matcher", f"/([A-Z]{{{n % 4 + 2}}})$/"),)),
    ))


@query(f"""WITH o AS (SELECT *, o_orderkey % {_SITES} AS n, o_orderpriority AS p FROM orders)
  SELECT o_orderkey, CASE WHEN regexp_matches(p, '^[0-9]-') THEN n || ':' || substr(p, 1, 1) || ' ' || substr(p, 3) ELSE p END || ' #' || n AS job_title,
         o_orderdate AS job_post_date, '[' || n || ']' || p || ' ' || n || ' [' || n || ']' || o_orderstatus AS job_sub_company,
         CASE WHEN p = '5-LOW' AND n % 4 = 2 THEN '' WHEN regexp_matches(right(p, CAST(n % 4 + 2 AS INTEGER)), '^[A-Z]*$') THEN '其他' ELSE '' END AS job_category_domain
  FROM o""")
def many_sites(spark, sf):
    """Orders as rows of 61 sites; no two sites share a rule."""
    date, n = F.col("o_orderdate"), F.col("o_orderkey") % _SITES
    written = F.element_at(F.array(*(_render(date, _LAYOUT_FORMS[layout][1]) for layout in _SITE_LAYOUTS)), (n % 3).cast("int") + 1)
    raw = F.map_from_arrays(
        F.array(*map(F.lit, ("job_title", "job_post_date", "job_sub_company", "job_category_domain"))),
        F.array(F.array("o_orderpriority"), F.array(written), F.array("o_orderpriority", "o_orderstatus"), F.array("o_orderpriority")),
    )
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    rows = rows.select("o_orderkey", F.concat(F.lit("site"), n).alias("site"), F.lit("").alias("url"), raw.alias("raw"))
    cleaned = clean.with_fields(rows, [_site_spec(k) for k in range(_SITES)], "list", _cities(spark, sf), AS_OF)
    return cleaned.select("o_orderkey", "job_title", "job_post_date", "job_sub_company", "job_category_domain")


@query("""WITH e AS (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x: replace(trim(x), 'e', 'E') || '!') AS v FROM documents)
  SELECT doc_id, array_to_string(list_filter(v, lambda x: x <> ''), '<BR/>') AS value FROM e""")
def user_function(spark, sf):
    """A user's function, by name, between built-in transforms."""
    rule = FieldRule("job_category_domain", "p", transforms=(Transform("executeScript", "shout"), Transform("appendAfter", "!")))
    functions = {"shout": lambda values: values.str.strip(" ").str.replace("e", "E")}
    rows = _lines(spark, sf, "job_category_domain")
    return clean.with_field(rows, rule, "value", None, AS_OF, functions).select("doc_id", "value")
