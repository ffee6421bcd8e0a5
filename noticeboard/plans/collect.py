"""Pages to postings: extract, clean, join details, limit, finish."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, ids
from ..model import POSTING_FIELDS, Limits, SiteSpec, loop_rules, site_config
from ..operators import clean, limits
from ..operators.extract import ANY_SITE, extract, list_with_detail, page_bounds
from ..operators.lookup import Dictionary, with_display_name
from ..operators.sieve import sifted
from ..session import written

_LISTING = ["site", "outer_no"]
# Tells the rows of a listing apart: several addresses may share a page number.
_KEY = [*_LISTING, "page_no", "url", "item_pos"]
_LIMITS = ["n_days", "n_pages", "n_jobs", "n_jobs_per_page"]
_LOOPS = ["begin_page", "end_page", "stated", "bounded", "paged", "begin_item", "addon"]
_ROW = "__row"
# Settings are sent to every task up to this size; beyond it Spark joins them by shuffle.
_SENT_BYTES = 8 << 20


def _with_settings(df: DataFrame, specs: list[SiteSpec], defaults: Limits) -> DataFrame:
    """Every row's limits and loops; a site without a spec of its own has those of ``*``."""
    spark = df.sparkSession
    named = [s for s in specs if s.site != ANY_SITE]
    general = next((s for s in specs if s.site == ANY_SITE), SiteSpec(ANY_SITE))
    config, loops = site_config(spark, [*named, general]), loop_rules(spark, [*named, general])
    settings = limits.effective_limits(config, defaults).join(loops, "site").withColumnRenamed("site", "__site")
    if 200 * len(named) <= _SENT_BYTES:  # a row per spec, of less than 200 bytes without its name
        settings = F.broadcast(settings)
    key = F.when(F.col("site").isin(*(s.site for s in named)), F.col("site")).otherwise(ANY_SITE)
    return df.join(settings, key == F.col("__site")).drop("__site")


def _checks_index(specs: list[SiteSpec]) -> Column:
    named = {s.site: s.check_index for s in specs}
    own = F.when(F.col("site").isin(*named), F.col("site").isin(*[s for s, on in named.items() if on]))
    return own.otherwise(F.lit(named.get(ANY_SITE, False)))


def _in_bounds(rows: DataFrame) -> DataFrame:
    """Pages of a listing, as many as its first page states."""
    first = rows.where("bounded").groupBy(*_LISTING).agg(
        F.min(F.struct("page_no", "pager_nodes", "page_count", "stated", "begin_page", "end_page")).alias("p")
    )
    bounds = page_bounds(*(F.col(f"p.{c}") for c in ("pager_nodes", "page_count", "stated", "begin_page", "end_page")))
    bounded = limits.within_page_bounds(rows.where("bounded"), _LISTING, first.select(*_LISTING, bounds.alias("b")).select(*_LISTING, "b.*"))
    return rows.where("not bounded").unionByName(bounded)


def _new_rows(rows: DataFrame) -> DataFrame:
    """Of growing lists only the rows each page adds."""
    return rows.where("not addon").unionByName(limits.new_positions(rows.where("addon"), _LISTING))


def accepted_rows(rows: DataFrame, bounded: bool = True, growing: bool = True) -> DataFrame:
    """Numbers of the rows that stay, by page bounds, paging stop, page cap and posting caps.

    ``rows`` has the row's number and key, its limits and loops, and the flags ``outdated`` and
    ``known``; only these narrow columns are shuffled. Of copies of a row one stays. A page is left at its cap,
    so what lies behind cannot stop the paging.
    """
    settings = [*_LIMITS, *_LOOPS, "pager_nodes", "page_count"]
    rows = rows.groupBy(*_KEY).agg(F.min(_ROW).alias(_ROW), F.bool_and("outdated").alias("outdated"), F.bool_or("known").alias("known"), *(F.first(c).alias(c) for c in settings))
    rows = _in_bounds(rows) if bounded else rows
    rows = _new_rows(rows) if growing else rows
    shown = limits.page_cap(rows, [*_LISTING, "url"], F.col("n_jobs_per_page"), F.col("begin_item"), ~F.col("outdated"))
    hit = F.col("paged") & (F.col("outdated") | F.col("known"))
    shown = limits.paging_stop(shown, _LISTING, hit).where(~F.col("outdated"))
    no_cap = 2**31 - 1
    shown = limits.pages_cap(shown, F.when(F.col("paged"), F.col("n_pages")).otherwise(no_cap), F.col("begin_page"))
    # The site cap counts and then ranks these rows; writing them spares it the joins above twice.
    shown = written(shown.select(*_KEY, _ROW, "n_jobs"), "shown")
    return limits.site_cap(shown, ["site"], F.col("n_jobs"), outer=["outer_no"], tie=["url"]).select(_ROW)


def _known(rows: DataFrame, index_ids: DataFrame, specs: list[SiteSpec]) -> DataFrame:
    """``known`` for the rows of sites that look into the index, by the narrow columns alone."""
    asked = rows.where(_checks_index(specs)).select("id", _ROW)
    found = limits.mark_known(asked, index_ids).where("known").select(_ROW, "known")
    return rows.join(found, _ROW, "left").withColumn("known", F.coalesce("known", F.lit(False)))


def collect_postings(
    pages: DataFrame,
    specs: list[SiteSpec],
    as_of: datetime,
    cities: Dictionary,
    companies: Dictionary,
    details: DataFrame | None = None,
    index_ids: DataFrame | None = None,
    defaults: Limits = Limits(),
    functions: dict[str, clean.UserFunction] | None = None,
) -> DataFrame:
    """Postings of all pages, cleaned and limited.

    ``pages`` are the listings (site, url, page_no, html), ``details`` the pages of single
    postings (site, url, page_no, html); of either the newest snapshot counts where fetched_at
    tells them apart.

    Extracted rows are written once; limits are worked out on their keys and flags alone, and
    one join on the row's number fetches the rows that stay.
    """
    now = dates.ntz(as_of)
    old = dates.outdated(F.col("job_post_date"), now, F.col("n_days"))
    rows = clean.with_fields(extract(pages, specs, "list"), specs, "list", cities, as_of, functions)
    if "job_post_date" not in rows.columns:
        rows = rows.withColumns(
            {"job_post_date": F.lit(None).cast("timestamp_ntz"), "post_date_guessed": F.lit(False)}
        )
    rows = _with_settings(rows, specs, defaults).withColumn("outdated", old)
    for name in ("job_url", "job_title"):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("string"))
    rows = rows.withColumn("job_url", F.coalesce(ids.resolve(F.col("job_url"), F.col("url")), "url"))
    if details is not None:
        rows = written(rows, "listed")
        listed = rows.where("not outdated").withColumn("__listing_url", F.col("url"))
        # Detail pages of addresses that no row lists are sieved out where they are read, before they are parsed.
        asked = sifted(details, "url", listed, "job_url")
        joined = list_with_detail(listed, extract(asked, specs, "detail"))
        checked = clean.with_fields(joined, specs, "detail", cities, as_of, functions, keep_failed=True)
        # A page that lacks a required field but shows an old date still says that the listing has got that far.
        complete = checked.withColumn("outdated", old).where("outdated or not failed").drop("failed")
        complete = complete.withColumn("job_url", F.coalesce(ids.resolve(F.col("job_url"), F.col("url")), "url"))
        complete = complete.withColumn("url", F.col("__listing_url")).drop("__listing_url")
        rows = complete.unionByName(rows.where("outdated"), allowMissingColumns=True)
    rows = clean.with_id(rows, specs).drop("raw").withColumn(_ROW, F.monotonically_increasing_id())
    rows = written(rows, "extracted")  # from here on a row has its number

    narrow = rows.select(*_KEY, *_LIMITS, *_LOOPS, "pager_nodes", "page_count", "outdated", "id", _ROW)
    narrow = narrow.withColumn("known", F.lit(False)) if index_ids is None else _known(narrow, index_ids, specs)
    bounded = any(s.pages and (s.pages.selector or s.pages.total_pages) for s in specs)
    growing = any(s.items and s.items.item_type == "job_addon" for s in specs)
    postings = rows.where("not outdated").join(accepted_rows(narrow, bounded, growing), _ROW, "left_semi")
    guessed = F.coalesce("post_date_guessed", F.lit(False)) | F.col("job_post_date").isNull()
    postings = with_display_name(postings.withColumn("post_date_guessed", guessed), "site", companies, "job_company")
    postings = clean.with_defaults(postings, as_of)
    return postings.select(*POSTING_FIELDS, "site", "outer_no", "page_no", "item_pos", "post_date_guessed")
