"""The posting schema, site specs, and the specs as tables."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The field names of a posting and their types.
POSTING_FIELDS = {
    "id": "string",
    "job_company": "string",
    "job_sub_company": "string",
    "job_url": "string",
    "job_title": "string",
    "job_location": "string",
    "job_category_domain": "string",
    "job_post_date": "timestamp_ntz",
    "job_expire_date": "timestamp_ntz",
    "job_index_date": "timestamp_ntz",
    "job_description": "string",
    "job_description_stripped": "string",
    "job_type": "int",
    "job_url_type": "int",
    "job_expired": "boolean",
}
DATE_FIELDS = ("job_post_date", "job_expire_date")
TEXT_FIELDS = ("job_title", "job_description")
LOCATION_FIELD = "job_location"

UNKNOWN_COMPANY = "unknown"  # fixed value
OTHER_PLACE = "其他"  # fixed value

# What a site with its own freshness window gets for pages and postings.
PAGES_WITH_WINDOW = 1000
JOBS_WITH_WINDOW = 10000


@dataclass(frozen=True)
class Transform:
    how: str
    value: str | None = None
    which: int = 0
    group: int = 1


@dataclass(frozen=True)
class FieldRule:
    """How to take one field from a page or from one item of a list."""

    field: str
    selector: str | None = None
    how: str = "XPATH"
    method: str | None = None
    value: str | None = None
    is_fatal: bool = True
    transforms: tuple[Transform, ...] = ()


@dataclass(frozen=True)
class Loop:
    """A list of items, a list of pager nodes, or a stated page count."""

    selector: str | None = None
    item_type: str = "job"
    begin_from: int = 0
    end_to: int = 0
    total_pages: FieldRule | None = None


@dataclass(frozen=True)
class Limits:
    """Collection limits; a site's own values come before the global ones."""

    n_days: int = 180
    n_pages: int = 1000
    n_jobs: int = 10000
    n_jobs_per_page: int = 5000


@dataclass(frozen=True)
class SiteSpec:
    site: str
    items: Loop | None = None
    list_rules: tuple[FieldRule, ...] = ()
    detail_groups: tuple[tuple[FieldRule, ...], ...] = ()
    pages: Loop | None = None
    outer: Loop | None = None
    id_how: str | None = None
    id_regex: str | None = None
    n_pages: int | None = None
    n_days: int | None = None
    n_jobs: int | None = None
    check_index: bool = False
    verify_single: bool = False

    def detail_rules(self) -> tuple[FieldRule, ...]:
        return tuple(rule for group in self.detail_groups for rule in group)

    def for_site(self, site: str) -> SiteSpec:
        return replace(self, site=site)


LOOP_SCHEMA = (
    "site string, begin_page int, end_page int, stated boolean, bounded boolean, paged boolean, "
    "begin_item int, addon boolean"
)
SITE_CONFIG_SCHEMA = (
    "site string, id_how string, id_regex string, n_pages int, n_days int, n_jobs int, "
    "check_index boolean, verify_single boolean"
)
EXTRACT_RULE_SCHEMA = (
    "site string, level string, group_no int, field string, selector string, how string, "
    "method string, attr string, is_fatal boolean, "
    "transforms array<struct<how:string,value:string,which:int,group:int>>"
)


def site_config(spark: SparkSession, specs: list[SiteSpec]) -> DataFrame:
    rows = [
        (s.site, s.id_how, s.id_regex, s.n_pages, s.n_days, s.n_jobs, s.check_index, s.verify_single)
        for s in specs
    ]
    return spark.createDataFrame(rows, SITE_CONFIG_SCHEMA)


def loop_rules(spark: SparkSession, specs: list[SiteSpec]) -> DataFrame:
    """Per site how its pages and items are looped over. ``bounded``: the pages say how many
    there are; ``paged``: the loop is one of pages, so an old row ends it. An outer loop of other things
    (categories, say) goes on with its next one; where there is no page loop within it, nothing
    ends early."""
    rows = []
    for s in specs:
        pages, items = s.pages or Loop(), s.items or Loop()
        stated = pages.total_pages is not None and not pages.selector
        bounded = stated or bool(pages.selector)
        paged = pages.item_type != "other" and (s.outer is None or s.pages is not None)
        addon = items.item_type == "job_addon"
        rows.append((s.site, pages.begin_from, pages.end_to, stated, bounded, paged, items.begin_from, addon))
    return spark.createDataFrame(rows, LOOP_SCHEMA)


def extract_rules(spark: SparkSession, specs: list[SiteSpec]) -> DataFrame:
    rows = [
        (s.site, level, no, r.field, r.selector, r.how, r.method, r.value, r.is_fatal,
         [(t.how, t.value, t.which, t.group) for t in r.transforms])
        for s in specs
        for level, groups in (("list", (s.list_rules,)), ("detail", s.detail_groups))
        for no, group in enumerate(groups)
        for r in group
    ]
    return spark.createDataFrame(rows, EXTRACT_RULE_SCHEMA)


def active_rules(rules: DataFrame) -> DataFrame:
    """Rules commented out by their field name are ignored."""
    return rules.where(~F.startswith("field", F.lit("comment:")))


def verify_rules(rules: DataFrame) -> DataFrame:
    """Rechecking a posting uses the detail page alone."""
    return active_rules(rules).where(F.col("level") == "detail")
