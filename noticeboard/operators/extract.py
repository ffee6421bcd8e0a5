"""Fields from page snapshots, by site rules.

A map-only step: pages stay where they are read, each page is parsed once for all of its
rules, and only the extracted values leave the task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids, markup
from ..model import FieldRule, SiteSpec
from .skew import join_facts

ANY_SITE = "*"
_OUT = (
    "site string, url string, outer_no int, page_no int, n_items int, item_pos int, pager_nodes int, "
    "page_count string, raw map<string,array<string>>"
)
_ARROW = pa.schema(
    [(part.split()[0], pa.int32() if part.endswith(" int") else pa.string()) for part in _OUT.split(", ")[:-1]]
    + [("raw", pa.map_(pa.string(), pa.list_(pa.string())))]
)
# Pages are taken as Python values a few at a time, and rows leave in batches of about so many characters.
_PAGES_AT_ONCE = 64
_BATCH_CHARACTERS = 1 << 20
# Taken as Columns afterwards, not from the page.
_CONSTANT_HOW = ("url", "int")
# Attributes that a browser gives as absolute addresses.
_ADDRESSES = ("href", "src")


def _check(specs: list[SiteSpec]) -> None:
    """Unsupported selectors and methods fail here, before any task runs."""
    for spec in specs:
        rules = [r for r in (*spec.list_rules, *spec.detail_rules()) if r.how not in _CONSTANT_HOW]
        if spec.pages and spec.pages.total_pages:
            rules.append(spec.pages.total_pages)
        for rule in rules:
            markup.selector(rule.selector, rule.how)
            if rule.method not in (None, "getText", "getValue", "getAttribute", "innerHTML"):
                raise ValueError(f"unsupported method {rule.method!r} for {rule.field}")
        for loop in (spec.items, spec.pages):
            if loop and loop.selector:
                markup.selector(loop.selector)


def _read_value(page: markup.Page, url: str | None, element, rule: FieldRule) -> str | None:
    method = rule.method or ("innerHTML" if rule.field == "job_description" else "getText")
    if method == "innerHTML":
        return markup.inner_html(element)
    if method == "getText":
        return markup.visible_text(element)
    name = rule.value if method == "getAttribute" and rule.value else "value"
    value = element.get(name)
    return page.address(value, url) if value is not None and name in _ADDRESSES else value


def _values(page: markup.Page, url: str | None, rules, scope=None, index: int = 0) -> dict[str, list[str]]:
    """Field to values; a field is absent when nothing is found or a value cannot be read."""
    out = {}
    for rule in rules:
        if rule.how in _CONSTANT_HOW:
            continue
        found = [_read_value(page, url, e, rule) for e in page.find(rule.selector, rule.how, scope, index)]
        if found and None not in found:
            out[rule.field] = found
    return out


def _rules_of(spec: SiteSpec, level: str):
    rules = spec.list_rules if level == "list" else spec.detail_rules()
    return [r for r in rules if not r.field.startswith("comment:")]


def _pager(page: markup.Page, spec: SiteSpec) -> tuple[int | None, str | None]:
    if spec.pages is None:
        return None, None
    if spec.pages.selector:
        return len(page.find(spec.pages.selector)), None
    if spec.pages.total_pages is None:
        return None, None
    count = _values(page, None, [spec.pages.total_pages]).get(spec.pages.total_pages.field)
    return None, "<BR/>".join(v for v in count if v) if count else None


def _page_rows(spec: SiteSpec, level: str, url: str | None, html: str) -> Iterator[tuple]:
    page = markup.Page(html)
    pager_nodes, page_count = _pager(page, spec)
    rules = _rules_of(spec, level)
    if level == "detail":
        yield None, None, pager_nodes, page_count, _values(page, url, rules)
        return
    items = page.find(spec.items.selector)
    for pos in range(spec.items.begin_from, len(items) + spec.items.end_to):
        if pos < len(items):
            yield len(items), pos, pager_nodes, page_count, _values(page, url, rules, items[pos], pos + 1)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    at = schema.names.index("raw")
    columns[at] = [list(fields.items()) for fields in columns[at]]
    return pa.RecordBatch.from_arrays([pa.array(values, kind.type) for values, kind in zip(columns, schema)], schema=schema)


def _size(raw: dict[str, list[str]]) -> int:
    return 100 + sum(len(v) for values in raw.values() for v in values)


def _rows_of(batches: Iterator[pa.RecordBatch], by_site: dict[str, SiteSpec], level: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The rows of a task's pages; what it holds as Python values depends on neither its pages nor their batches."""
    versioned = "version" in schema.names
    rows, size = [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, _PAGES_AT_ONCE):
            part = batch.slice(start, _PAGES_AT_ONCE)
            for site, url, outer_no, page_no, html, *version in zip(*(column.to_pylist() for column in part.columns)):
                spec = by_site.get(site, by_site.get(ANY_SITE))
                if spec is None:
                    continue
                found = _page_rows(spec, level, url, html)
                if versioned:  # a page without rows still counts as the newest
                    found = chain(found, [(0, None, None, None, {})])
                for n, pos, nodes, count, raw in found:
                    rows.append((site, url, outer_no, page_no, n, pos, nodes, count, raw, *version))
                    size += _size(raw)
                    if size >= _BATCH_CHARACTERS:
                        yield _batch(rows, schema)
                        rows, size = [], 0
    yield _batch(rows, schema)


def extract(pages: DataFrame, specs: list[SiteSpec], level: str) -> DataFrame:
    """One row per list item (``level='list'``) or per page (``level='detail'``).

    ``pages`` has site, url, page_no and html, outer_no where pages are looped over once per
    category, and fetched_at where an address may have several snapshots: then only what the
    newest one gives stays (``newest``). A missing page_no or outer_no is 0, a missing site the
    host of the address. A site without a spec of its own uses the spec named ``*``; without
    that its pages are skipped.
    """
    _check(specs)
    by_site = {s.site: s for s in specs if level == "detail" or s.items}
    versioned = "fetched_at" in pages.columns
    schema = _ARROW.append(pa.field("version", pa.string())) if versioned else _ARROW

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _rows_of(batches, by_site, level, schema)

    site = F.coalesce("site", ids.host(F.col("url")), F.lit(""))
    if ANY_SITE not in by_site:
        pages = pages.where(site.isin(*by_site))
    outer_no = F.coalesce("outer_no", F.lit(0)) if "outer_no" in pages.columns else F.lit(0)
    columns = [site.alias("site"), "url", outer_no.alias("outer_no"), F.coalesce("page_no", F.lit(0)).alias("page_no"), "html"]
    if not versioned:
        return pages.select(*columns).mapInArrow(run, _OUT)
    # Sorts by time, snapshots of one moment by their contents.
    version = F.concat(F.coalesce(F.date_format(F.col("fetched_at").cast("timestamp_ntz"), "yyyyMMddHHmmssSSSSSS"), F.lit("")), F.md5(F.coalesce("html", F.lit(""))))
    return newest(pages.select(*columns, version.alias("version")).mapInArrow(run, _OUT + ", version string"), level)


def newest(rows: DataFrame, level: str) -> DataFrame:
    """Rows of the newest snapshot of each address (``detail``) or listing page (``list``); rows
    with neither position nor values only say that there is a snapshot.

    Works on what was extracted: the pages themselves are never moved.
    """
    rows = rows.withColumn("__url", F.coalesce("url", F.lit("")))
    keys = ["__url"] if level == "detail" else ["site", "outer_no", "page_no", "__url"]
    last = rows.groupBy(*keys).agg(F.max("version").alias("version"))
    shown = rows.where(F.col("n_items").isNull() | F.col("item_pos").isNotNull())
    return join_facts(shown, last, [*keys, "version"]).drop("version", "__url")


def page_bounds(pager_nodes: Column, page_count: Column, stated: Column, loop_begin: Column, loop_end: Column) -> Column:
    """Pages to run over: ``from`` inclusive, ``to`` exclusive, and whether the page is usable.

    ``stated`` says that the rule names a page count. No count found means one page; a count
    that is no number fails; zero pages means the current page is taken once.
    """
    number = page_count.try_cast("int")
    total = F.when(~stated, pager_nodes).otherwise(F.when(page_count.isNull(), 1).otherwise(number))
    return F.struct(
        total.isNotNull().alias("usable"),
        F.when(total == 0, 0).otherwise(loop_begin).alias("from_page"),
        F.when(total == 0, 1).otherwise(total + loop_end).alias("to_page"),
    )


def list_with_detail(items: DataFrame, details: DataFrame) -> DataFrame:
    """List rows, their list fields cleaned, with the raw values and the address of their detail
    page; a row whose page is missing is dropped. ``details`` has one row per address, or several
    copies of one: any of them serves."""
    detail = details.groupBy(F.col("url").alias("job_url")).agg(F.first("raw").alias("raw"))
    return join_facts(items.drop("raw", "url"), detail, ["job_url"]).withColumn("url", F.col("job_url"))


def first_failed_group(results: DataFrame, posting: list[str]) -> DataFrame:
    """Ordered sibling rule groups of a posting: the first failure skips the rest.

    ``results`` has group_no, passed and outdated. A posting is kept when no group failed and
    none of those that ran was outdated. Aggregates only, so no posting is gathered in one task
    before it is reduced.
    """
    fail = F.min(F.when(~F.col("passed"), F.col("group_no")))
    first_outdated = F.min(F.when(F.col("outdated"), F.col("group_no")))
    reduced = results.groupBy(*posting).agg(
        fail.alias("failed_group"), first_outdated.alias("outdated_group"), F.max("group_no").alias("last_group")
    )
    ran_outdated = F.coalesce(
        F.col("outdated_group") <= F.coalesce(F.col("failed_group"), F.col("last_group")), F.lit(False)
    )
    return reduced.select(
        *posting,
        F.coalesce("failed_group", "last_group").alias("last_run"),
        ran_outdated.alias("outdated"),
        (F.col("failed_group").isNull() & ~ran_outdated).alias("kept"),
    )
