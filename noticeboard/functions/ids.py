"""Posting ids and the small constants of a posting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import regex_sub


def posting_id(url: Column, title: Column, how: str | None = None, spec: str | None = None) -> Column:
    """MD5 of the address, of address plus title, or of the rewritten address."""
    if how == "url_plus_title":
        return F.md5(F.concat(url, F.coalesce(title, F.lit(""))))
    if how == "regex_on_url" and spec:
        return F.md5(regex_sub(url, spec))
    return F.md5(url)


def int_constant(value: str | None) -> Column:
    """A constant field; null when the text is not a whole number."""
    return F.lit(value).try_cast("int")


def url_or_page(url: Column, page_url: Column) -> Column:
    return F.coalesce(url, page_url)


def host(url: Column) -> Column:
    return F.regexp_extract(url, r"^https?://([^/?#]+)", 1)


def resolve(link: Column, page_url: Column) -> Column:
    """A link seen from the address of its page; one with a scheme stays as it is."""
    link = F.trim(link)
    page = F.regexp_replace(page_url, "#.*$", "")
    origin = F.regexp_extract(page, "^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?]*)", 1)
    scheme = F.regexp_extract(page, "^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    path = F.regexp_extract(page, "^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?]*([^?]*)", 1)
    folder = F.regexp_replace(path, "[^/]*$", "")
    from_folder = F.concat(F.when(F.startswith(link, F.lit("/")), F.lit("")).otherwise(F.when(folder == "", "/").otherwise(folder)), link)
    whole = F.concat(origin, _without_dots(F.regexp_extract(from_folder, "^([^?#]*)", 1)), F.regexp_extract(from_folder, "^[^?#]*(.*)$", 1))
    return (
        F.when(link.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:") | page_url.isNull() | (scheme == ""), link)
        .when(link == "", page)
        .when(F.startswith(link, F.lit("//")), F.concat(scheme, link))
        .when(F.startswith(link, F.lit("?")), F.concat(origin, path, link))
        .when(F.startswith(link, F.lit("#")), F.concat(page, link))
        .otherwise(whole)
    )


def _without_dots(path: Column) -> Column:
    """A path without the steps "." and ".."."""

    def step(done: Column, part: Column) -> Column:
        back = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1)))
        return F.when(part == "..", back).when(part == ".", done).otherwise(F.array_append(done, part))

    parts = F.split(path, "/")
    open_end = F.when(F.element_at(parts, -1).isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    shown = F.concat(F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/"), open_end)
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), shown).otherwise(path)
