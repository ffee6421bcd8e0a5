"""Site rules to Column expressions: transforms, default cleaning, posting defaults."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, ids
from ..functions import text as text_functions
from ..model import (
    DATE_FIELDS,
    LOCATION_FIELD,
    POSTING_FIELDS,
    TEXT_FIELDS,
    FieldRule,
    SiteSpec,
)
from . import programme
from .extract import ANY_SITE
from .lookup import Dictionary, tokenize_places

_ALL = ("insertBefore", "appendAfter", "regex", "join", "executeScript", *programme.FORMATTING)

#: Rows whose elements a user's function gets at once.
_SLICE = 256

UserFunction = Callable[[pd.Series], pd.Series]


def check_rules(specs: list[SiteSpec], functions: dict[str, UserFunction] | None = None) -> None:
    """Wrong patterns, unknown transforms and missing user functions fail when rules are loaded."""
    for spec in specs:
        if spec.id_how == "regex_on_url" and spec.id_regex:
            text_functions.substitution(spec.id_regex)
        for rule in (*spec.list_rules, *spec.detail_rules()):
            for t in rule.transforms:
                if t.how not in _ALL:
                    raise ValueError(f"{spec.site}.{rule.field}: unknown transform {t.how!r}")
                if t.how in ("regex", "location_regex"):
                    text_functions.substitution(t.value)
                if t.how == "executeScript" and t.value not in (functions or {}):
                    raise ValueError(f"{spec.site}.{rule.field}: no user function named {t.value!r}")


def affix(text: Column, before: str = "", after: str = "") -> Column:
    return F.concat(F.lit(before), text, F.lit(after))


def user_function(function: UserFunction) -> Callable[[Column], Column]:
    """A user's function over every element of an array column, a slice of an Arrow batch at a time: the
    arrays are laid end to end, and their ends put back afterwards. No more than a slice is held as Python values."""

    def changed(values: pa.Array) -> pa.Array:
        flat = values.flatten().to_pandas()
        present = flat[flat.notna()].reset_index(drop=True)
        done = flat.astype(object)
        if len(present):
            done[flat.notna()] = list(function(present))
        lengths = pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False)
        ends = pa.array(np.concatenate(([0], lengths.cumsum())).astype("int32"))
        lists = pa.ListArray.from_arrays(ends, pa.array(done, pa.string(), from_pandas=True))
        return pc.if_else(values.is_valid(), lists, pa.nulls(len(values), lists.type))

    @F.arrow_udf("array<string>")
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for values in batches:
            for at in range(0, len(values), _SLICE):
                yield changed(values.slice(at, _SLICE))

    return apply


def _fields_of(df: DataFrame, everything: list[dict], cities: Dictionary | None, as_of: datetime, functions: dict[str, UserFunction] | None) -> DataFrame:
    """Add ``__new_<field>`` for every field that the rows' programmes may name."""
    df = programme.run(df, everything, cities, functions or {}, user_function)
    names = list(dict.fromkeys(e["field"] for e in everything))
    read = {e["field"] for e in everything if e["constant"] is None}
    for field in names:
        new, own = f"__new_{field}", programme.rule_of(field)
        constant = F.when(own["constant"] == programme.PAGE_URL, F.col("url")).otherwise(own["constant"])
        if field not in read:
            whole = all(e["constant"] != programme.PAGE_URL for e in everything if e["field"] == field)
            df = df.withColumn(new, own["constant"].try_cast("int") if whole else constant)
            continue
        value = F.try_element_at("__said", F.lit(field))
        if field in TEXT_FIELDS:
            value = text_functions.strip_nonchar(value)
        if field in DATE_FIELDS:
            df = programme.worked_out(df, new, dates.parse_date(value))
        else:
            df = df.withColumn(new, value)
        if field == LOCATION_FIELD and cities is not None and any(e["plain"] for e in everything if e["field"] == field):
            plain = own["plain"] & F.col(new).isNotNull()
            df = tokenize_places(df.withColumn("__v", F.when(plain, F.array(new))), "__v", cities)
            df = df.withColumn(new, F.when(F.col("__v").isNotNull(), F.col("__v")[0]).otherwise(F.col(new))).drop("__v")
        if any(e["constant"] is not None for e in everything if e["field"] == field):
            df = df.withColumn(new, F.when(own["constant"].isNotNull(), constant).otherwise(F.col(new)))
        if field == "job_post_date":
            ruled = own.isNotNull() & own["constant"].isNull() & F.map_contains_key("raw", F.lit(field))
            before = F.col("post_date_guessed") if "post_date_guessed" in df.columns else F.lit(False)
            df = df.withColumn("__now", F.coalesce(ruled, F.lit(False)) & F.col(new).isNull())
            df = df.withColumn("post_date_guessed", F.when(F.col("__now") | F.col(new).isNotNull(), F.col("__now")).otherwise(before))
            df = df.withColumn(new, F.when(F.col("__now"), dates.ntz(dates.on_the_hour(as_of))).otherwise(F.col(new))).drop("__now")
    return df.drop("__said")


def with_field(
    df: DataFrame,
    rule: FieldRule,
    out: str,
    cities: Dictionary | None,
    as_of: datetime,
    functions: dict[str, UserFunction] | None = None,
) -> DataFrame:
    """One field by one rule for all rows."""
    df, everything = programme.with_programme(df, [SiteSpec(ANY_SITE, list_rules=(rule,))], "list")
    df = _fields_of(df, everything, cities, as_of, functions)
    return df.withColumn(out, F.col(f"__new_{rule.field}")).drop("__rules", f"__new_{rule.field}")


def _rows_of(sites: list[str], specs: list[SiteSpec]) -> Column:
    """Rows of the given sites; ``*`` stands for every site without a spec of its own."""
    rows = F.col("site").isin(*[s for s in sites if s != ANY_SITE])
    if ANY_SITE in sites:
        named = [s.site for s in specs if s.site != ANY_SITE]
        rows = rows | ~F.col("site").isin(*named) if named else F.lit(True)
    return rows


def with_fields(
    df: DataFrame,
    specs: list[SiteSpec],
    level: str,
    cities: Dictionary | None,
    as_of: datetime,
    functions: dict[str, UserFunction] | None = None,
    keep_failed: bool = False,
) -> DataFrame:
    """All fields of a level by the rules of each row's site.

    The rules are data (see ``programme``): the plan doesn't grow with their number. Rows lacking a required
    field are dropped, or marked ``failed`` if they are kept.
    """
    check_rules(specs, functions)
    df, everything = programme.with_programme(df, specs, level)
    df = _fields_of(df, everything, cities, as_of, functions)
    names = list(dict.fromkeys(e["field"] for e in everything))
    lacking = [
        F.coalesce(programme.rule_of(field)["required"], F.lit(False)) & F.col(f"__new_{field}").isNull()
        for field in names
        if any(e["required"] for e in everything if e["field"] == field)
    ]
    failed = reduce(lambda a, b: a | b, lacking, F.lit(False))
    if keep_failed:
        df = df.withColumn("failed", failed)
    elif lacking:
        df = df.where(~failed)
    for field in names:
        new = F.col(f"__new_{field}")
        df = df.withColumn(field, F.coalesce(new, F.col(field)) if field in df.columns else new)
    return df.drop("__rules", *(f"__new_{field}" for field in names))


def with_id(df: DataFrame, specs: list[SiteSpec]) -> DataFrame:
    url, title = F.col("job_url"), F.col("job_title")
    chosen = ids.posting_id(url, title)
    for spec in specs:
        if spec.id_how:
            here = _rows_of([spec.site], specs)
            chosen = F.when(here, ids.posting_id(url, title, spec.id_how, spec.id_regex)).otherwise(chosen)
    return df.withColumn("id", chosen)


def with_defaults(df: DataFrame, as_of: datetime) -> DataFrame:
    """What a posting has when its site gives nothing: dates, type codes, the open flag, plain text."""
    have = set(df.columns)

    def get(name: str) -> Column:
        return F.col(name) if name in have else F.lit(None).cast(POSTING_FIELDS[name])

    now = dates.ntz(dates.on_the_hour(as_of))
    df = df.withColumns(
        {
            "job_post_date": F.coalesce(get("job_post_date"), now),
            "job_expire_date": get("job_expire_date"),
            "job_index_date": now,
            "job_type": F.coalesce(get("job_type"), F.lit(0)),
            "job_url_type": F.coalesce(get("job_url_type"), F.lit(0)),
            "job_expired": F.coalesce(get("job_expired"), F.lit(False)),
            "job_description_stripped": text_functions.html_to_text(get("job_description")),
        }
    )
    missing = {name: get(name) for name in POSTING_FIELDS if name not in df.columns}
    return df.withColumns(missing) if missing else df
