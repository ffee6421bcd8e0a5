"""Field rules as data.

A site's rules are a programme: one entry per field with its steps, each a kind and its parameters. Programmes
are rows of a small table that is joined to the pages' values by site. Step k of all rules is then one pass over
the rows: the kinds that occur there are the branches, patterns and texts come from the row. The plan grows with the
longest chain of steps and the kinds used, not with the number of sites or rules. Place lookups and users'
functions are table steps between the passes; each sees the values of its own rules only.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..functions import text as text_functions
from ..model import FieldRule, SiteSpec, Transform
from .extract import ANY_SITE
from .lookup import Dictionary, format_places, tokenize_places

STEP = "struct<kind:string,a:string,b:string,which:int,group:int>"
ENTRY = f"struct<field:string,constant:string,steps:array<{STEP}>,separator:string,required:boolean,plain:boolean>"
# Transforms that already put a value into its final form.
FORMATTING = ("dateFormat", "location_regex", "regex_matcher", "tokenize")
# Stands for the page's address among the constants.
PAGE_URL = "\x01"
#: Programmes are sent to every task up to this size; beyond it Spark joins them by shuffle.
_SENT_BYTES = 8 << 20

TableStep = Callable[[DataFrame, str], DataFrame]


def _steps(t: Transform) -> list[dict]:
    """The steps of one transform; ``join`` has none, it names the separator."""

    def step(kind: str, a: str | None = None, b: str | None = None) -> dict:
        return {"kind": kind, "a": a, "b": b, "which": t.which, "group": t.group}

    if t.how in ("insertBefore", "appendAfter"):
        return [step("affix", *((t.value, "") if t.how == "insertBefore" else ("", t.value)))]
    if t.how == "regex":
        return [step("replace", *text_functions.substitution(t.value))]
    if t.how == "location_regex":
        return [step("replace_trimmed", *text_functions.substitution(t.value)), step("places")]
    if t.how == "regex_matcher":
        return [step("match", text_functions.matching(t.value, t.group)), step("places_or_none")]
    if t.how == "dateFormat":
        return [step("date", *dates.DATE_LAYOUTS.get(t.value, (None, None)))]
    if t.how == "tokenize":
        return [step("tokens")]
    return [step(f"call:{t.value}")] if t.how == "executeScript" else []


def entry(rule: FieldRule) -> dict:
    """One rule as data."""
    constant = rule.how in ("url", "int")
    separators = [t.value or "," for t in rule.transforms if t.how == "join"]
    return {
        "field": rule.field,
        "constant": (PAGE_URL if rule.how == "url" else rule.value or "") if constant else None,
        "steps": [] if constant else [s for t in rule.transforms for s in _steps(t)],
        "separator": (separators or ["<BR/>"])[-1],
        "required": rule.is_fatal,
        "plain": not constant and not any(t.how in FORMATTING for t in rule.transforms),
    }


def programme(rules: tuple[FieldRule, ...]) -> list[dict]:
    """The rules of one site. Of several rules for a field the last gives the value; it is required if any of them says so."""
    entries: dict[str, dict] = {}
    for rule in rules:
        if not rule.field.startswith("comment:"):
            before = entries.get(rule.field)
            entries[rule.field] = entry(rule)
            entries[rule.field]["required"] |= bool(before and before["required"])
    return list(entries.values())


def _literal(entries: list[dict]) -> Column:
    return F.from_json(F.lit(json.dumps(entries)), f"array<{ENTRY}>")


def with_programme(df: DataFrame, specs: list[SiteSpec], level: str) -> tuple[DataFrame, list[dict]]:
    """Add ``__rules``, the programme of each row's site (a site without a spec has that of ``*``), and list all entries."""
    each = {s.site: programme(s.list_rules if level == "list" else s.detail_rules()) for s in specs}
    everything = [e for entries in each.values() for e in entries]
    general = _literal(each.pop(ANY_SITE, []))
    if len(each) < 2:
        own = F.lit(None).cast(f"array<{ENTRY}>")
        for site, entries in each.items():
            own = F.when(df["site"] == site, _literal(entries))
        return df.withColumn("__rules", F.coalesce(own, general)), everything
    rows = [(site, json.dumps(entries)) for site, entries in each.items()]
    table = df.sparkSession.createDataFrame(rows, "__site string, __json string")
    table = table.select("__site", F.from_json("__json", f"array<{ENTRY}>").alias("__own"))
    if sum(len(r[0]) + len(r[1]) for r in rows) <= _SENT_BYTES:
        table = F.broadcast(table)
    joined = df.join(table, df["site"] == table["__site"], "left")
    return joined.withColumn("__rules", F.coalesce("__own", general)).drop("__own", "__site"), everything


def _text_step(value: Column, step: Column, kinds: set[str]) -> Column:
    """One step of one element, by its kind."""
    ways = {
        "affix": lambda: F.concat(step["a"], value, step["b"]),
        "replace": lambda: F.regexp_replace(value, step["a"], step["b"]),
        "replace_trimmed": lambda: F.regexp_replace(F.trim(value), step["a"], step["b"]),
        "match": lambda: text_functions.match_by(value, step["a"], step["which"], step["group"]),
        "date": lambda: dates.index_text(dates.parse_date(F.when(step["a"].isNotNull(), F.regexp_replace(value, step["a"], step["b"])).otherwise(value))),
    }
    chosen = None
    for kind in sorted(kinds & set(ways)):
        chosen = (F if chosen is None else chosen).when(step["kind"] == kind, ways[kind]())
    return value if chosen is None else chosen.otherwise(value)


def worked_out(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is worked out once per row. A filter or a projection above it reads the result: Spark
    puts no copies of the expression there, as it does with a column that is only selected."""
    rest = [c for c in df.columns if c != name]
    return df.select(*rest, F.explode_outer(F.array(value)).alias(name))


def _changed(entries: Column, values: Callable[..., Column]) -> Column:
    return F.transform(entries, lambda e, i: e.withField("values", values(e, i)))


def _has(entry: Column, n: int, kind: str) -> Column:
    return F.coalesce(F.get(entry["steps"], F.lit(n))["kind"] == kind, F.lit(False))


def _table_step(df: DataFrame, n: int, kind: str, step: TableStep) -> DataFrame:
    """Step ``n`` of the entries of one kind: their values are laid end to end, put through ``step`` and cut again."""
    own = lambda e: _has(e, n, kind) & e["values"].isNotNull()
    parts = F.flatten(F.transform(F.filter("__entries", own), lambda e: e["values"]))
    df = step(df.withColumn("__part", F.when(F.exists("__entries", own), parts)), "__part")
    sizes = F.transform("__entries", lambda e: F.when(own(e), F.size(e["values"])).otherwise(0))
    df = df.withColumn("__sizes", sizes)
    before = lambda i: F.aggregate(F.slice("__sizes", 1, i), F.lit(0), lambda a, b: a + b)
    cut = lambda e, i: F.when(own(e), F.slice("__part", before(i) + 1, F.size(e["values"]))).otherwise(e["values"])
    return df.withColumn("__entries", _changed(F.col("__entries"), cut)).drop("__part", "__sizes")


def _table_steps(cities: Dictionary | None, functions: dict, call: Callable) -> Callable[[str], TableStep | None]:
    def of(kind: str) -> TableStep | None:
        if kind.startswith("call:"):
            return lambda df, c: df.withColumn(c, call(functions[kind[5:]])(F.col(c)))
        return {
            "places": lambda df, c: format_places(df, c, cities),
            "places_or_none": lambda df, c: format_places(df, c, cities, empty=""),
            "tokens": lambda df, c: tokenize_places(df, c, cities),
        }.get(kind)

    return of


def _text_pass(entries: Column, everything: list[dict], n: int, tables: list[str]) -> Column:
    """Step ``n`` of all entries, where it is one on texts."""
    kinds = {e["steps"][n]["kind"] for e in everything if len(e["steps"]) > n}.difference(tables)
    text = lambda e, i: F.when(
        F.size(e["steps"]) > n, F.transform(e["values"], lambda v: _text_step(v, e["steps"][n], kinds))
    ).otherwise(e["values"])
    return _changed(entries, text) if kinds else entries


def _longest(everything: list[dict]) -> int:
    return max((len(e["steps"]) for e in everything), default=0)


def run(df: DataFrame, everything: list[dict], cities: Dictionary | None, functions: dict, call: Callable) -> DataFrame:
    """Put the values of ``raw`` (field to elements) through ``__rules`` and add ``__said``, field to its text: elements
    joined, null where an element could not be read. ``everything`` lists all entries that may occur.

    Entries with table steps go first and by themselves: lookups read their values once more and carry them
    through joins, the others are worked out above those.
    """
    table_step = _table_steps(cities, functions, call)
    tables = sorted({s["kind"] for e in everything for s in e["steps"] if table_step(s["kind"])})
    by_table = [e for e in everything if any(s["kind"] in tables for s in e["steps"])]
    rest = [e for e in everything if e not in by_table]
    looked_up = lambda e: F.exists(e["steps"], lambda s: s["kind"].isin(tables))
    first = lambda e: e.withField("values", F.try_element_at("raw", e["field"]))
    read = lambda wanted: F.transform(F.filter("__rules", lambda e: e["constant"].isNull() & wanted(e)), first)
    joined = lambda e: F.when(
        ~F.exists(e["values"], lambda v: v.isNull()), F.call_function("array_join", F.filter(e["values"], lambda v: v != ""), e["separator"])
    )
    said = lambda entries: F.transform(entries, lambda e: F.struct(e["field"].alias("field"), joined(e).alias("text")))

    if by_table:
        df = df.withColumn("__entries", read(looked_up))
        for n in range(_longest(by_table)):
            df = df.withColumn("__entries", _text_pass(F.col("__entries"), by_table, n, tables))
            now = sorted({e["steps"][n]["kind"] for e in by_table if len(e["steps"]) > n}.intersection(tables))
            df = worked_out(df, "__entries", F.col("__entries")) if now else df
            for kind in now:
                df = _table_step(df, n, kind, table_step(kind))
    entries = read((lambda e: ~looked_up(e)) if tables else (lambda e: F.lit(True)))
    for n in range(_longest(rest)):
        entries = _text_pass(entries, rest, n, tables)
    whole = F.concat(said("__entries"), said(entries)) if by_table else said(entries)
    return worked_out(df, "__said", F.map_from_entries(whole)).drop("__entries")


def rule_of(field: str) -> Column:
    """The entry for a field of a row's programme; null without one."""
    return F.get(F.filter("__rules", lambda e: e["field"] == field), F.lit(0))
