"""Dictionary lookups: company display names, canonical place names.

Lookups are joins over the distinct values, with the size check left to Spark's own broadcast
threshold and AQE.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as text_functions
from ..model import OTHER_PLACE, UNKNOWN_COMPANY
from .skew import join_facts


class Dictionary:
    """Unique keys to values."""

    def __init__(self, frame: DataFrame, key: str, value: str):
        self.frame = (
            frame.select(F.col(key).alias("key"), F.col(value).alias("value"))
            .where("key is not null")
            .groupBy("key")
            .agg(F.min("value").alias("value"))
        )


def with_display_name(df: DataFrame, company: str, names: Dictionary, out: str) -> DataFrame:
    """Display name by upper-cased company; ``unknown`` when it is not listed."""
    listed = names.frame.select(F.col("key").alias("__key"), F.col("value").alias(out))
    joined = join_facts(df.withColumn("__key", F.upper(F.col(company))), listed, ["__key"], "left").drop("__key")
    return joined.withColumn(out, F.coalesce(F.col(out), F.lit(UNKNOWN_COMPANY)))


def _format_tokens(place: Column) -> Column:
    """Tokens of a comma list, without the city suffix and apostrophes."""
    return F.split(F.translate(place, "市'", ""), ",")


def _split_tokens(place: Column) -> Column:
    """Tokens of free text: split on tags and slashes first, then on the word 'or', brackets,
    semicolons, dashes and commas."""
    return F.split(F.regexp_replace(place, r"<BR/>|\s*/\s*", ","), r"\s+or\s+|[();,-]")


def _normal(token: Column) -> Column:
    return F.lower(F.trim(token))


def map_places(
    df: DataFrame,
    column: str,
    cities: Dictionary,
    tokens: Callable[[Column], Column],
    distinct: bool = False,
    empty: str = OTHER_PLACE,
) -> DataFrame:
    """Replace each text of an array column by the canonical names of its known places."""

    def finish(text: Column, names: Column) -> Column:
        names = F.array_sort(F.array_distinct(names)) if distinct else names
        known = F.when(F.size(names) > 0, F.array_join(names, ","))
        return known.when(text == "", empty).when(text.isNotNull(), OTHER_PLACE)

    # Each distinct array is mapped once, however often it occurs.
    arrays = df.select(F.col(column).alias("__texts")).where("__texts is not null").distinct()
    texts = arrays.select("__texts", F.posexplode("__texts").alias("__at", "__text"))
    exploded = texts.select("*", F.posexplode_outer(tokens(F.col("__text"))).alias("__pos", "__token"))
    keyed = exploded.withColumn("key", _normal(F.col("__token")))
    known = join_facts(keyed, cities.frame, ["key"], "left")
    names = F.transform(
        F.array_sort(F.collect_list(F.when(F.col("value").isNotNull(), F.struct("__pos", "value")))),
        lambda hit: hit["value"],
    )
    per_text = known.groupBy("__texts", "__at").agg(names.alias("names"), F.first("__text").alias("__text"))
    place = finish(F.col("__text"), F.col("names"))
    per_array = per_text.groupBy("__texts").agg(F.array_sort(F.collect_list(F.struct("__at", place.alias("p")))).alias("ps"))
    named = per_array.select("__texts", F.transform("ps", lambda x: x["p"]).alias("__places"))
    joined = join_facts(df.withColumn("__texts", F.col(column)), named, ["__texts"], "left")
    # An empty array has no rows to map and stays empty.
    return joined.withColumn(column, F.coalesce("__places", column)).drop("__texts", "__places")


def format_places(df: DataFrame, column: str, cities: Dictionary, empty: str = OTHER_PLACE) -> DataFrame:
    """Canonical names of comma lists, in order; unknown names are dropped, none known is 其他."""
    return map_places(df, column, cities, _format_tokens, empty=empty)


def tokenize_places(df: DataFrame, column: str, cities: Dictionary) -> DataFrame:
    """Distinct known cities in free text, sorted; none known is 其他."""
    return map_places(df, column, cities, _split_tokens, distinct=True)


def _of_text(df: DataFrame, text: Column, out: str, step: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    mapped = step(df.withColumn("__place", F.array(text)), "__place")
    return mapped.withColumn(out, F.col("__place")[0]).drop("__place")


def with_city_format(df: DataFrame, column: str, cities: Dictionary, out: str, spec: str | None = None) -> DataFrame:
    text = F.trim(F.col(column))
    text = text_functions.regex_sub(text, spec) if spec else text
    return _of_text(df, text, out, lambda d, c: format_places(d, c, cities))


def with_city_tokens(df: DataFrame, column: str, cities: Dictionary, out: str) -> DataFrame:
    return _of_text(df, F.col(column), out, lambda d, c: tokenize_places(d, c, cities))
