"""Alias and display-name dictionaries, one ``name=value`` per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LINE = r"^\s*((?:\\.|[^=:\s\\])+)\s*[=:\s]\s*(.*?)\s*$"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.col("value").alias("line"))


def entries(lines: DataFrame) -> DataFrame:
    line = F.col("line")
    name = F.regexp_replace(F.regexp_extract(line, _LINE, 1), r"\\(.)", "$1")
    pairs = lines.where(~F.regexp_like(line, F.lit(r"^\s*([#!]|$)"))).select(
        name.alias("name"), F.regexp_extract(line, _LINE, 2).alias("value")
    )
    return pairs.where("name != ''")


def city_aliases(lines: DataFrame) -> DataFrame:
    """Alias to canonical name: every listed alias, the name itself, and the name as a city."""
    listed = F.split("value", ",")
    names = F.array(F.col("name"), F.concat("name", F.lit("市")))
    exploded = entries(lines).select(F.explode(F.concat(listed, names)).alias("alias"), F.col("name").alias("canonical"))
    return exploded.select(F.lower(F.trim("alias")).alias("alias"), "canonical").where("alias != ''").distinct()


def company_names(lines: DataFrame) -> DataFrame:
    return entries(lines).select(F.upper("name").alias("key_upper"), F.col("value").alias("display_name"))
