"""Seed list: one site per line, optionally with how its last run ended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def seeds(lines: DataFrame) -> DataFrame:
    """site, last_time (text), last_complete, position, total; blank and ``#`` lines skipped.

    A site listed twice is one seed: the entry with the latest time counts.
    """
    words = F.split(F.trim("line"), r"\s+")

    def word(n: int):
        return F.try_element_at(words, F.lit(n))

    complete = F.coalesce(word(3).try_cast("boolean"), F.lit(False))
    parsed = lines.where((F.trim("line") != "") & ~F.startswith("line", F.lit("#"))).select(
        word(1).alias("site"),
        word(2).alias("last_time"),
        complete.alias("last_complete"),
        F.when(~complete, word(4)).alias("position"),
        F.when(~complete, F.coalesce(word(5).try_cast("int"), F.lit(0))).alias("total"),
    )
    rest = ["last_time", "last_complete", "position", "total"]
    return parsed.groupBy("site").agg(F.max(F.struct(*rest)).alias("s")).select("site", *(f"s.{c}" for c in rest))


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    return seeds(spark.read.text(path).select(F.col("value").alias("line")))
