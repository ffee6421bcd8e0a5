"""Joins with facts about a key, where one key may hold a third of all rows.

AQE splits the partition of a hot key only where both sides of the join are shuffled for that
join. Facts that come from an aggregate by the key are not: they are partitioned already. So the
join is on one more column, a hash of the keys, and the facts get a shuffle of their own. Facts
small enough are broadcast by Spark's own size check instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _deal(columns: list[str]) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(16)).cast("int")


def join_facts(rows: DataFrame, facts: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join facts about the keys of rows; hot keys are left to AQE."""
    own = facts.withColumn("__deal", _deal(keys))
    return rows.withColumn("__deal", _deal(keys)).join(own, [*keys, "__deal"], how).drop("__deal")


join_many_facts = join_facts
