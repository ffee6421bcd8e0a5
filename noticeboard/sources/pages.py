"""Page snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids


def with_site(pages: DataFrame) -> DataFrame:
    """``pages`` with its site, the host of the address."""
    return pages.withColumn("site", ids.host(F.col("url")))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages with their site, ready for extraction."""
    return with_site(spark.read.parquet(path))
