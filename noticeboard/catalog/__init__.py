"""One query per operator over the given tables, each with the SQL it must equal.

How the tables meet the operators: site = host of a page or user of an event; listing rows =
events; list and detail = documents and labels; index = orders; dates = order dates rendered
as text and read back; dirty text = documents; dictionaries = nations, customers and parts.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

AS_OF = datetime(2024, 1, 31, 10, 20, 30)
AS_OF_SQL = "TIMESTAMP '2024-01-31 10:20:30'"
ORDERS_AS_OF = datetime(2001, 9, 1, 10, 20, 30)
ORDERS_AS_OF_SQL = "TIMESTAMP '2001-09-01 10:20:30'"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def listing(spark: SparkSession, sf: str) -> DataFrame:
    """Events as rows of paged listings: 100 events are a page, a user is a site."""
    key = F.col("event_id")
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("site"),
        F.col("event_type").alias("category"),
        (F.floor(key / 100)).cast("int").alias("page_no"),
        (key % 100).cast("int").alias("item_pos"),
        key.alias("event_id"),
        (F.lit(AS_OF.isoformat(sep=" ")).cast("timestamp_ntz") - F.make_dt_interval(days=F.floor("value").cast("int"))).alias("job_post_date"),
        F.col("ts").alias("finished_at"),
    )


LISTING_SQL = f"""listing AS (
  SELECT CAST(user_id AS VARCHAR) AS site, event_type AS category,
         CAST(event_id // 100 AS INTEGER) AS page_no, CAST(event_id % 100 AS INTEGER) AS item_pos, event_id,
         {AS_OF_SQL} - to_days(CAST(floor(value) AS INTEGER)) AS job_post_date, ts AS finished_at
  FROM events)"""


def orders_index(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as the posting index."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_custkey").cast("string").alias("job_company"),
        F.col("o_orderpriority").alias("job_title"),
        F.col("o_orderdate").alias("job_post_date"),
        (F.col("o_orderdate") + F.make_dt_interval(days=F.floor(F.col("o_totalprice") / 500).cast("int"))).alias("job_expire_date"),
        (F.col("o_orderstatus") == "F").alias("job_expired"),
    )


ORDERS_INDEX_SQL = """idx AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS job_company, o_orderpriority AS job_title,
         o_orderdate AS job_post_date, o_orderdate + to_days(CAST(floor(o_totalprice / 500) AS INTEGER)) AS job_expire_date,
         o_orderstatus = 'F' AS job_expired
  FROM orders)"""


def load() -> None:
    from . import cleaning, extraction, indexing, jobs, limiting, sourcing, verifying  # noqa: F401
