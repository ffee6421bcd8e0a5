"""Rechecking old postings: expiry by date, by page, and the guard against mass expiry."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..session import cut_lineage
from .skew import join_facts


def route(candidates: DataFrame, sites: DataFrame, key: str = "job_company") -> tuple[DataFrame, DataFrame]:
    """Candidates with their site's spec, and those of companies without one (skipped).

    ``sites`` has the key and verify_single, one row per key: the company, or the site where
    postings name it, since several sites may lack a display name.
    """
    known = join_facts(candidates, sites, [key])
    return known, join_facts(candidates, sites, [key], "left_anti")


def with_batch(df: DataFrame, key: str = "job_company") -> DataFrame:
    """One batch per company; postings of a ``verify_single`` site are batches of one."""
    return df.withColumn("batch_key", F.when(F.col("verify_single"), F.col("id")).otherwise(F.col(key)))


def expired_by_date(expire_date: Column, as_of: datetime) -> Column:
    return dates.outdated(expire_date, dates.ntz(as_of), 0)


def with_expiry(candidates: DataFrame, alive_urls: DataFrame, as_of: datetime) -> DataFrame:
    """``expired_date`` by the expiry date, ``expired_page`` when the address has no page that
    still gives the required fields, ``expired`` by either.

    ``alive_urls`` holds the addresses of such pages.
    """
    alive = alive_urls.select(F.col("url").alias("job_url"), F.lit(True).alias("alive")).distinct()
    by_date = expired_by_date(F.col("job_expire_date"), as_of)
    by_page = ~by_date & F.col("alive").isNull()
    return join_facts(candidates, alive, ["job_url"], "left").select(
        *candidates.columns,
        by_date.alias("expired_date"),
        by_page.alias("expired_page"),
        (by_date | by_page).alias("expired"),
    )


def batch_facts(checked: DataFrame) -> DataFrame:
    return checked.groupBy("batch_key").agg(
        F.bool_and("expired").alias("all_expired"),
        F.bool_or("verify_single").alias("single"),
        F.count("*").alias("n"),
        F.count_if("expired_date").alias("n_by_date"),
    )


def guard(checked: DataFrame) -> DataFrame:
    """``outcome`` of every row: alive, confirmed or held.

    Where every row of a batch expired, a broken rule or network is more likely than mass
    expiry: rows not expired by date are held for a recheck, unless the batch is a single one.
    """
    facts = batch_facts(checked).where("all_expired and not single").select("batch_key", F.lit(True).alias("suspicious"))
    held = F.col("suspicious").isNotNull() & ~F.col("expired_date")
    outcome = F.when(~F.col("expired"), "alive").when(held, "held").otherwise("confirmed")
    return join_facts(checked, facts, ["batch_key"], "left").withColumn("outcome", outcome).drop("suspicious")


def next_offset(checked: DataFrame, start: int, rows: int) -> DataFrame:
    """Offset of the next window: start plus rows, less the date-expired rows of suspicious
    batches, which leave the candidate set."""
    facts = batch_facts(checked).where("all_expired and not single")
    left = F.coalesce(F.sum("n_by_date"), F.lit(0))
    return facts.agg(left.alias("corrected"), (F.lit(start + rows) - left).alias("next_start"))


AliveUrls = Callable[[DataFrame], DataFrame]


def recheck(held: DataFrame, alive_by_round: list[DataFrame | AliveUrls], as_of: datetime, accept_uncertain: bool) -> DataFrame:
    """Recheck held rows against newer pages, one round per entry of ``alive_by_round``: the
    addresses still alive, or a function that finds them among those of the rows it is given.

    Flags are reset before each round. What is still held after the last round is accepted as
    expired or reported as an alarm. Each round cuts its lineage, so a round reads the rows
    still held and not all the rounds before it, and looks at their pages only.
    """
    columns = [c for c in held.columns if c not in ("expired_date", "expired_page", "expired", "outcome")]
    done = []
    for alive in alive_by_round:
        held = held.select(*columns)
        checked = cut_lineage(guard(with_expiry(held, alive(held) if callable(alive) else alive, as_of)))
        done.append(checked.where("outcome != 'held'").select("id", "outcome"))
        held = checked.where("outcome = 'held'")
    last = held.select("id", F.lit("confirmed" if accept_uncertain else "alarm").alias("outcome"))
    for part in done:
        last = last.unionByName(part)
    return last
