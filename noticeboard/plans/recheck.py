"""Rechecking old, still open postings against newer pages."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import SiteSpec
from ..operators import clean, index, verify
from ..operators.extract import extract
from ..operators.lookup import Dictionary
from ..operators.sieve import sifted
from ..session import cut_lineage


def alive_urls(pages: DataFrame, specs: list[SiteSpec], cities: Dictionary | None, as_of: datetime) -> verify.AliveUrls:
    """Finds, among the addresses of given rows (``job_url``), those whose newest page still gives
    every required detail field. An old post date does not matter here.

    Pages of other addresses are sieved out where they are read, before any is parsed, and no
    page is moved. The few that pass the sieve by chance are the addresses of no candidate.
    """

    def among(candidates: DataFrame) -> DataFrame:
        asked = sifted(pages, "url", candidates, "job_url")
        return clean.with_fields(extract(asked, specs, "detail"), specs, "detail", cities, as_of).select("url")

    return among


def recheck_postings(
    postings: DataFrame,
    sites: DataFrame,
    alive_by_round: list[DataFrame | verify.AliveUrls],
    as_of: datetime,
    n_days: int = 15,
    accept_uncertain: bool = False,
    key: str = "job_company",
    wanted: DataFrame | None = None,
) -> DataFrame:
    """``id`` and ``outcome`` (alive, confirmed, alarm or skipped) of every candidate.

    The first entry of ``alive_by_round`` is the check itself, the others its recheck rounds.
    """
    candidates = index.open_older_than(postings, as_of, n_days)
    if wanted is not None:
        candidates = index.of_companies(candidates, wanted)
    routed, unknown = verify.route(candidates, sites, key)
    first, *later = alive_by_round
    batches = verify.with_batch(routed, key)
    if callable(first):
        batches = cut_lineage(batches)  # read twice: for the addresses, and for the check
        # An expiry date decides without a look at the page.
        first = first(batches.where(~verify.expired_by_date(F.col("job_expire_date"), as_of)))
    checked = cut_lineage(verify.guard(verify.with_expiry(batches, first, as_of)))
    settled = checked.where("outcome != 'held'").select("id", "outcome")
    again = verify.recheck(checked.where("outcome = 'held'"), later, as_of, accept_uncertain)
    skipped = unknown.select("id", F.lit("skipped").alias("outcome"))
    return settled.unionByName(again).unionByName(skipped)


def apply_outcome(postings: DataFrame, outcome: DataFrame) -> DataFrame:
    """Only confirmed expiries are written back."""
    return index.mark_expired(postings, outcome.where("outcome = 'confirmed'"))
