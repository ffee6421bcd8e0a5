"""The daily routine: plan, collect, index and report, then recheck what is old."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates
from ..model import POSTING_FIELDS, Limits, SiteSpec, site_config
from ..operators import index
from ..operators.extract import ANY_SITE
from ..operators.limits import effective_limits
from ..operators.lookup import Dictionary
from ..session import written
from ..sources.table import PostingTable
from . import schedule
from .collect import collect_postings
from .recheck import alive_urls, recheck_postings

_ORDER = ["outer_no", "page_no", "item_pos"]
SCHEMA = ", ".join(f"{name} {kind}" for name, kind in POSTING_FIELDS.items()) + ", site string, " + ", ".join(
    f"{name} int" for name in _ORDER
)


def posting_table(spark: SparkSession, root: str, buckets: int = 256) -> PostingTable:
    """The table of postings: of several rows of a batch with one id the last listed counts."""
    return PostingTable(spark, root, SCHEMA, _ORDER, buckets)


def collect_and_index(table: PostingTable, no: int, pages: DataFrame, specs: list[SiteSpec], as_of: datetime, **settings) -> DataFrame:
    """Collect postings into the table as batch ``no``; gives the rows written."""
    postings = collect_postings(pages, specs, as_of, index_ids=table.current().select("id"), **settings)
    table.append(postings.select(*table.columns()), no)
    table.compact()
    return table.batch(no)


def run_day(
    table: PostingTable,
    no: int,
    pages: DataFrame,
    specs: list[SiteSpec],
    seeds: DataFrame,
    runs: str,
    as_of: datetime,
    cities: Dictionary,
    companies: Dictionary,
    ended: DataFrame | None = None,
    export: tuple[str, dict[str, str], dict[str, str]] | None = None,
    defaults: Limits = Limits(),
    **settings,
) -> DataFrame:
    """Run the sites that are due, go on with those that broke off, and report; gives the report.

    ``seeds`` are the sites to know (``sources.seeds``), ``runs`` the folder of the table of runs. ``ended``
    says of sites whether their run came to its end (site, complete); without it all have.
    ``export`` names a folder, the fields to rename and those to copy: the rows written go there too.
    """
    spark = table.spark
    known = written(schedule.with_last_run(seeds, schedule.read_runs(spark, runs)), "known-seeds")
    broken = known.where(F.col("last_time").isNotNull() & ~F.col("complete") & F.col("position").isNotNull())
    due = known.join(broken.select("site"), "site", "left_anti").select("site", "last_time")
    windows = effective_limits(site_config(spark, specs), defaults)
    todo = schedule.specs_to_run(specs, schedule.regular_plan(due, windows, as_of))
    place = F.split("position", r"\.")
    stopped = schedule.resume_plan(broken.select("site", "complete", place[0].cast("int").alias("page_no"), place[1].cast("int").alias("item_pos"), "total"))
    named = {s.site: s for s in specs}
    again = [named[r.site] for r in stopped.where(F.col("site").isin(*named)).select("site").collect()]  # at most one row per spec

    running = spark.createDataFrame([(s.site,) for s in [*todo, *again]], "site string")
    rows = collect_postings(pages, [*todo, *again], as_of, cities, companies, index_ids=table.current().select("id"), defaults=defaults, **settings)
    fresh = rows.join(stopped.select("site"), "site", "left_anti")
    rows = written(fresh.unionByName(schedule.rows_to_resume(rows, stopped)), "day")
    table.append(rows.select(*table.columns()), no)
    table.compact()
    if export is not None:
        folder, rename, copy = export
        index.map_fields(rows.select(*POSTING_FIELDS), rename, copy).write.mode("overwrite").parquet(f"{folder.rstrip('/')}/no={no}")

    before = stopped.select("site", F.col("total").alias("total_before"))
    states = running.join(before, "site", "left").withColumn("total_before", F.coalesce("total_before", F.lit(0)).cast("bigint"))
    if ended is None:
        states = states.withColumn("complete", F.lit(True))
    else:
        states = states.join(ended.select("site", "complete"), "site", "left").withColumn("complete", F.coalesce("complete", F.lit(True)))
    now = dates.ntz(as_of)
    report = index.run_report(rows.withColumn("finished_at", now), states).withColumn("finished_at", now)
    report = written(report, "report")
    schedule.append_runs(report, runs)
    return report


def recheck_and_index(
    table: PostingTable,
    no: int,
    snapshots: list[DataFrame],
    specs: list[SiteSpec],
    as_of: datetime,
    cities: Dictionary,
    n_days: int = 15,
    accept_uncertain: bool = False,
    wanted: DataFrame | None = None,
) -> DataFrame:
    """Recheck old postings against page snapshots (the first look, then one per recheck round)
    and write the expired ones as batch ``no``; gives ``id`` and ``outcome``.

    ``wanted`` names the companies (display_name) to look at; without it all are.

    Postings of a site without detail rules cannot be looked at on their own and are skipped.
    """
    specs = [s for s in specs if s.detail_groups and s.site != ANY_SITE]
    config = site_config(table.spark, specs).select("site", "verify_single")
    alive = [alive_urls(pages, specs, cities, as_of) for pages in snapshots]
    current = table.current()
    outcome = written(recheck_postings(current, config, alive, as_of, n_days, accept_uncertain, key="site", wanted=wanted), "outcome")
    confirmed = current.join(outcome.where("outcome = 'confirmed'").select("id"), "id", "left_semi")
    table.append(confirmed.withColumn("job_expired", F.lit(True)).select(*table.columns()), no)
    table.compact()
    return outcome
