"""Which sites to run, from the seed list and how their last runs ended."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates
from ..model import SiteSpec
from ..operators.skew import join_facts


def last_status(runs: DataFrame) -> DataFrame:
    """The newest run of every site; reduced in every task before the shuffle."""
    rest = [c for c in runs.columns if c not in ("site", "finished_at")]
    newest = runs.groupBy("site").agg(F.max(F.struct("finished_at", *rest)).alias("s"))
    return newest.select("site", "s.*")


def regular_plan(seeds: DataFrame, limits: DataFrame, as_of: datetime) -> DataFrame:
    """A site never run is run with its own window; one last run longer ago than its window is
    run with a window reaching back to that time; any other carries its status forward."""
    now = dates.ntz(as_of)
    last = dates.parse_date(F.col("last_time"))
    late = dates.outdated(last, now, F.col("n_days"))
    action = F.when(F.col("last_time").isNull() | late, "run").otherwise("carry")
    window = F.when(late, dates.days_delta(last, now)).otherwise(F.col("n_days"))
    joined = seeds.join(limits.select("site", "n_days"), "site")
    return joined.select(
        "site", action.alias("action"), F.when(action == "run", window).alias("n_days"), late.alias("adjusted")
    )


def specs_to_run(specs: list[SiteSpec], plan: DataFrame) -> list[SiteSpec]:
    """The specs a plan runs; one that reaches back to its last run gets that window as its own,
    and with it wide page and posting limits. At most one row per spec is fetched."""
    named = {s.site: s for s in specs}
    rows = plan.where((F.col("action") == "run") & F.col("site").isin(*named)).collect()
    return [replace(named[r.site], n_days=r.n_days) if r.adjusted else named[r.site] for r in rows]


RUNS = "site string, finished_at timestamp_ntz, complete boolean, position string, total bigint, n bigint"


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The table of runs; none yet is an empty one."""
    try:
        return spark.read.schema(RUNS).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RUNS)


def with_last_run(seeds: DataFrame, runs: DataFrame) -> DataFrame:
    """Seeds with how their last run ended, by the table of runs before the seed list."""
    last = last_status(runs).select("site", "finished_at", "complete", F.col("position").alias("run_position"), F.col("total").alias("run_total"))
    ran = F.col("finished_at").isNotNull()
    return seeds.join(last, "site", "left").select(
        "site",
        F.when(ran, dates.iso_text(F.col("finished_at"))).otherwise(F.col("last_time")).alias("last_time"),
        F.when(ran, F.col("complete")).otherwise(F.col("last_complete")).alias("complete"),
        F.when(ran, F.col("run_position")).otherwise(F.col("position")).alias("position"),
        F.when(ran, F.col("run_total")).otherwise(F.col("total")).cast("bigint").alias("total"),
    )


def append_runs(report: DataFrame, path: str) -> None:
    """Add a run's report to the table of runs, which ``last_status`` reads."""
    report.write.mode("append").parquet(path)


def resume_plan(status: DataFrame) -> DataFrame:
    """Complete sites carry their status forward, partial ones go on from where they stopped."""
    partial = ~F.col("complete")
    return status.select(
        "site",
        F.when(partial, "run").otherwise("carry").alias("action"),
        F.when(partial, F.col("page_no")).alias("from_page"),
        F.when(partial, F.col("item_pos")).alias("from_pos"),
        F.when(partial, F.col("total")).alias("total"),
    )


def rows_to_resume(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows behind the saved position of the sites that are run again."""
    todo = plan.where("action = 'run'").select("site", "from_page", "from_pos")
    behind = (F.col("page_no") > F.col("from_page")) | (
        (F.col("page_no") == F.col("from_page")) & (F.col("item_pos") > F.col("from_pos"))
    )
    return join_facts(rows, todo, ["site"]).where(behind).drop("from_page", "from_pos")
