"""The posting index: writes, partial updates, lookups."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates
from ..model import UNKNOWN_COMPANY
from .skew import join_facts


def last_per_id(batch: DataFrame, *order: str) -> DataFrame:
    """The last row of every id. The rank limit runs in every task before the shuffle, so an id
    with very many copies costs one row per task."""
    newest = Window.partitionBy("id").orderBy(*(F.col(c).desc() for c in order))
    return batch.withColumn("__nth", F.row_number().over(newest)).where("__nth = 1").drop("__nth")


def upsert(index: DataFrame, batch: DataFrame, *order: str) -> DataFrame:
    """Index rows whose id is not in the batch, and the last row of every id of the batch.

    The index holds each id once, so it needs no grouping: it is only checked against the ids
    of the batch, and stays unshuffled while those are small.
    """
    last = last_per_id(batch, *order)
    kept = index.join(batch.select("id").distinct(), "id", "left_anti")
    return kept.unionByName(last.select(*index.columns))


def mark_expired(index: DataFrame, expired_ids: DataFrame) -> DataFrame:
    """Set the expired flag for the given ids and nothing else; ids not in the index are ignored."""
    hits = expired_ids.select("id").distinct().withColumn("__hit", F.lit(True))
    flag = F.when(F.col("__hit"), F.lit(True)).otherwise(F.col("job_expired"))
    return index.join(hits, "id", "left").withColumn("job_expired", flag).select(*index.columns)


def delete_ids(index: DataFrame, ids: DataFrame, allow_delete: bool = False) -> DataFrame:
    return index.join(ids.select("id").distinct(), "id", "left_anti") if allow_delete else index


def map_fields(df: DataFrame, rename: dict[str, str], copy: dict[str, str]) -> DataFrame:
    """Rename fields and copy fields on write; a copy onto itself is skipped."""
    renamed = [F.col(c).alias(rename.get(c, c)) for c in df.columns]
    copied = [F.col(s).alias(d) for s, d in copy.items() if s != d]
    return df.select(*renamed, *copied)


def route_writes(index: DataFrame, batch: DataFrame, *order: str) -> DataFrame:
    """One write of a mixed batch: open rows are upserted, expired rows only set the flag.

    Whichever came last for an id decides whether it ends up expired. The batch is read once and
    reduced to a row per id before it meets the index, in one join.
    """
    columns = index.columns
    expired = F.coalesce(F.col("job_expired"), F.lit(False))
    place = F.struct(*order)
    row = F.struct(*(F.col(c).alias(c) for c in columns))
    events = batch.groupBy("id").agg(
        F.max_by(row, F.when(~expired, place)).alias("__open"),
        F.max(F.struct(*order, expired.alias("flag"))).alias("__last"),
    )
    # Expired rows have no place among the open ones, so an id with none of those has no open row.
    events = events.select(F.col("id").alias("__id"), "__open", F.col("__last.flag").alias("__flag"))
    joined = index.join(events, F.col("id") == F.col("__id"), "full_outer").where(F.col("id").isNotNull() | F.col("__open").isNotNull())
    chosen = {c: F.when(F.col("__open").isNotNull(), F.col(f"__open.{c}")).otherwise(F.col(c)) for c in columns}
    chosen["job_expired"] = F.when(F.col("__flag"), F.lit(True)).otherwise(chosen["job_expired"])
    return joined.select(*(chosen[c].alias(c) for c in columns))


def append_batches(batches: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


def run_report(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """Per site: complete, last position, rows of this run, running total.

    ``runs`` has site, complete and total_before, one row per site.
    """
    counted = rows.groupBy("site").agg(
        F.count("*").alias("n"),
        F.max(F.struct("page_no", "item_pos")).alias("last"),
        F.max("finished_at").alias("finished_at"),
    )
    position = F.concat_ws(".", F.col("last.page_no"), F.col("last.item_pos"))
    joined = runs.join(counted, "site", "left")
    n = F.coalesce("n", F.lit(0)).cast("bigint")
    return joined.select(
        "site", "finished_at", "complete", position.alias("position"), (F.col("total_before") + n).alias("total"), n.alias("n")
    )


def by_id(index: DataFrame, posting_id: str) -> DataFrame:
    return index.where(F.col("id") == posting_id)


def open_older_than(index: DataFrame, as_of: datetime, n_days: int) -> DataFrame:
    """Open postings whose post date is at least n days before the current hour."""
    until = dates.ntz(dates.on_the_hour(as_of) - timedelta(days=n_days))
    columns = ["id", "job_url", "job_company", "job_post_date", "job_expire_date"]
    columns += ["site"] if "site" in index.columns else []
    return index.where(~F.col("job_expired") & (F.col("job_post_date") <= until)).select(*columns)


def window_by_offset(candidates: DataFrame, start: int, rows: int) -> DataFrame:
    return candidates.orderBy("job_post_date", "id").offset(start).limit(rows)


def window_after(candidates: DataFrame, after: tuple[datetime, str] | None, rows: int) -> DataFrame:
    """The next window in (post date, id) order: reads on from a key instead of counting rows off."""
    if after is not None:
        date, key = dates.ntz(after[0]), after[1]
        later = (F.col("job_post_date") > date) | ((F.col("job_post_date") == date) & (F.col("id") > key))
        candidates = candidates.where(later)
    return candidates.orderBy("job_post_date", "id").limit(rows)


def of_companies(candidates: DataFrame, wanted: DataFrame) -> DataFrame:
    """Only the wanted display names; names without one are ignored, and none valid means all.

    ``wanted`` has display_name.
    """
    valid = wanted.where(F.col("display_name") != UNKNOWN_COMPANY).select(F.col("display_name").alias("job_company")).distinct()
    if valid.isEmpty():
        return candidates
    return join_facts(candidates, valid, ["job_company"], "left_semi")


