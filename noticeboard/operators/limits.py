"""Freshness and paging limits.

Sites are very uneven, so nothing here gathers a whole site in one task: per-site facts are
aggregates (reduced before the shuffle) joined back in parts, and positions within a site are
counted in bounded blocks. Joins carry no broadcast hint; Spark's size check and AQE decide.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates
from ..model import JOBS_WITH_WINDOW, PAGES_WITH_WINDOW, Limits
from .skew import join_facts

BLOCK = 1024
POSITION = ["page_no", "item_pos"]


def effective_limits(config: DataFrame, defaults: Limits) -> DataFrame:
    """A site with its own day window gets wide page and posting limits; otherwise its own
    limits come before the global ones."""
    own_window = F.col("n_days").isNotNull()
    return config.select(
        "site",
        F.coalesce("n_days", F.lit(defaults.n_days)).alias("n_days"),
        F.when(own_window, PAGES_WITH_WINDOW).otherwise(F.coalesce("n_pages", F.lit(defaults.n_pages))).alias("n_pages"),
        F.when(own_window, JOBS_WITH_WINDOW).otherwise(F.coalesce("n_jobs", F.lit(defaults.n_jobs))).alias("n_jobs"),
        F.lit(defaults.n_jobs_per_page).alias("n_jobs_per_page"),
    )


def fresh(df: DataFrame, date: str, as_of: Column, n_days: Column | int | None) -> DataFrame:
    """Rows not more than n whole days old; no limit for ``None`` alone. A fixed window of n days
    becomes a comparison that the scan can be given."""
    if isinstance(n_days, int) and n_days >= 0:
        return df.where(dates.not_outdated(F.col(date), as_of, n_days))
    return df.where(~dates.outdated(F.col(date), as_of, n_days))


def mark_known(df: DataFrame, index_ids: DataFrame) -> DataFrame:
    """``known``: the id is in the index already."""
    return df.join(index_ids.select("id").distinct().withColumn("known", F.lit(True)), "id", "left").withColumn(
        "known", F.coalesce("known", F.lit(False))
    )


def paging_stop(df: DataFrame, keys: list[str], hit: Column) -> DataFrame:
    """Pages up to and including the first one with a hit (an outdated or known row).

    ``keys`` is the site, or site and category where the outer loop goes on after a stop.
    """
    stops = df.where(hit).groupBy(*keys).agg(F.min("page_no").alias("stop_page"))
    reached = F.col("stop_page").isNull() | (F.col("page_no") <= F.col("stop_page"))
    return join_facts(df, stops, keys, "left").where(reached).drop("stop_page")


def pages_cap(df: DataFrame, n_pages: Column | int, begin_from: Column | int = 0) -> DataFrame:
    return df.where(F.col("page_no") - begin_from + 1 <= n_pages)


def page_cap(
    df: DataFrame, keys: list[str], n: Column | int, begin_from: Column | int = 0, accepted: Column | None = None
) -> DataFrame:
    """Rows of a page up to and including the first accepted one (all are, by default) at the
    page's n-th position: what lies behind is never looked at."""
    at_cap = F.col("item_pos") - begin_from + 1 >= n
    at_cap = at_cap if accepted is None else at_cap & accepted
    lasts = df.where(at_cap).groupBy(*keys, "page_no").agg(F.min("item_pos").alias("last_pos"))
    within = F.col("last_pos").isNull() | (F.col("item_pos") <= F.col("last_pos"))
    return join_facts(df, lasts, [*keys, "page_no"], "left").where(within).drop("last_pos")


def with_running_rank(
    df: DataFrame, keys: list[str], name: str, outer: list[str] | None = None, limit: Column | int | None = None, tie: list[str] | None = None
) -> DataFrame:
    """Position of each row within its keys by (outer, page_no, item_pos, tie), counted from 1.

    The rows of a page's block of items are a cell. Cells are counted once, and each cell's start
    comes from sums over the cells before it: within its page block, and of whole page blocks. So the only rows
    ranked in one task are those of one cell, or the cells of one page block, however large a
    site is. With a ``limit`` the cells wholly behind it are dropped before they are ranked.
    A missing key, page or position counts as a value of its own, which comes first.
    """
    outer = outer or []
    cell = ["__key", *outer, "__pages", "page_no", "__items"]
    df = df.withColumns(
        {
            "__key": F.struct(*keys),
            "__pages": F.coalesce(F.floor(F.col("page_no") / BLOCK), F.lit(-1)),
            "__items": F.coalesce(F.floor(F.col("item_pos") / BLOCK), F.lit(-1)),
        }
    )
    cells = df.groupBy(*cell).agg(F.count("*").alias("__n"))
    inside = Window.partitionBy("__key", *outer, "__pages").orderBy("page_no", "__items").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("__inside", F.coalesce(F.sum("__n").over(inside), F.lit(0)))
    blocks = cells.groupBy("__key", *outer, "__pages").agg(F.sum("__n").alias("__total"))
    ahead = Window.partitionBy("__key").orderBy(*outer, "__pages").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("__ahead", F.coalesce(F.sum("__total").over(ahead), F.lit(0))).drop("__total")
    starts = _null_safe_join(cells, blocks, ["__key", *outer, "__pages"])
    starts = starts.select(*cell, (F.col("__inside") + F.col("__ahead")).alias("__start"))
    here = Window.partitionBy(*cell).orderBy("item_pos", *(tie or []))
    if limit is None:
        # Ranked first: the join then finds the rows partitioned and sorted as it needs them.
        ranked = _null_safe_join(df.withColumn("__nth", F.row_number().over(here)), starts, cell)
    else:
        placed = _null_safe_join(df, starts, cell).where(F.col("__start") < limit)
        ranked = placed.withColumn("__nth", F.row_number().over(here))
    position = F.col("__start") + F.col("__nth")
    return ranked.withColumn(name, position).drop("__key", "__pages", "__items", "__start", "__nth")


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Join on keys of which null is a value like any other."""
    renamed = right.select(*(F.col(c).alias(f"__right_{c}") if c in keys else F.col(c) for c in right.columns))
    same = reduce(lambda a, b: a & b, (left[c].eqNullSafe(renamed[f"__right_{c}"]) for c in keys))
    return left.join(renamed, same).drop(*(f"__right_{c}" for c in keys))


def site_cap(
    df: DataFrame, keys: list[str], n_jobs: Column | int, outer: list[str] | None = None, tie: list[str] | None = None
) -> DataFrame:
    """The first n accepted rows of a site by page, position and ``tie``."""
    ranked = with_running_rank(df, keys, "__rank", outer, n_jobs, tie)
    return ranked.where(F.col("__rank") <= n_jobs).drop("__rank")


def new_positions(df: DataFrame, keys: list[str]) -> DataFrame:
    """Growing lists repeat earlier rows on every page: each position counts on the first page
    that shows it. The rank limit is applied in every task before the shuffle."""
    first = Window.partitionBy(*keys, "item_pos").orderBy("page_no")
    return df.withColumn("__nth", F.row_number().over(first)).where("__nth = 1").drop("__nth")


def within_page_bounds(df: DataFrame, keys: list[str], bounds: DataFrame) -> DataFrame:
    """Rows whose page lies in the bounds its listing states; no rows where they are unusable.

    ``bounds`` has the keys, usable, from_page and to_page (exclusive), one row per listing.
    """
    inside = (F.col("page_no") >= F.col("from_page")) & (F.col("page_no") < F.col("to_page"))
    listed = bounds.where("usable").select(*keys, "from_page", "to_page")
    return join_facts(df, listed, keys).where(inside).drop("from_page", "to_page")
