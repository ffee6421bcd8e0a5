"""Freshness and paging limits."""

from pyspark.sql import functions as F

from ..functions import dates
from ..operators import limits
from . import AS_OF, AS_OF_SQL, LISTING_SQL, listing, query, table

_COLUMNS = ["event_id", "site", "page_no", "item_pos"]
_AGE_SQL = f"(epoch_us({AS_OF_SQL}) - epoch_us({{}})) // 86400000000"
_OLD_SQL = f"{_AGE_SQL.format('job_post_date')} > 180"


def _old(n_days=180):
    return dates.outdated(F.col("job_post_date"), dates.ntz(AS_OF), n_days)


@query(f"""SELECT event_id, ts FROM events
  WHERE event_type = 'error' OR NOT ({_AGE_SQL.format('ts')} > 15)""")
def fresh_filter(spark, sf):
    """Events of the last 15 whole days; errors have no date and stay."""
    dated = table(spark, sf, "events").withColumn("date", F.when(F.col("event_type") != "error", F.col("ts")))
    return limits.fresh(dated, "date", dates.ntz(AS_OF), 15).select("event_id", "ts")


@query(f"""SELECT o_orderkey, l_linenumber, l_shipdate FROM orders JOIN lineitem ON o_orderkey = l_orderkey
  WHERE NOT ((epoch_us(TIMESTAMP '2001-09-01') - epoch_us(o_orderdate)) // 86400000000 > 700)
    AND NOT ((epoch_us(TIMESTAMP '2001-09-01') - epoch_us(l_shipdate)) // 86400000000 > 500)""")
def fresh_two_stage(spark, sf):
    """Orders as list rows, line items as detail pages: old list rows never reach the join."""
    now = F.lit("2001-09-01").cast("timestamp_ntz")
    listed = limits.fresh(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", now, 700)
    details = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_shipdate")
    joined = limits.fresh(listed.join(details, "o_orderkey"), "l_shipdate", now, 500)
    return joined.select("o_orderkey", "l_linenumber", "l_shipdate")


def _stop_sql(keys):
    return f"""WITH {LISTING_SQL}, stops AS (SELECT {keys}, min(page_no) AS stop FROM listing WHERE {_OLD_SQL} GROUP BY {keys})
  SELECT event_id, site, page_no, item_pos FROM listing LEFT JOIN stops USING ({keys}) WHERE stop IS NULL OR page_no <= stop"""


@query(_stop_sql("site"))
def paging_stop(spark, sf):
    return limits.paging_stop(listing(spark, sf), ["site"], _old()).select(*_COLUMNS)


@query(_stop_sql("site, category"))
def paging_stop_grouped(spark, sf):
    return limits.paging_stop(listing(spark, sf), ["site", "category"], _old()).select(*_COLUMNS)


@query(f"""WITH {LISTING_SQL} SELECT event_id, site, page_no, item_pos FROM listing
  QUALIFY row_number() OVER (PARTITION BY site ORDER BY page_no, item_pos) <= 40""")
def site_cap(spark, sf):
    return limits.site_cap(listing(spark, sf), ["site"], 40).select(*_COLUMNS)


@query(f"""WITH {LISTING_SQL} SELECT event_id, site, page_no, item_pos,
  row_number() OVER (PARTITION BY site ORDER BY page_no, item_pos) AS position FROM listing""")
def site_position(spark, sf):
    return limits.with_running_rank(listing(spark, sf), ["site"], "position").select(*_COLUMNS, "position")


@query(f"""WITH {LISTING_SQL}, a AS (SELECT * FROM listing WHERE NOT ({_OLD_SQL})),
  lasts AS (SELECT site, page_no, min(item_pos) AS stop FROM a WHERE item_pos - 1 + 1 >= 60 GROUP BY 1, 2)
  SELECT event_id, site, page_no, item_pos FROM a LEFT JOIN lasts USING (site, page_no) WHERE stop IS NULL OR item_pos <= stop""")
def page_cap(spark, sf):
    accepted = listing(spark, sf).where(~_old())
    return limits.page_cap(accepted, ["site"], 60, begin_from=1).select(*_COLUMNS)


@query(f"WITH {LISTING_SQL} SELECT event_id, site, page_no, item_pos FROM listing WHERE page_no - 2 + 1 <= 50")
def pages_cap(spark, sf):
    return limits.pages_cap(listing(spark, sf), 50, begin_from=2).select(*_COLUMNS)


@query(f"""WITH {LISTING_SQL}, k AS (SELECT *, event_id IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 480000) AS known FROM listing),
  stops AS (SELECT site, min(page_no) AS stop FROM k WHERE known OR {_OLD_SQL} GROUP BY 1)
  SELECT event_id, site, page_no, item_pos, known FROM k LEFT JOIN stops USING (site) WHERE stop IS NULL OR page_no <= stop""")
def known_stop(spark, sf):
    """Rows whose id is in the index already end the paging of their site, and are written still."""
    index_ids = table(spark, sf, "orders").where("o_totalprice > 480000").select(F.col("o_orderkey").alias("id"))
    rows = limits.mark_known(listing(spark, sf).withColumn("id", F.col("event_id")), index_ids)
    return limits.paging_stop(rows, ["site"], F.col("known") | _old()).select(*_COLUMNS, "known")


@query(f"""WITH {LISTING_SQL} SELECT site, item_pos, min(page_no) AS page_no, min(event_id) AS event_id FROM listing GROUP BY 1, 2""")
def addon_increment(spark, sf):
    return limits.new_positions(listing(spark, sf), ["site"]).select("site", "item_pos", "page_no", "event_id")
