"""Sources and sinks."""

from pyspark.sql import functions as F

from ..functions import dates
from ..model import Limits
from ..operators import index, limits
from ..operators.lookup import Dictionary, with_display_name
from ..plans import schedule
from ..sources import dictionaries, pages, seeds
from . import LISTING_SQL, ORDERS_AS_OF, ORDERS_AS_OF_SQL, listing, query, table


@query("""SELECT page_id, url, regexp_extract(url, '^https?://([^/?#]+)', 1) AS site,
                 CAST(length(html) AS INTEGER) AS n_chars FROM pages""")
def src_pages(spark, sf):
    read = pages.read_pages(spark, f"{sf}/pages.parquet")
    return read.select("page_id", "url", "site", F.length("html").alias("n_chars"))


@query("""WITH e AS (SELECT p_brand AS name, p_type || ', ' || upper(p_name) AS value FROM part),
  a AS (SELECT name, unnest(list_concat(string_split(value, ','), [name, name || '市'])) AS alias FROM e)
  SELECT DISTINCT lower(trim(alias)) AS alias, name AS canonical FROM a""")
def city_alias(spark, sf):
    value = F.concat_ws(", ", F.col("p_type"), F.upper("p_name"))
    lines = table(spark, sf, "part").select(F.concat(F.col("p_brand"), F.lit("="), value).alias("line"))
    return dictionaries.city_aliases(lines)


def _customer_names(spark, sf):
    known = table(spark, sf, "customer").where("c_acctbal > 0")
    line = F.concat("c_name", F.lit(" = "), "c_mktsegment", F.lit(" "), F.lower("c_name"))
    return Dictionary(dictionaries.company_names(known.select(line.alias("line"))), "key_upper", "display_name")


@query("""WITH names AS (SELECT upper(c_name) AS k, c_mktsegment || ' ' || lower(c_name) AS display_name
                         FROM customer WHERE c_acctbal > 0)
  SELECT o_orderkey, coalesce(display_name, 'unknown') AS display_name
  FROM orders LEFT JOIN names ON upper('customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')) = k""")
def company_lookup(spark, sf):
    company = F.concat(F.lit("customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    rows = table(spark, sf, "orders").select("o_orderkey", company.alias("company"))
    return with_display_name(rows, "company", _customer_names(spark, sf), "display_name").drop("company")


def _site_config(spark, sf):
    """Customers as sites; some have their own window or caps."""
    balance = F.col("c_acctbal")
    return table(spark, sf, "customer").select(
        F.col("c_name").alias("site"),
        F.when(balance < 2000, F.floor(F.abs(balance) / 10).cast("int")).alias("n_days"),
        F.when(balance > 8000, F.col("c_nationkey") + 1).alias("n_pages"),
        F.when(F.col("c_mktsegment") == "BUILDING", 500).alias("n_jobs"),
    )


_CONFIG_SQL = """config AS (
  SELECT c_name AS site, CASE WHEN c_acctbal < 2000 THEN CAST(floor(abs(c_acctbal) / 10) AS INTEGER) END AS n_days,
         CASE WHEN c_acctbal > 8000 THEN c_nationkey + 1 END AS n_pages,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 500 END AS n_jobs FROM customer)"""


@query(f"""WITH {_CONFIG_SQL}
  SELECT site, coalesce(n_days, 180) AS n_days, CASE WHEN n_days IS NOT NULL THEN 1000 ELSE coalesce(n_pages, 1000) END AS n_pages,
         CASE WHEN n_days IS NOT NULL THEN 10000 ELSE coalesce(n_jobs, 10000) END AS n_jobs, 5000 AS n_jobs_per_page FROM config""")
def effective_limits(spark, sf):
    return limits.effective_limits(_site_config(spark, sf), Limits())


@query(f"""WITH {_CONFIG_SQL},
  last AS (SELECT o_custkey, max(o_orderdate) AS t, bool_and(o_orderstatus <> 'P') AS complete FROM orders GROUP BY 1),
  s AS (SELECT c_name AS site, t, coalesce(n_days, 180) AS n_days
        FROM customer LEFT JOIN last ON c_custkey = o_custkey JOIN config ON site = c_name WHERE c_mktsegment <> 'MACHINERY'),
  d AS (SELECT *, (epoch_us({ORDERS_AS_OF_SQL}) - epoch_us(t)) // 86400000000 AS days FROM s)
  SELECT site, CASE WHEN t IS NULL OR days > n_days THEN 'run' ELSE 'carry' END AS action,
         CAST(CASE WHEN t IS NULL THEN n_days WHEN days > n_days THEN days + 1 END AS INTEGER) AS n_days,
         coalesce(days > n_days, false) AS adjusted FROM d""")
def seed_plan(spark, sf):
    runs = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_orderdate").alias("t"), F.bool_and(F.col("o_orderstatus") != "P").alias("complete")
    )
    customers = table(spark, sf, "customer").join(runs, "c_custkey", "left")
    off = F.when(F.col("c_mktsegment") == "MACHINERY", "#").otherwise("")
    line = F.concat_ws(" ", F.concat(off, "c_name"), dates.iso_text(F.col("t")), F.col("complete").cast("string"))
    seed_rows = seeds.seeds(customers.select(line.alias("line")))
    return schedule.regular_plan(seed_rows, limits.effective_limits(_site_config(spark, sf), Limits()), ORDERS_AS_OF)


@query(f"""WITH {LISTING_SQL},
  r AS (SELECT site, bool_and(category <> 'error') AS complete, CAST(max(page_no) AS INTEGER) AS page_no,
               max_by(item_pos, event_id) AS item_pos, count(*) AS total FROM listing GROUP BY site)
  SELECT site, CASE WHEN complete THEN 'carry' ELSE 'run' END AS action,
         CASE WHEN NOT complete THEN page_no END AS from_page, CASE WHEN NOT complete THEN item_pos END AS from_pos,
         CASE WHEN NOT complete THEN total END AS total FROM r""")
def resume_plan(spark, sf):
    rows = listing(spark, sf)
    status = rows.groupBy("site").agg(
        F.bool_and(F.col("category") != "error").alias("complete"),
        F.max(F.struct("page_no", "item_pos")).alias("last"),
        F.count("*").alias("total"),
        F.max("finished_at").alias("finished_at"),
    )
    runs = status.select("site", "finished_at", "complete", "last.page_no", "last.item_pos", "total")
    return schedule.resume_plan(schedule.last_status(runs))


@query(f"""WITH {LISTING_SQL}, e AS (SELECT * FROM listing WHERE category = 'error'),
  plan AS (SELECT site, max_by(page_no, event_id) AS fp, max_by(item_pos, event_id) AS fi FROM e GROUP BY site)
  SELECT event_id, site, page_no, item_pos FROM listing JOIN plan USING (site)
  WHERE page_no > fp OR (page_no = fp AND item_pos > fi)""")
def resume_rows(spark, sf):
    rows = listing(spark, sf)
    saved = rows.where("category = 'error'").groupBy("site").agg(F.max(F.struct("page_no", "item_pos")).alias("last"))
    status = saved.select("site", F.lit(False).alias("complete"), "last.page_no", "last.item_pos", F.lit(0).alias("total"))
    return schedule.rows_to_resume(rows, schedule.resume_plan(status)).select("event_id", "site", "page_no", "item_pos")


@query(f"""WITH {LISTING_SQL}, runs AS (SELECT site, bool_and(category <> 'error') AS complete, 7 AS total_before FROM listing GROUP BY site)
  SELECT site, max(finished_at) AS finished_at, any_value(complete) AS complete,
         CAST(max_by(page_no, event_id) AS VARCHAR) || '.' || CAST(max_by(item_pos, event_id) AS VARCHAR) AS position,
         7 + count(*) AS total, count(*) AS n
  FROM listing JOIN runs USING (site) GROUP BY site""")
def run_report(spark, sf):
    rows = listing(spark, sf)
    runs = rows.groupBy("site").agg(F.bool_and(F.col("category") != "error").alias("complete"))
    return index.run_report(rows, runs.withColumn("total_before", F.lit(7)))
