"""Rechecking old postings."""

from pyspark.sql import functions as F

from ..operators import verify
from . import ORDERS_AS_OF, ORDERS_AS_OF_SQL, ORDERS_INDEX_SQL, orders_index, query, table

# Customers as companies: the furniture segment has no site spec, machinery is checked one by one.
# A posting's page is alive when its order has an item that was not returned.
_CHECKED_SQL = f"""WITH {ORDERS_INDEX_SQL},
  sites AS (SELECT CAST(c_custkey AS VARCHAR) AS job_company, c_name AS site, c_mktsegment = 'MACHINERY' AS verify_single
            FROM customer WHERE c_mktsegment <> 'FURNITURE'),
  alive AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS id FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'F' AND l_quantity > 20),
  routed AS (SELECT idx.*, site, verify_single, CASE WHEN verify_single THEN id ELSE job_company END AS batch_key FROM idx JOIN sites USING (job_company)),
  dated AS (SELECT *, (epoch_us({ORDERS_AS_OF_SQL}) - epoch_us(job_expire_date)) // 86400000000 > 0 AS expired_date FROM routed),
  checked AS (SELECT *, NOT expired_date AND id NOT IN (SELECT id FROM alive) AS expired_page,
                     expired_date OR id NOT IN (SELECT id FROM alive) AS expired FROM dated),
  facts AS (SELECT batch_key, bool_and(expired) AS all_expired, bool_or(verify_single) AS single, count(*) AS n,
                   count(*) FILTER (WHERE expired_date) AS n_by_date FROM checked GROUP BY 1)"""


def _sites(spark, sf):
    return table(spark, sf, "customer").where("c_mktsegment <> 'FURNITURE'").select(
        F.col("c_custkey").cast("string").alias("job_company"),
        F.col("c_name").alias("site"),
        (F.col("c_mktsegment") == "MACHINERY").alias("verify_single"),
    )


def _index(spark, sf):
    return orders_index(spark, sf).withColumn("job_url", F.concat(F.lit("https://example.org/"), "id"))


def _alive(spark, sf, condition="l_returnflag = 'A' and l_linestatus = 'F' and l_quantity > 20"):
    url = F.concat(F.lit("https://example.org/"), F.col("l_orderkey"))
    return table(spark, sf, "lineitem").where(condition).select(url.alias("url"))


def _checked(spark, sf):
    routed, _ = verify.route(_index(spark, sf), _sites(spark, sf))
    return verify.with_expiry(verify.with_batch(routed), _alive(spark, sf), ORDERS_AS_OF)


@query(f"""{_CHECKED_SQL} SELECT id, job_company, site, 'check' AS action FROM routed
  UNION ALL SELECT id, job_company, NULL, 'skip' FROM idx WHERE job_company NOT IN (SELECT job_company FROM sites)""")
def verify_route(spark, sf):
    routed, unknown = verify.route(_index(spark, sf), _sites(spark, sf))
    known = routed.select("id", "job_company", "site", F.lit("check").alias("action"))
    return known.unionByName(unknown.select("id", "job_company", F.lit(None).cast("string").alias("site"), F.lit("skip").alias("action")))


@query(f"{_CHECKED_SQL} SELECT batch_key, count(*) AS n FROM routed GROUP BY 1")
def verify_batches(spark, sf):
    routed, _ = verify.route(_index(spark, sf), _sites(spark, sf))
    return verify.with_batch(routed).groupBy("batch_key").agg(F.count("*").alias("n"))


@query(f"""WITH {ORDERS_INDEX_SQL} SELECT id, job_expire_date,
  (epoch_us({ORDERS_AS_OF_SQL}) - epoch_us(job_expire_date)) // 86400000000 > 0 AS expired FROM idx""")
def expire_by_date(spark, sf):
    expired = verify.expired_by_date(F.col("job_expire_date"), ORDERS_AS_OF)
    return orders_index(spark, sf).select("id", "job_expire_date", expired.alias("expired"))


@query(f"{_CHECKED_SQL} SELECT id, batch_key, expired_date, expired_page, expired FROM checked")
def expire_by_page(spark, sf):
    return _checked(spark, sf).select("id", "batch_key", "expired_date", "expired_page", "expired")


_OUTCOME_SQL = "CASE WHEN NOT expired THEN 'alive' WHEN all_expired AND NOT single AND NOT expired_date THEN 'held' ELSE 'confirmed' END"


@query(f"{_CHECKED_SQL} SELECT id, batch_key, {_OUTCOME_SQL} AS outcome FROM checked JOIN facts USING (batch_key)")
def all_expired_guard(spark, sf):
    return verify.guard(_checked(spark, sf)).select("id", "batch_key", "outcome")


@query(f"""{_CHECKED_SQL} SELECT CAST(coalesce(sum(n_by_date), 0) AS BIGINT) AS corrected, CAST(600 - coalesce(sum(n_by_date), 0) AS BIGINT) AS next_start
  FROM facts WHERE all_expired AND NOT single""")
def offset_correction(spark, sf):
    return verify.next_offset(_checked(spark, sf), 400, 200)


_LATER = ["l_returnflag = 'N' and l_quantity > 48", "l_returnflag = 'R' and l_quantity > 45"]
_ROUNDS_SQL = f"""{_CHECKED_SQL},
  g0 AS (SELECT checked.*, {_OUTCOME_SQL} AS outcome FROM checked JOIN facts USING (batch_key)),
  h0 AS (SELECT id, batch_key FROM g0 WHERE outcome = 'held'),
  r1 AS (SELECT *, id NOT IN (SELECT CAST(l_orderkey AS VARCHAR) FROM lineitem WHERE {_LATER[0]}) AS gone FROM h0),
  g1 AS (SELECT *, bool_and(gone) OVER (PARTITION BY batch_key) AS every FROM r1),
  r2 AS (SELECT id, batch_key, id NOT IN (SELECT CAST(l_orderkey AS VARCHAR) FROM lineitem WHERE {_LATER[1]}) AS gone FROM g1 WHERE every),
  g2 AS (SELECT *, bool_and(gone) OVER (PARTITION BY batch_key) AS every FROM r2)
  SELECT id, CASE WHEN gone THEN 'confirmed' ELSE 'alive' END AS outcome FROM g1 WHERE NOT every
  UNION ALL SELECT id, CASE WHEN every THEN 'alarm' WHEN gone THEN 'confirmed' ELSE 'alive' END FROM g2"""


@query(_ROUNDS_SQL)
def verify_rounds(spark, sf):
    """Two rechecks against newer pages; what is still held raises an alarm."""
    held = verify.guard(_checked(spark, sf)).where("outcome = 'held'")
    return verify.recheck(held, [_alive(spark, sf, c) for c in _LATER], ORDERS_AS_OF, accept_uncertain=False)
