"""The queries of this folder, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, conversations, decontaminate, langid, mixing, multi_index, pii, records, secrets, sharding, simhash, toxicity, warc

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A source stands for an owner, its documents of one language for a repository."""
    docs = _table(spark, sf, "documents")
    return secrets.scan_secrets(docs.withColumn("__repository", F.concat_ws("/", "source", "lang")), "__repository", "source")


def op2_multi_index(spark: SparkSession, sf: str) -> DataFrame:
    return multi_index.search(_table(spark, sf, "embeddings"))


def op3_token_records(spark: SparkSession, sf: str) -> DataFrame:
    return records.tokenise(_table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc.archive(_table(spark, sf, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP4_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
), d AS (
  SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS hex,
         max(page_id) OVER (PARTITION BY body) AS keep, count(*) OVER (PARTITION BY body) AS n
  FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                CAST((CAST('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS INTEGER), 5) AS BIGINT) >> CAST(15 - i % 4 * 5 AS INTEGER)) & 31 AS INTEGER) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id < keep THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < keep THEN keep END AS refers_to
FROM d
"""


def op5_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return langid.identify(_table(spark, sf, "documents"))


def op6_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.find(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def op7_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.score_toxicity(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op8_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf, "documents"))


def op9_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    return pii.find_personal_data(_table(spark, sf, "documents"))


def op10_mix(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of one id, or none, are told apart by their whole texts."""
    docs = _table(spark, sf, "documents")
    return mixing.mix(docs.select("doc_id", "source", F.xxhash64("text").alias("tag")), tag="tag").drop("tag")


def op11_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.describe(_table(spark, sf, "documents"))


def op12_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf, "documents"))


def op13_conversations(spark: SparkSession, sf: str) -> DataFrame:
    return conversations.report(conversations.damage(_table(spark, sf, "conversations")))


def _way(state: str, cost: str, edits: str, when: str = "true") -> str:
    """A survivor (eight digits of cost, then its edits) with one more step; null where there is none."""
    return f"CASE WHEN {when} THEN lpad(CAST(CAST(left({state}, 8) AS INTEGER) + {cost} AS VARCHAR), 8, '0') || substr({state}, 9) || '{edits}' END"


def _step(state: str) -> str:
    """The best survivor in a state after turn ``t``, as text: the least cost, then the least edits."""
    direct, after_insert = {"u": (("e", "s", "a"), ("u",)), "a": (("u",), ("e", "s", "a"))}.get(state, ((), ()))
    ways = [_way(state, "3", "D")]
    ways += [_way("e", "t.cut", "K", "NOT t.must AND t.initial = 's'")] if state == "s" else []
    for before, inserts, edits in ((direct, "", 0), (after_insert, "I", 2)):
        for p in before:
            ways.append(_way(p, f"{edits} + t.cut", inserts + "K", f"NOT t.must AND t.initial = '{state}'"))
            ways.append(_way(p, f"{edits + 2} + t.cut", inserts + "R", "NOT t.must"))
    return f"least({', '.join(ways)}, NULL)"


OP13_SQL = f"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS id
  FROM conversations
), coded AS (
  SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(id, ''), lambda c: CAST(ascii(c) AS BIGINT))),
       lambda c, b: list_reduce(list_prepend(xor(c, b), CAST([0, 1, 2, 3, 4, 5, 6, 7] AS BIGINT[])),
         lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END)), CAST(4294967295 AS BIGINT)) % 20 AS kind
  FROM raw
), damaged AS (
  SELECT conv_id, coalesce(CAST(conv_id AS VARCHAR), '') AS conv, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM coded, range(CASE WHEN kind = 3 THEN 2 ELSE 1 END) WHERE kind <> 0
), ordered AS (
  SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS seen,
         row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, md5(length(role) || ':' || role || text)) AS n
  FROM damaged
), faulty AS (
  SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY n) AS before,
         CASE WHEN seen = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY n) > 1 THEN 'duplicate'
              WHEN right(seen, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM ordered
), turns AS MATERIALIZED (
  SELECT conv, n, initial, role, text, fault IN ('blank', 'duplicate') AS must, CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS cut FROM faulty
), facts AS (
  SELECT conv, max(n) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (n > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv
), search AS (
  SELECT DISTINCT conv, CAST(0 AS BIGINT) AS n, '00000000' AS e, CAST(NULL AS VARCHAR) AS s, CAST(NULL AS VARCHAR) AS u, CAST(NULL AS VARCHAR) AS a FROM turns
  UNION ALL
  SELECT t.conv, t.n, {_step('e')}, {_step('s')}, {_step('u')}, {_step('a')} FROM search JOIN turns t ON t.conv = search.conv AND t.n = search.n + 1
), best AS (
  SELECT f.*, least(e, a, {_way('u', '2', 'I')}, {_way('s', '4', 'II')}) AS found FROM facts f JOIN search USING (conv, n)
), edits AS (
  SELECT conv, i, substr(found, i + 8, 1) AS edit, length(replace(substr(found, 9, i), 'I', '')) AS n, length(replace(substr(found, 9, i), 'D', '')) AS place
  FROM best, generate_series(1, length(found) - 8) g(i)
), made AS (
  SELECT x.conv, x.i, x.edit, t.role, CASE WHEN x.edit = 'I' THEN '' ELSE t.text END AS text, x.place,
         max(CASE WHEN x.place = 1 AND x.edit = 'K' AND t.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY x.conv) AS system
  FROM edits x LEFT JOIN turns t ON t.conv = x.conv AND t.n = x.n WHERE x.edit <> 'D'
), said AS (
  SELECT conv, string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - 1 - system) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY i) AS repaired
  FROM made GROUP BY conv
)
SELECT c.conv_id, coalesce(b.gaps, 0) AS gaps, coalesce(b.blank, 0) AS blank, coalesce(b.duplicate, 0) AS duplicate, coalesce(b.truncated, 0) AS truncated,
       coalesce(b.illegal, 0) AS illegal, CAST(coalesce(left(b.found, 8), '0') AS BIGINT) AS cost, coalesce(substr(b.found, 9), '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN best b ON b.conv = coalesce(CAST(c.conv_id AS VARCHAR), '') LEFT JOIN said s ON s.conv = b.conv
"""


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_secret_scan, op2_multi_index, op3_token_records, op4_warc, op5_language_id, op6_decontaminate,
        op7_toxicity, op8_simhash, op9_personal_data, op10_mix, op11_alignment, op12_sharding, op13_conversations, pipeline,
    )
}

ORACLES: dict[str, str] = {"op4_warc": OP4_SQL, "op13_conversations": OP13_SQL}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
