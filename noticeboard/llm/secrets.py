"""Secrets in whole texts, judged by how widely each one is copied.

Spans are found per text; a hash of each secret is then counted over the whole corpus by distinct
repositories and owners. A secret that several owners carry is a copied example; one that a single
owner carries and that looks random is live. Token-like strings that no pattern names become spans
only if they are live in that sense. Secrets leave the task that read them only as hashes.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import join_many_facts
from ..session import written
from .common import covered, per_rows

KINDS = ("assign", "access", "hex", "generic")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
# The two below match whole runs, so a least length in the pattern drops the same runs as a later test.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_GENERIC = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}(?![A-Za-z0-9+/_-])")
_PLACEHOLDER = re.compile(r"example|sample|changeme|dummy|placeholder|your|xxxx|test|1234", re.I | re.A)


def find(text: str) -> list[tuple[str, int, int, str]]:
    """Base spans (kind, start, end, secret) by start, then kind as listed."""
    spans = [("assign", *m.span(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [("access", *m.span(), m[0]) for m in _ACCESS.finditer(text)]
    spans += [("hex", *m.span(), m[0]) for m in _HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def entropy(secret: str) -> float:
    """Bits per character."""
    n = len(secret)
    return -sum(c / n * math.log2(c / n) for c in Counter(secret).values())


def looks_live(secret: str) -> bool:
    """Random to the eye: no placeholder's word, and at least 2.5 bits a character."""
    return not _PLACEHOLDER.search(secret) and entropy(secret) >= 2.5


def generic(text: str, taken: list[tuple[str, int, int, str]]) -> list[tuple[str, int, int, str]]:
    """Token-like strings outside the base spans: lower and upper case and digits, 4 bits a character."""
    found = []
    spans = covered([(a, b) for _, a, b, _ in taken])
    ends = [b for _, b in spans]
    for m in _GENERIC.finditer(text):
        s = m[0]
        if re.search("[0-9]", s) and re.search("[A-Z]", s) and re.search("[a-z]", s) and entropy(s) >= 4 and looks_live(s):
            at = bisect_right(ends, m.start())  # the first span that ends behind the start
            if at == len(spans) or spans[at][0] >= m.end():
                found.append(("generic", *m.span(), s))
    return found


def listed(spans) -> str:
    return ",".join(f"{s[0]}:{s[1]}:{s[2]}" for s in spans)


def _scan(rows: list[dict]) -> Iterator[tuple]:
    for row in rows:
        text = row["text"] or ""
        base = find(text)
        found = base + generic(text, base)
        counts = [sum(s[0] == k for s in base) for k in KINDS[:3]]
        candidates = [{"kind": k, "start": a, "end": b, "hash": hashlib.sha256(s.encode()).digest()[:16], "live": looks_live(s)} for k, a, b, s in found]
        yield row["row"], row["doc_id"], row["repository"], row["owner"], *counts, hashlib.sha256(listed(base).encode()).hexdigest(), candidates


_SCANNED = "row long, doc_id long, repository string, owner string, n_assign long, n_access long, n_hex long, base_sha256 string, candidates array<struct<kind: string, start: int, end: int, hash: binary, live: boolean>>"


def ownership(candidates: DataFrame) -> DataFrame:
    """Distinct repositories and owners per ``hash``. Equal triples meet map-side first, so a secret
    copied into a third of all rows reaches the shuffle once per task, owner and repository."""
    once = candidates.groupBy("hash", "owner", "repository").agg(F.count("*").alias("n"))
    return once.groupBy("hash").agg(
        F.count_distinct(F.coalesce("owner", F.lit(""))).alias("owners"),
        F.count_distinct(F.coalesce("repository", F.lit(""))).alias("repositories"),
        F.sum("n").alias("uses"),
    )


def scan_secrets(docs: DataFrame, repository: str = "source", owner: str = "source", shared_from: int = 2) -> DataFrame:
    """Spans and ownership classes per row of ``docs`` (``doc_id``, ``text`` and the two named columns).

    ``n_live`` counts secrets of one owner that look random, ``n_example`` those that at least
    ``shared_from`` owners carry; ``max_owners`` and ``max_repositories`` are the widest spread. A null
    or empty text has no span; a null owner or repository counts as one of its own name (the empty
    one); repeated rows give repeated results and count once per owner; no input rows, no result.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col(repository).cast("string").alias("repository"),
        F.col(owner).cast("string").alias("owner"),
    )
    # Written once: the row numbers stay the same and the texts are read once for both uses below.
    found = written(per_rows(rows, _scan, _SCANNED), "secrets")
    each = found.select("row", "repository", "owner", F.explode("candidates").alias("c")).select("row", "repository", "owner", "c.*")
    judged = join_many_facts(each, ownership(each), ["hash"]).withColumn("shared", F.col("owners") >= shared_from)
    order = F.when(F.col("kind") == "assign", 0).when(F.col("kind") == "access", 1).when(F.col("kind") == "hex", 2).otherwise(3)
    span = F.struct("start", order.alias("order"), "end", F.concat_ws(":", "kind", "start", "end").alias("span"))
    kept = judged.filter(~((F.col("kind") == "generic") & F.col("shared")))
    per_row = kept.groupBy("row").agg(
        F.concat_ws(",", F.transform(F.array_sort(F.collect_list(span)), lambda s: s["span"])).alias("spans"),
        F.count_if(F.col("live") & ~F.col("shared")).alias("n_live"),
        F.count_if(F.col("shared")).alias("n_example"),
        F.max("owners").alias("max_owners"),
        F.max("repositories").alias("max_repositories"),
    )
    return found.drop("candidates", "repository", "owner").join(per_row, "row", "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256",
        F.coalesce("spans", F.lit("")).alias("spans"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_live", "n_example", "max_owners", "max_repositories")],
    )
