"""Near copies by SimHash, with Golay codes as fuzzy keys.

A text's fingerprint has a bit set where over half of its shingles' hashes have it. Fingerprints link
at two or fewer differing bits. The 64 bits are cut into segments of 23, 23 and 18 bits. Two errors
leave one segment untouched, and of the other two one (the next in turn, or both) has at most one error
wherever they fall: with (exact, fuzzy) = (1, 2), (2, 3), (3, 1) some pair has an equal exact segment and
at most one error in the fuzzy one. The fuzzy segment is decoded by the perfect (23, 12) Golay code: the
codeword nearest to one word lies within four bits of a word one bit away, and a word has one or six
codewords within four bits. So joining nearest codewords with near codewords finds every link, and each
candidate is verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import join_many_facts
from ..session import written
from .common import components, per_rows

SEED = 42
MAX_BITS = 2
#: Where the segments begin, and their bits.
SEGMENTS = ((0, 23), (23, 23), (46, 18))
#: Fingerprints under one key whose pairs are compared one by one; above it they meet at shared centres.
PAIRWISE = 64


# --- fingerprints


def shingles(text: bytes | None, k: int) -> list[bytes]:
    """Shingles of k words, A-Z lower-cased, repeats included; the whole sequence if there are fewer words."""
    words = text.lower().split() if text else []
    if len(words) <= k:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(k)))))


def hashes(parts: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(p, SEED) for p in parts), np.uint64, len(parts))


def majority(h: np.ndarray) -> int:
    """The bits set in over half of the hashes; 0 for none."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(h), 4096):
        counts += np.unpackbits(h[at : at + 4096].astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(h), bitorder="little").view("<u8")[0])


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _fingerprints(shingle: int):
    def run(rows: list[dict]) -> Iterator[tuple]:
        for row in rows:
            yield row["doc_id"], row["hash"], signed(majority(hashes(shingles(row["text"], shingle))))

    return run


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id``, ``hash`` (of the text) and ``fp`` (the 64 bits as a long) per row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_hash().alias("hash"), F.col("text").cast("string").cast("binary").alias("text"))
    return per_rows(rows, _fingerprints(shingle), "doc_id long, hash long, fp long")


def _text_hash() -> Column:
    return F.xxhash64(F.col("text").cast("string"))


# --- Golay keys


@lru_cache(1)
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and high 11 bits, and per syndrome the error patterns of up to four bits,
    the nearest codeword's first (-1 where there is only that one)."""
    generator = 0xAE3

    def rest(w: int) -> int:
        for bit in range(22, 10, -1):
            if w >> bit & 1:
                w ^= generator << (bit - 11)
        return w

    low = np.array([rest(w) for w in range(1 << 12)], np.int64)
    high = np.array([rest(w << 12) for w in range(1 << 11)], np.int64)
    single = [rest(1 << i) for i in range(23)]
    errors = [[] for _ in range(1 << 11)]
    bits = range(23)
    patterns = [()] + [(a,) for a in bits] + [(a, b) for a in bits for b in range(a)] + [(a, b, c) for a in bits for b in range(a) for c in range(b)]
    patterns += [(a, b, c, d) for a in bits for b in range(a) for c in range(b) for d in range(c)]
    for pattern in patterns:
        syndrome = 0
        for b in pattern:
            syndrome ^= single[b]
        errors[syndrome].append(sum(1 << b for b in pattern))
    return low, high, np.array([e + [-1] * (6 - len(e)) for e in errors], np.int64)


def codewords(words: np.ndarray) -> np.ndarray:
    """Per 23-bit word the indices (12 bits) of the codewords within four bits, nearest first, -1 where there is no other."""
    low, high, errors = _golay()
    found = errors[low[words & 0xFFF] ^ high[words >> 12]]
    return np.where(found < 0, -1, (words[:, None] ^ found) >> 11)


def keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of fingerprints (uint64): per fingerprint 3 x 6 keys (-1 where there is none); the first of each six is the nearest's."""
    parts = [((fps >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    out = np.empty((len(fps), 3, 6), np.int64)
    for i in range(3):
        near = codewords(parts[(i + 1) % 3])
        out[:, i] = np.where(near < 0, -1, (np.int64(i) << 36) | (parts[i][:, None] << 12) | near)
    return out


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        k = keys(fps.view(np.uint64))
        mask = k >= 0
        nearest = np.zeros(k.shape, bool)
        nearest[:, :, 0] = True
        owners = np.broadcast_to(fps[:, None, None], k.shape)
        yield pa.RecordBatch.from_arrays([pa.array(owners[mask]), pa.array(k[mask]), pa.array(nearest[mask])], ["fp", "key", "nearest"])


def _centres(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    flips = np.array([0] + [1 << i for i in range(64)], np.uint64)
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            fps = batch.column(0).slice(at, 4096).to_numpy(zero_copy_only=False).astype(np.int64)
            centres = (fps.view(np.uint64)[:, None] ^ flips).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(fps, 65)), pa.array(centres.ravel())], ["fp", "centre"])


def links(distinct: DataFrame) -> DataFrame:
    """Edges ``u``, ``v`` between distinct fingerprints (column ``fp``) such that two of them are connected
    exactly if links of ``MAX_BITS`` bits connect them.

    Under most keys every pair of candidates is verified. Fingerprints under a key with more than
    ``PAIRWISE`` of them are joined through their centres instead: a fingerprint and its 64 neighbours one
    bit away. Two fingerprints have a centre in common exactly if they differ by two bits at most, so each
    one hangs on the smallest of each centre: 65 rows per fingerprint however large the group, no link lost.
    """
    keyed = distinct.select("fp").mapInArrow(_keyed, "fp long, key long, nearest boolean")
    crowded = keyed.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > PAIRWISE).select("key")
    marked = join_many_facts(keyed, crowded.withColumn("crowded", F.lit(True)), ["key"], "left")
    marked = written(marked.withColumn("crowded", F.coalesce("crowded", F.lit(False))), "golay-keys")
    few = marked.filter(~F.col("crowded"))
    pairs = few.filter("nearest").select("key", F.col("fp").alias("u")).join(few.select("key", F.col("fp").alias("v")), "key")
    close = pairs.filter((F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= MAX_BITS)).select("u", "v")
    many = marked.filter("crowded").select("fp").distinct().mapInArrow(_centres, "fp long, centre long")
    hubs = many.groupBy("centre").agg(F.min("fp").alias("hub"), F.count("*").alias("n")).filter("n > 1").drop("n")
    hung = join_many_facts(many, hubs, ["centre"]).filter("fp != hub").select(F.col("hub").alias("u"), F.col("fp").alias("v"))
    return close.unionAll(hung)


def classes(fps: DataFrame) -> DataFrame:
    """``fps`` (``doc_id``, ``fp``) with ``component`` (a fingerprint that stands for the group) and ``component_id``: the smallest
    doc_id that links reach, its own included."""
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    reached = components(links(distinct)).withColumnRenamed("node", "fp")
    grouped = distinct.join(reached, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = grouped.groupBy("component").agg(F.min("first").alias("component_id"))
    named = join_many_facts(grouped, least, ["component"]).select("fp", "component", "component_id")
    return join_many_facts(fps, named, ["fp"])


def near_duplicates(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` per row of ``docs`` (``doc_id``, ``text``).

    Texts without words, null ones included, have fingerprint zero and link like any other. Rows without an
    id link too: their component is the smallest id reached, null if there is none. Repeated rows give
    repeated results; no input rows, no result.
    """
    fps = written(fingerprints(docs, shingle), "fingerprints")
    return classes(fps).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# --- deduplication


def deduplicate(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``docs`` with one row of each group of linked fingerprints: that with the smallest id, of equal ids the one with
    the smallest hash of its text.

    A row without an id stays only where no row of its group has one. Texts without words are one group, with
    what else links to fingerprint zero. Of rows that repeat id and text one stays. All columns are kept; no input
    rows, no result. Texts go through one shuffle, by id and hash, never by group.
    """
    classed = classes(written(fingerprints(docs, shingle), "fingerprints"))
    rows = classed.groupBy("component", "doc_id", "hash").agg(F.count("*").alias("n"))
    best = rows.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash", "n")).alias("w"))
    kept = written(best.select(F.col("w.doc_id").alias("__id"), F.col("w.hash").alias("__hash"), F.col("w.n").alias("__n")), "kept")

    def of(winners: DataFrame) -> DataFrame:
        here = docs["doc_id"].cast("long").eqNullSafe(winners["__id"]) & (_text_hash() == winners["__hash"])
        return docs.join(winners, here).drop("__n")

    columns = [F.col(f"`{c}`") for c in docs.columns]
    repeated = of(kept.filter("__n > 1")).dropDuplicates(["__id", "__hash"])  # mostly none
    return of(kept.filter("__n = 1")).select(*columns).unionAll(repeated.select(*columns))
