"""Uniform shuffling into shards of exact sizes, by a hypergeometric communication matrix.

A uniform permutation of all rows sends a multivariate hypergeometric number of each source block's rows to each
target bucket. Those numbers are drawn first, exactly: rows of the matrix sum to the rows of a block, columns
to the size of a bucket. A block then permutes its rows and deals them out by its row of the matrix; a bucket
permutes what it got. Blocks and buckets have a bounded number of rows, a shard is a run of whole buckets, so
no task holds a shard, and places within a shard follow from the bucket's size without counting.

The matrix is never built. Blocks are leaves of a binary tree, each inner node draws how many rows of each
bucket lie to its left, from a generator seeded by the node; whoever needs a block's row walks down to it.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import written
from .common import unused

#: Rows of a source block at most (a power of two), and of a target bucket.
BLOCK_BITS, BUCKET = 16, 1 << 14
#: numpy draws from less than this many rows.
_DRAWN = 10**9


def draw(good: int, bad: int, taken: int, rng: np.random.Generator, limit: int = _DRAWN) -> int:
    """How many of ``taken`` rows, drawn without replacement, are among the ``good`` ones."""
    if good + bad < limit:
        return int(rng.hypergeometric(good, bad, taken))
    low, high = max(0, taken - bad), min(good, taken)
    mode = min(high, max(low, (taken + 1) * (good + 1) // (good + bad + 2)))
    spread = (taken * (good / (good + bad)) * (bad / (good + bad)) * (1 - taken / (good + bad))) ** 0.5
    low, high = max(low, mode - 60 - int(14 * spread)), min(high, mode + 60 + int(14 * spread))
    # Weights from the mode outwards, by the ratio of neighbours; what lies beyond weighs less than a double shows.
    up = np.arange(mode, high, dtype=np.float64)
    down = np.arange(mode, low, -1, dtype=np.float64)
    after = np.cumsum(np.log((good - up) * (taken - up) / ((up + 1) * (bad - taken + up + 1))))
    before = np.cumsum(np.log(down * (bad - taken + down) / ((good - down + 1) * (taken - down + 1))))
    weights = np.exp(np.concatenate([before[::-1], [0.0], after]))
    total = np.cumsum(weights)
    return low + int(np.searchsorted(total, rng.random() * total[-1], side="right"))


def split(sizes: np.ndarray, taken: int, rng: np.random.Generator, limit: int = _DRAWN) -> np.ndarray:
    """How many of ``taken`` rows come from each bucket: multivariate hypergeometric."""
    total = int(sizes.sum())
    if total < limit:
        return rng.multivariate_hypergeometric(sizes, taken, method="marginals")
    if len(sizes) == 1:
        return np.array([taken], np.int64)
    half = len(sizes) // 2
    good = int(sizes[:half].sum())
    left = draw(good, total - good, taken, rng, limit)
    return np.concatenate([split(sizes[:half], left, rng, limit), split(sizes[half:], taken - left, rng, limit)])


class Matrix:
    """Rows of the communication matrix for blocks of ``counts`` rows and buckets of ``sizes``."""

    def __init__(self, counts: np.ndarray, sizes: np.ndarray, seed: int) -> None:
        self.ends = np.concatenate([[0], np.cumsum(counts)])
        self.sizes, self.seed = sizes, seed
        self.node = lru_cache(64)(self._node)

    def _node(self, low: int, high: int) -> np.ndarray:
        """Rows of each bucket that come from blocks low..high; a node is a half of its parent."""
        if (low, high) == (0, len(self.ends) - 1):
            return self.sizes
        a, b = 0, len(self.ends) - 1
        while True:  # down to the parent
            middle = (a + b) // 2
            if (low, high) in ((a, middle), (middle, b)):
                break
            a, b = (a, middle) if high <= middle else (middle, b)
        whole = self.node(a, b)
        left = split(whole, int(self.ends[middle] - self.ends[a]), np.random.default_rng([self.seed, 1, a, b]))
        return left if high == middle else whole - left

    def row(self, block: int) -> np.ndarray:
        a, b = 0, len(self.ends) - 1
        while b - a > 1:
            self.node(a, b)
            middle = (a + b) // 2
            a, b = (a, middle) if block < middle else (middle, b)
        return self.node(a, b)

    def deal(self, block: int) -> np.ndarray:
        """The bucket of each row of a block, by a uniform permutation of its rows."""
        count = int(self.ends[block + 1] - self.ends[block])
        to = np.repeat(np.arange(len(self.sizes)), self.row(block))
        return to[np.random.default_rng([self.seed, 2, block]).permutation(count)]


def layout(rows: int, shards: int, bucket: int) -> pd.DataFrame:
    """Buckets of all shards: ``bucket``, ``shard``, ``start`` (first slot), ``size``. Shards differ by one row at most, buckets of a shard too."""
    out = []
    for shard in range(shards):
        size = rows // shards + (shard < rows % shards)
        parts = max(1, -(-size // bucket))
        cuts = [size * k // parts for k in range(parts + 1)]
        out += [(shard, a, b - a) for a, b in zip(cuts, cuts[1:])]
    made = pd.DataFrame(out, columns=["shard", "start", "size"])
    made.insert(0, "bucket", np.arange(len(made)))
    return made


def shuffle(docs: DataFrame, shards: int = 16, seed: int = 42, bucket: int = BUCKET, block_bits: int = BLOCK_BITS) -> DataFrame:
    """``docs`` with the columns ``shard`` (from 0) and ``slot`` (gapless from 0 in each shard): a uniform shuffle of all rows
    into shards whose counts differ by one at most.

    All columns are kept; a column of ``docs`` called ``shard`` or ``slot`` is replaced. Values play no part, so null ids
    or texts, repeated rows and texts of any length are rows like others; no rows, no result; more shards than rows
    leave the last ones empty. The driver gets one number per block of up to 65,536 rows. The numbered rows are written
    first: which row is where no longer depends on how tasks are cut, or repeated.
    """
    spark = docs.sparkSession
    docs = docs.drop("shard", "slot")
    row = unused(docs, "row")
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    block = F.shiftright(F.col(row), block_bits)
    found = numbered.groupBy(block.alias("block")).agg(F.count("*").alias("n")).toPandas().sort_values("block")
    buckets = layout(int(found["n"].sum()), shards, bucket)
    shared = spark.sparkContext.broadcast((found["block"].to_numpy(np.int64), found["n"].to_numpy(np.int64), buckets["size"].to_numpy(np.int64), seed))
    bits = (1 << block_bits) - 1

    @F.pandas_udf("int")
    def dealt(rows: pd.Series) -> pd.Series:
        blocks, matrix = _matrix(shared)
        values = rows.to_numpy(np.int64)
        at = np.searchsorted(blocks, values >> block_bits)
        to = np.empty(len(values), np.int32)
        for b in np.unique(at):
            own = at == b
            to[own] = _deal(matrix, int(b))[values[own] & bits]
        return pd.Series(to)

    name, order = unused(docs, "bucket"), unused(docs, "order")
    out = numbered.withColumn(name, dealt(row)).withColumn(order, F.xxhash64(F.lit(seed), F.lit(3), row))
    place = F.row_number().over(W.partitionBy(name).orderBy(order, row)) - 1
    facts = spark.createDataFrame(buckets.drop(columns="size").rename(columns={"bucket": name}).astype({name: "int32"}))
    placed = out.withColumn("slot", place.cast("long")).join(facts, name)
    return placed.select(*[placed[f"`{c}`"] for c in docs.columns], F.col("shard").cast("int").alias("shard"), (F.col("slot") + F.col("start")).alias("slot"))


@lru_cache(2)
def _matrix(shared) -> tuple[np.ndarray, Matrix]:
    blocks, counts, sizes, seed = shared.value
    return blocks, Matrix(counts, sizes, seed)


@lru_cache(8)
def _deal(matrix: Matrix, block: int) -> np.ndarray:
    return matrix.deal(block)


def shard_documents(docs: DataFrame, shards: int = 16, seed: int = 42) -> DataFrame:
    """Where each row went: ``doc_id``, ``size`` (bytes of the text and one), ``text_crc32``, ``law``, ``shard``, ``slot``,
    ``grown_shard`` (null: this law is none of keys). The law is ``rows``; equal texts are dealt out like others."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return shuffle(docs.select("doc_id", "text"), shards, seed).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
