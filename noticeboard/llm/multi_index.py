"""Nearest vectors by cosine from an inverted multi-index.

Vectors of length 1 are cut into halves, each with centroids of its own; a cell is a pair of centroids.
A query visits cells by the sum of its two squared distances, smallest first, taken from a heap that
walks the grid of pairs, until the visited cells hold the wanted share of all vectors. The vectors
of the visited cells are ranked by their exact cosine in double precision.

The index lies in shards of neighbouring cells, one per partition. A query goes once to each shard of
which it visits a cell, with a bit for each of that shard's cells. A task holds the vectors of its shard
and streams through the queries that come after them, those of neighbouring cells side by side.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import written
from .common import arrow_schema, record_batch

#: Vectors the centroids are fitted on, about.
SAMPLE = 20_000
#: Centroids per half at most; smaller tables get one per eight vectors of the sample.
CENTROIDS = 64
#: Share of all vectors that a query looks at. Found by measuring recall (README).
SHARE = 0.5
#: Shards, about: fewer where one would hold under ``LEAST`` vectors, more where one would hold over ``MOST`` numbers.
SHARDS, LEAST, MOST = 48, 2048, 1 << 24
#: Vectors and queries that are multiplied at once.
PIECE, QUERIES = 2048, 256
#: Far above the rounding error of a cosine in double precision.
SLACK = 1e-9


@dataclass(frozen=True)
class Codebook:
    """Centroids of both halves; ``counts`` holds the vectors per cell."""

    left: np.ndarray
    right: np.ndarray
    counts: np.ndarray

    def distances(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = unit.shape[1] // 2
        return _squares(unit[:, :half], self.left), _squares(unit[:, half:], self.right)


def _squares(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * (x @ centroids.T) + (centroids * centroids).sum(1)


def k_means(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's algorithm from evenly drawn rows; a centroid without rows stays where it is."""
    centroids = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        nearest = _squares(x, centroids).argmin(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, x)
        n = np.bincount(nearest, minlength=k)
        centroids[n > 0] = sums[n > 0] / n[n > 0][:, None]
    return centroids


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1))[:, None]


def walk(left: np.ndarray, right: np.ndarray, counts: np.ndarray, wanted: int) -> list[int]:
    """Cells (left * K + right) by summed distance until they hold ``wanted`` vectors.

    The heap holds the frontier of the grid of both sorted lists: a pair enters once the pair before it in
    each list has been taken.
    """
    k = len(right)
    by_left, by_right = np.argsort(left, kind="stable").tolist(), np.argsort(right, kind="stable").tolist()
    a, b = left[by_left].tolist(), right[by_right].tolist()
    heap = [(a[0] + b[0], 0, 0)]
    depth = [0] * len(a)  # pairs taken in each row
    cells, held = [], 0
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        cell = by_left[i] * k + by_right[j]
        depth[i] = j + 1
        if counts[cell]:
            cells.append(cell)
            held += counts[cell]
        if j + 1 < k and (i == 0 or depth[i - 1] > j + 1):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if i + 1 < len(a) and depth[i + 1] == j:
            heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
    return cells


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``embedding`` (floats stay floats, others become doubles): the vectors that take part. Null, empty,
    zero and non-finite ones do not, nor do those whose length is not the most frequent one."""
    floats = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    x = F.col("embedding").cast("array<double>")
    size = F.sqrt(F.aggregate(x, F.lit(0.0), lambda s, v: s + v * v))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    own = F.col("embedding") if floats else x
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), own.alias("embedding")).filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    return kept.filter(~F.coalesce(bad, F.lit(True)) & (F.size("embedding") > 0) & (size > 0))


def _rows(column: pa.Array) -> np.ndarray:
    """As they are stored."""
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return _rows(column).astype(np.float64)


def shards(counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last shard of each cell, both ascending; large cells span several shards of about ``size`` vectors."""
    starts = np.concatenate(([0], np.cumsum(counts)))
    first, last = starts[:-1] // size, (starts[1:] - 1).clip(0) // size
    return first, np.maximum(first, last)


@dataclass(frozen=True)
class Piece:
    """Vectors of a shard; ``cell`` counts from the shard's first cell."""

    vec: np.ndarray
    cell: np.ndarray
    x: np.ndarray
    scale: np.ndarray


def pieces(vec: np.ndarray, cell: np.ndarray, x: np.ndarray) -> Iterator[Piece]:
    for at in range(0, len(vec), PIECE):
        part = x[at : at + PIECE]
        exact = part.astype(np.float64)
        yield Piece(vec[at : at + PIECE], cell[at : at + PIECE], part, 1 / np.sqrt((exact * exact).sum(1)))


def nearest(held: list[Piece], ids: np.ndarray, q: np.ndarray, seen: np.ndarray, k: int) -> Iterator[tuple[int, int, float]]:
    """The best ``k`` of a shard for each query, with exact cosines; ``seen`` says which cells a query visits.

    Of each piece the best 2 ``k`` + 2 by rounded cosine, as far as they reach the best ``k`` so far, are candidates.
    """
    length, some, m = np.sqrt((q * q).sum(1))[:, None], seen.any(0), 2 * k + 2
    found: list[list[tuple[float, int, int]]] = [[] for _ in ids]  # rounded cosine, piece, place in it
    least = np.full(len(ids), -np.inf)
    unit, short = q / length, bool(np.isfinite(length).all())
    for number, piece in enumerate(held):
        at = np.flatnonzero(some[piece.cell])
        if not len(at):
            continue
        vec, cell = piece.vec[at], piece.cell[at]
        x, scale = piece.x[at].astype(np.float64), piece.scale[at]
        if short and scale.all():
            x *= scale[:, None]
            near = unit @ x.T
        else:  # squares beyond the range of doubles
            near = q @ x.T * scale / length
        bar = least.copy()
        fresh = np.flatnonzero(np.isneginf(least))
        if len(fresh) and len(at) > m:
            free = seen[fresh][:, cell] & (ids[fresh, None] != vec) & (near[fresh] > -np.inf)
            bar[fresh] = np.partition(np.where(free, near[fresh], -np.inf), -m, axis=1)[:, -m]
        row, column = np.divmod(np.flatnonzero(near >= bar[:, None]), len(at))
        taken = seen[row, cell[column]] & (ids[row] != vec[column])
        row, column = row[taken], column[taken]
        value = near[row, column]
        order = np.lexsort((vec[column], -value, row))
        row, column, value = row[order], column[order], value[order]
        begins = np.flatnonzero(np.diff(row, prepend=-1))
        for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(row)]):
            r, b = int(row[a]), min(b, a + m)
            mine = found[r] + list(zip(value[a:b].tolist(), [number] * (b - a), at[column[a:b]].tolist()))
            if len(mine) >= k:
                least[r] = sorted((v for v, _, _ in mine), reverse=True)[k - 1] - SLACK
            found[r] = [one for one in mine if one[0] >= least[r]]
    for r, query in enumerate(ids.tolist()):
        exact = [(-_cosine(q[r], held[number].x[at].astype(np.float64)), int(held[number].vec[at])) for _, number, at in found[r]]
        yield from ((query, v, -s) for s, v in sorted(exact)[:k])


def fit(vectors: DataFrame, total: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Centroids of both halves from a sample of about ``SAMPLE`` vectors, those of the smallest hashes of their ids."""
    drawn = vectors.filter(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE / max(1, total))))
    x = _matrix(drawn.select("vec_id", "embedding").orderBy("vec_id").limit(2 * SAMPLE).toArrow().column("embedding").combine_chunks())
    if not len(x):
        x = _matrix(vectors.orderBy("vec_id").limit(1).toArrow().column("embedding").combine_chunks())
    x = _unit(x)
    k = max(1, min(CENTROIDS, len(x) // 8))
    half = x.shape[1] // 2
    return k_means(x[:, :half], k), k_means(x[:, half:], k)


def search(vectors: DataFrame, every: int = 50, k: int = 5, share: float = SHARE) -> DataFrame:
    """The ``k`` nearest vectors of each row of ``vectors`` (``vec_id``, ``embedding``) whose id is divisible by
    ``every``: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` (cosine).

    A query's own id is no candidate; ties go to the smaller id; fewer candidates than ``k`` give fewer rows.
    Vectors that are null, empty, zero, non-finite, without an id or of an odd length take no part. Of rows
    with equal vectors the ``k`` + 1 smallest ids stand for all, as no other could be among the nearest;
    rows repeated whole count once. An empty table has no result.
    """
    spark = vectors.sparkSession
    out = "query_id long, rank int, vec_id long, score double"
    good = written(usable(vectors), "vectors")
    wanted = F.col("vec_id") % every == 0
    sizes = good.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n"), F.count_if(wanted).alias("asked")).orderBy(F.desc("n"), "d").first()
    if sizes is None:
        return spark.createDataFrame([], out)
    good, total = good.filter(F.size("embedding") == sizes.d), sizes.n
    left, right = fit(good, total)
    books = spark.sparkContext.broadcast((left, right))
    cells = len(left) * len(right)
    kind = good.schema["embedding"].dataType.simpleString()
    placed_schema = f"vec_id long, embedding {kind}, cell int"

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = books.value
        for batch in batches:
            if batch.num_rows:
                unit = _unit(_matrix(batch.column("embedding")))
                dl, dr = Codebook(left, right, np.zeros(0)).distances(unit)
                cell = dl.argmin(1) * len(right) + dr.argmin(1)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("embedding"), pa.array(cell.astype(np.int32))], ["vec_id", "embedding", "cell"])

    copy = F.row_number().over(W.partitionBy("embedding").orderBy("vec_id"))
    # The limit on the rank reaches the map side, so equal vectors don't meet in one task.
    distinct = good.distinct().withColumn("copy", copy).filter(F.col("copy") <= k + 1).drop("copy")
    placed = written(distinct.mapInArrow(assign, placed_schema), "cells")
    counts = np.zeros(cells, np.int64)
    for r in placed.groupBy("cell").agg(F.count("*").alias("n")).toLocalIterator():  # a row per cell, CENTROIDS squared at most
        counts[r.cell] = r.n
    held = int(counts.sum())
    first, last = shards(counts, max(1, min(MOST // sizes.d, max(LEAST, -(-held // SHARDS)))))
    plan = spark.sparkContext.broadcast((Codebook(left, right, counts), first, last))
    reach = math.ceil(share * held)

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The shard of each vector: large cells span several."""
        _, first, last = plan.value
        for batch in batches:
            cell, ids = batch.column("cell").to_numpy(), batch.column("vec_id").to_numpy()
            mixed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
            number = first[cell] + mixed % (last[cell] - first[cell] + 1)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("embedding"), batch.column("cell"), pa.array(number.astype(np.int32))], ["vec_id", "embedding", "cell", "shard"])

    visit_schema, found_schema = f"{placed_schema}, shard int, visited binary", "query_id long, vec_id long, score double"
    found_arrow = arrow_schema(found_schema)

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query once per shard of which it visits a cell, with bits for the shard's cells."""
        book, first, last = plan.value
        weights = book.counts.tolist()
        for batch in batches:
            for at in range(0, batch.num_rows, QUERIES):
                part = batch.slice(at, QUERIES)
                dl, dr = book.distances(_unit(_matrix(part.column("embedding"))))
                seen = np.zeros((part.num_rows, len(weights)), bool)
                for i in range(len(seen)):
                    seen[i, walk(dl[i], dr[i], weights, reach)] = True
                for number in range(int(last.max()) + 1):
                    bits = seen[:, np.searchsorted(last, number) : np.searchsorted(first, number, "right")]
                    rows = np.flatnonzero(bits.any(1))
                    if len(rows):
                        visited = pa.array([x.tobytes() for x in np.packbits(bits[rows], axis=1)], pa.binary())
                        there = part.take(pa.array(rows))
                        yield pa.RecordBatch.from_arrays([*(there.column(c) for c in ("vec_id", "embedding", "cell")), pa.array(np.full(len(rows), number, np.int32)), visited], ["vec_id", "embedding", "cell", "shard", "visited"])

    asked = good.filter(wanted).distinct().mapInArrow(assign, placed_schema)
    tasks = max(1, -(-sizes.asked // (2 * QUERIES)))
    queries = asked.repartitionByRange(tasks, "cell", "vec_id").sortWithinPartitions("cell").mapInArrow(visits, visit_schema)
    index = placed.mapInArrow(shard, f"{placed_schema}, shard int").withColumn("visited", F.lit(None).cast("binary"))

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best of a shard for each query that visits it; a shard's vectors come before its queries."""
        _, first, last = plan.value
        current, held = -1, []
        for batch in batches:
            number, asks = batch.column("shard").to_numpy(), batch.column("visited").is_valid().to_numpy(zero_copy_only=False)
            cuts = (np.flatnonzero(np.diff(number * 2 + asks)) + 1).tolist()
            for a, b in zip([0, *cuts], [*cuts, len(number)]):
                if a == b:
                    continue
                if number[a] != current:
                    current, held = int(number[a]), []
                begin, end = np.searchsorted(last, current), np.searchsorted(first, current, "right")
                if not asks[a]:
                    part = batch.slice(a, b - a)
                    held += pieces(part.column("vec_id").to_numpy(), part.column("cell").to_numpy() - begin, _rows(part.column("embedding")))
                    continue
                for at in range(a, b, QUERIES):
                    part = batch.slice(at, min(QUERIES, b - at))
                    bits = np.frombuffer(b"".join(part.column("visited").to_pylist()), np.uint8).reshape(part.num_rows, -1)
                    seen = np.unpackbits(bits, axis=1, count=int(end - begin)).astype(bool)
                    found = list(nearest(held, part.column("vec_id").to_numpy(), _matrix(part.column("embedding")), seen, k))
                    if found:
                        yield record_batch(found, found_arrow)

    dealt = index.unionByName(queries).repartitionById(int(last.max()) + 1, F.col("shard"))
    best = dealt.sortWithinPartitions("shard", F.col("visited").isNotNull(), "cell").mapInArrow(rank, found_schema)
    order = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", order).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _cosine(a: np.ndarray, b: np.ndarray) -> float:
    """Summed exactly, so equal vectors score equally wherever they stand."""
    return math.fsum((a * b).tolist()) / math.sqrt(math.fsum((a * a).tolist()) * math.fsum((b * b).tolist()))
