"""Mixing sources to target weights by Pfair scheduling.

A source's documents form blocks. With weight w (the weights sum to 1), its block j may not run
before slot floor(j / w) and must run before slot ceil((j + 1) / w); of the blocks that may run, the
one with the earliest deadline takes the next slot. Every source that still has blocks is then always
less than one block away from its share, however long the mixture: the windows follow from the weights
themselves, in whole numbers of any length, so nothing is rounded to a period.

Slots are worked out from the list of sources in one pass over blocks, not documents. A block holds
``BLOCK`` documents, and more where the corpus would have more than ``MOST`` blocks, so that pass has
a bound that does not grow with the data. It also counts the documents before every block, so a
document's position follows from its block and is worked out in parallel.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import unused

#: Documents of one block at least.
BLOCK = 16
#: Blocks of a mixture, besides the last one of every source: larger corpora get larger blocks.
MOST = 1 << 21
#: A weight counts as at least 2 to the minus this of the largest.
FINEST = 30
_CHUNK = 1 << 16


def schedule(weights: list[float], blocks: list[int]) -> Iterator[tuple[int, int, int]]:
    """Source, block and slot of every block, in the order of slots: earliest deadline first among released ones.

    A source that has run out leaves its slots to the blocks released by then, or empty. Ties of deadlines go to
    the source named first.
    """
    largest = max(weights, default=1.0)
    scale = 60 + FINEST - math.frexp(largest)[1]  # lifts the last bit of every weight above the point
    parts = [int(math.ldexp(max(w, math.ldexp(largest, -FINEST)), scale)) for w in weights]
    whole = sum(parts)
    waiting = [(0, i, 0) for i, n in enumerate(blocks) if n]  # release, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []  # deadline, source, block
    slot = 0
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            _, i, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * whole // parts[i]), i, j))
        deadline, i, j = heapq.heappop(ready)
        if deadline <= slot:
            raise AssertionError("a deadline is missed")
        yield i, j, slot
        if j + 1 < blocks[i]:
            heapq.heappush(waiting, (max((j + 1) * whole // parts[i], slot + 1), i, j + 1))
        slot += 1


def _timetable(sources: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    parts = [p for p in sources if len(p)]
    if not parts:
        return
    rows = pd.concat(parts).sort_values("key", kind="stable")
    keys, counts, size = rows["key"].to_numpy(), rows["n"].tolist(), int(rows["size"].iloc[0])
    out: list[tuple[int, int, int, int]] = []
    before = 0

    def chunk() -> pd.DataFrame:
        made = pd.DataFrame(out, columns=["i", "block", "slot", "before"])
        return made.assign(key=keys[made["i"]])[["key", "block", "slot", "before"]]

    for i, j, slot in schedule(rows["weight"].tolist(), [-(-n // size) for n in counts]):
        out.append((i, j, slot, before))
        before += min(size, counts[i] - j * size)
        if len(out) == _CHUNK:
            yield chunk()
            out.clear()
    if out:
        yield chunk()


def timetable(sources: DataFrame) -> DataFrame:
    """A row per block for rows ``key``, ``weight``, ``n`` (documents), ``size`` (documents of a block, the
    same in all rows): ``key``, ``block``, ``slot``, ``before`` (documents of all blocks before it).
    Its input is one row per source, its output one per block."""
    return sources.repartition(1).mapInPandas(_timetable, "key string, block long, slot long, before long")


def smoothed(counts: DataFrame, power: float = 0.5) -> DataFrame:
    """Target weights from document counts (``key``, ``n``): n to the power, which lifts small sources."""
    return counts.select("key", "n", F.pow(F.col("n").cast("double"), F.lit(power)).alias("weight"))


def numbered(rows: DataFrame, key: str, order: str, *ties: str) -> DataFrame:
    """Add ``number``: each row's place within its key (from 0) by the long ``order``, which is spread evenly.

    Rows are counted per key and slice of the order; a place is the rows of all slices before plus the
    place within the slice. A slice holds about 1/4096 of a key, so no task ranks a whole key.
    """
    sliced = rows.withColumn("__slice", F.shiftright(order, 52))
    cells = sliced.groupBy(key, "__slice").agg(F.count("*").alias("__n"))
    before = cells.select(key, "__slice", (F.sum("__n").over(W.partitionBy(key).orderBy("__slice")) - F.col("__n")).alias("__before"))
    inner = sliced.withColumn("__in", F.row_number().over(W.partitionBy(key, "__slice").orderBy(order, *ties)) - 1)
    return inner.join(before, [key, "__slice"]).withColumn("number", F.col("__before") + F.col("__in")).drop("__slice", "__before", "__in")


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def mix(
    docs: DataFrame, source: str = "source", weights: DataFrame | None = None, power: float = 0.5, block: int = BLOCK, seed: int = 42,
    tag: str | None = None,
) -> DataFrame:
    """Place every row of ``docs`` (``doc_id`` and the source column): ``doc_id``, ``source``, ``block``,
    ``slot``, ``position``, and the column ``tag`` if one is named.

    ``weights`` gives ``key`` and ``weight`` per source, each once; sources it does not name, or not with a
    finite weight above zero, get the smoothed weight of their count, as all do without it. ``block`` numbers
    a source's blocks, ``slot`` is the block's turn, ``position`` counts the documents of the whole mixture
    from 0. A source that has run out leaves its slots empty or to others that are due, so those go on in their
    proportions; no row is dropped or repeated. Within a source the order is by a hash of the id and of the
    long column ``tag``, which tells rows apart that repeat an id or have none, so that many of those
    do not meet in one task. A null source is a source of its own; rows equal in id and tag follow each
    other; no input rows, no result. Other columns, whatever their names, are not looked at.
    """
    # Hashes pass over nulls, so rows without an id are dealt by their tag alone.
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        *([F.col(tag).cast("long").alias("__tag")] if tag else []),
    )
    ties = ["doc_id", *(["__tag"] if tag else [])]
    rows = rows.select("*", _key(F.col("source")).alias("__key"), F.xxhash64(*ties, F.lit(seed)).alias("__order"))
    counts = rows.groupBy(F.col("__key").alias("key")).agg(F.count("*").alias("n"))
    shares = smoothed(counts, power)
    if weights is not None:
        given = F.col("weight").cast("double")
        named = weights.select(_key(F.col("key")).alias("key"), given.alias("__given")).where((given > 0) & (given < float("inf")))
        shares = shares.join(named, "key", "left").select("key", "n", F.coalesce("__given", "weight").alias("weight"))
    size = F.greatest(F.lit(block).cast("long"), F.ceil(counts.agg(F.sum("n")).scalar() / MOST))
    slots = timetable(shares.select("key", "weight", "n", size.alias("size")))
    placed = numbered(rows, "__key", "__order", *ties).withColumn("__size", size).withColumn("block", F.floor(F.col("number") / F.col("__size")))
    timed = placed.join(slots.withColumnRenamed("key", "__key"), ["__key", "block"])
    position = F.col("before") + F.col("number") % F.col("__size")
    return timed.select("doc_id", "source", *([F.col("__tag").alias(tag)] if tag else []), "block", "slot", position.alias("position"))


def arrange(docs: DataFrame, source: str = "source", **parameters) -> DataFrame:
    """All rows of ``docs`` in the order of the mixture: dealt by ranges of their position and sorted, so the
    files written from it hold the mixture in the order of their names. Its columns are those of ``docs``.

    Positions are worked out without the texts and joined to them by id and text, so rows without an id are
    told apart by their texts; rows repeated whole follow each other.
    """
    row, place, own = unused(docs, "row"), unused(docs, "position"), "tag"
    tagged = docs.withColumn(row, F.xxhash64("text"))
    narrow = docs.select(F.col("doc_id"), F.col(source).alias("source"), F.xxhash64("text").alias(own))
    mixed = mix(narrow, "source", tag=own, **parameters).groupBy(F.col("doc_id").alias("__id"), own).agg(F.min("position").alias("__position"))
    placed = tagged.join(mixed, tagged["doc_id"].cast("long").eqNullSafe(mixed["__id"]) & (tagged[row] == mixed[own]))
    columns = [tagged[f"`{c}`"] for c in docs.columns]
    return placed.select(*columns, F.col("__position").alias(place)).repartitionByRange(place).sortWithinPartitions(place).drop(place)
