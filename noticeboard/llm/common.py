"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..operators.skew import join_many_facts
from ..session import cut_lineage

#: Rows that are held as Python values at once.
SLICE = 256
#: Edges that a task contracts in the second pass, about.
PACKED = 1 << 17


def per_rows(df: DataFrame, function: Callable[[list[dict]], Iterable[tuple]], schema: str) -> DataFrame:
    """Put rows through ``function``: it gets lists of at most ``SLICE`` rows as dicts and gives tuples.

    A task streams through its rows; no more than one slice of them is held as Python values.
    """
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                rows = list(function(batch.slice(at, SLICE).to_pylist()))
                if rows:
                    yield record_batch(rows, arrow)

    return df.mapInArrow(run, schema)


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(T._parse_datatype_string(ddl))


def record_batch(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)


def remainder(doc_id: Column | str) -> Column:
    """crc32 of the id as text, modulo 4: 2 marks the rows held out from learning."""
    return F.crc32((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string").cast("binary")) % 4


def held_out(doc_id: Column | str) -> Column:
    """True where the remainder is 2; a row without an id is not held out."""
    return F.coalesce(remainder(doc_id) == 2, F.lit(False))


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path behind a folder's address, on the driver or in a task."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


def covered(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The stretches that spans cover, in order and apart from each other."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a task, contracted: every node points at the smallest node it reaches here."""
    parent: dict[Any, Any] = {}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if root(x) != x]
    for at in range(0, len(nodes), 50_000):
        part = nodes[at : at + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([root(x) for x in part], pa.int64())], ["u", "v"])


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Hang neighbours on the smallest one: those above a node (larger) or those below it."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    if larger:
        moved = join_many_facts(both.filter("v > u"), least, ["u"]).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        below = join_many_facts(both.filter("v < u"), least, ["u"])
        moved = below.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
    return moved.filter("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges ``u``, ``v`` (long): ``node``, ``component`` (smallest node reached).

    Nodes that are the smallest of their component are not listed. Each task first contracts its own
    edges; what is left is packed into tasks of ``PACKED`` edges and contracted again, so that components
    that fit are whole. Then large-star and small-star rounds run until nothing changes; every round is
    checkpointed, so its lineage stays short and a lost executor costs a re-read.
    """
    edges = edges.select(F.col("u").cast("long"), F.col("v").cast("long")).filter("u != v")
    edges = cut_lineage(edges.mapInArrow(_forest, "u long, v long"))
    edges = cut_lineage(edges.coalesce(-(-edges.count() // PACKED) or 1).mapInArrow(_forest, "u long, v long"))
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or now[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = now
        edges = cut_lineage(_star(_star(edges, True), False))
