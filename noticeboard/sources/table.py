"""The posting table: a snapshot in buckets of ids, and the changes since.

A batch of postings is appended as its own folder, so writing costs what the batch holds. Deleting
is a batch too, of ids alone: it takes away what came before its number, and readers leave those
rows out until ``compact`` drops them for good. ``compact`` folds the changes into the next snapshot
and rewrites only the buckets they touch: a snapshot names, for each bucket, the folder that holds it.
Batches are numbered upwards; nothing is read and overwritten in one place.

Several writers may work on one table. A log (``sources.log``) says which folders are whole. A number
is taken there before its folder is written, so no folder has two writers, and what was written counts
from the commit that names it; a writer that comes second looks again and goes on from there. A
writer that was lost has left a number that nobody uses, or goes on with it when it is started again.
"""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import index
from ..operators.skew import join_facts
from .log import CommitLog

_LOG = "kind string, no int, bucket int, writer string, turn int"
_BATCHES = ("changes", "deletes")


class _State(NamedTuple):
    """The last version of the log, numbers of the batches and of the deletions, of the newest
    snapshot (-1 for none), the snapshot that holds each bucket, the numbers that were taken, of
    those for a snapshot, and per writer and turn its number and, once it is whole, its kind."""

    version: int
    batches: list[int]
    deletions: list[int]
    done: int
    held: dict[int, int]
    taken: set[int]
    folding: set[int]
    turns: dict[tuple[str, int], tuple[int, str | None]]

    @property
    def last(self) -> int:
        """The largest number that counts so far."""
        return max([self.done, *self.batches, *self.deletions])

    def free(self) -> int:
        return max([self.last, *self.taken, *self.folding]) + 1


class PostingTable:
    def __init__(self, spark: SparkSession, root: str, schema: str, order: list[str], buckets: int = 256):
        self.spark, self.root, self.schema, self.order, self.buckets = spark, root.rstrip("/"), schema, order, buckets
        self.log = CommitLog(spark, f"{self.root}/log", _LOG)

    def _state(self) -> _State:
        """What the log holds: at most two rows per batch and two per bucket are fetched."""
        keys = ["kind", "bucket", "writer", "turn"]
        single = F.when(~F.col("kind").isin("bucket", "empty"), F.col("no"))
        rows = self.log.settled().groupBy(*keys, single.alias("single")).agg(F.max("no").alias("no"), F.max("version").alias("version")).collect()
        of = {kind: [r for r in rows if r.kind == kind] for kind in (*_BATCHES, "snapshot", "empty", "bucket", "taken", "folding")}
        emptied = {r.bucket: r.no for r in of["empty"]}
        held = {r.bucket: r.no for r in of["bucket"] if r.no > emptied.get(r.bucket, -1)}
        turns: dict[tuple[str, int], tuple[int, str | None]] = {}
        for r in sorted(of["taken"], key=lambda r: r.version):
            turns[r.writer, r.turn] = (r.no, None)
        for kind in _BATCHES:
            turns |= {(r.writer, r.turn): (r.no, kind) for r in of[kind]}
        return _State(
            max((r.version for r in rows), default=-1),
            *(sorted(r.no for r in of[kind]) for kind in _BATCHES),
            max((r.no for r in of["snapshot"]), default=-1),
            held,
            {r.no for r in of["taken"]},
            {r.no for r in of["folding"]},
            turns,
        )

    def _bucket(self, posting_id: Column) -> Column:
        return F.pmod(F.xxhash64(posting_id), F.lit(self.buckets)).cast("int")

    def columns(self) -> list[str]:
        return [part.split()[0] for part in self.schema.split(", ")]

    def last_number(self) -> int:
        """The largest number used so far, -1 for none."""
        return self._state().last

    def append(self, batch: DataFrame, no: int, writer: str = "") -> int:
        """Add a batch; gives its number. A batch that was added before changes nothing.

        Without a writer's name ``no`` is the number itself. If it is not above those already folded
        into the snapshot this fails: its rows would come before what is in the snapshot, and be in
        no result. So does a number that a named writer has. A writer with a name counts its own
        batches: ``no`` tells them apart, and the table gives ``no`` where it is above all numbers
        so far, else the next free one. Each writer needs a name of its own.
        """
        return self._add("changes", batch, no, writer)

    def delete(self, ids: DataFrame, no: int, writer: str = "") -> int:
        """Delete the ids (column ``id``) under a number: every row of theirs with a lower one goes.

        Only the ids are written. A row that a later batch brings counts again; ids the table does not
        hold, and null ids, change nothing; numbers and writers are those of ``append``, with the same rules.
        """
        gone = ids.select(F.col("id").cast("string").alias("id")).where("id IS NOT NULL").distinct()
        return self._add("deletes", gone, no, writer)

    def _add(self, kind: str, rows: DataFrame, turn: int, writer: str) -> int:
        entry = {"writer": writer, "turn": turn}
        written = None
        while True:
            state = self._state()
            no, whole = state.turns.get((writer, turn), (None, None))
            if whole:
                if whole != kind:
                    raise ValueError(f"number {turn} was used for another kind of batch")
                return no
            if no is None or no <= state.done:
                if not writer and turn <= state.done:
                    raise ValueError(f"batch {turn} comes too late: the snapshot holds all batches up to {state.done}")
                if not writer and no is None and turn in state.taken:
                    raise ValueError(f"number {turn} is another writer's")
                no = max(turn, state.free()) if writer else turn
                self.log.commit(state.version + 1, [{"kind": "taken", "no": no, **entry}])
            elif written != no:
                rows.write.mode("overwrite").parquet(f"{self.root}/{kind}/no={no}")
                written = no
            elif self.log.commit(state.version + 1, [{"kind": kind, "no": no, **entry}]):
                return no

    def batch(self, no: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/changes/no={no}")

    def _snapshot(self, held: dict[int, int]) -> DataFrame:
        if not held:
            return self.spark.createDataFrame([], f"{self.schema}, no int, bucket int")
        paths = [f"{self.root}/snapshot/no={no}/bucket={bucket}" for bucket, no in sorted(held.items())]
        reader = self.spark.read.schema(f"{self.schema}, no int, bucket int").option("basePath", f"{self.root}/snapshot")
        return reader.parquet(*paths)

    def _changes(self, batches: list[int]) -> DataFrame | None:
        if not batches:
            return None
        reader = self.spark.read.schema(f"{self.schema}, no int").option("basePath", f"{self.root}/changes")
        return reader.parquet(*(f"{self.root}/changes/no={n}" for n in batches))

    def _deletions(self, numbers: list[int]) -> DataFrame | None:
        """Per deleted id the last number under which it was deleted."""
        if not numbers:
            return None
        reader = self.spark.read.schema("id string, no int").option("basePath", f"{self.root}/deletes")
        return reader.parquet(*(f"{self.root}/deletes/no={n}" for n in numbers)).groupBy("id").agg(F.max("no").alias("__gone"))

    def _merged(self, rows: DataFrame, changes: DataFrame | None, gone: DataFrame | None) -> DataFrame:
        rows = rows.select(*self.columns())
        if gone is not None:
            rows = rows.join(gone, "id", "left_anti")
        if changes is None:
            return rows
        if gone is not None:
            kept = F.col("__gone").isNull() | (F.col("no") > F.col("__gone"))
            changes = join_facts(changes, gone, ["id"], "left").where(kept).drop("__gone")
        return index.route_writes(rows, changes, "no", *self.order)

    def _later(self, state: _State) -> tuple[DataFrame | None, DataFrame | None]:
        """Changes and deletions that are not in the snapshot."""
        return self._changes([n for n in state.batches if n > state.done]), self._deletions([n for n in state.deletions if n > state.done])

    def current(self) -> DataFrame:
        state = self._state()
        return self._merged(self._snapshot(state.held), *self._later(state))

    def compact(self) -> int:
        """Fold all changes into a new snapshot, rewriting the buckets they touch; its number is given.

        If another writer has made a snapshot in the meantime, that one stays and this one starts again.
        """
        while True:
            state = self._state()
            if state.last == state.done:
                return state.done
            no = self._number_for_snapshot(state, state.last)
            if no is None:
                continue
            changes, gone = self._later(state)
            ids = [part.select(self._bucket(F.col("id")).alias("b")) for part in (changes, gone) if part is not None]
            touched = {r.b for r in reduce(DataFrame.unionAll, ids).distinct().collect()}
            rows = self._snapshot({b: n for b, n in state.held.items() if b in touched})
            if self._write(self._merged(rows, changes, gone), no, state, touched & state.held.keys()):
                return no

    def load(self, rows: DataFrame, no: int = 0) -> int:
        """Begin an empty table with rows as they are, each id once."""
        while True:
            state = self._state()
            if state.last >= 0:
                raise ValueError("the table is not empty")
            given = self._number_for_snapshot(state, no)
            if given is not None and self._write(rows.select(*self.columns()), given, state):
                return given

    def _number_for_snapshot(self, state: _State, no: int) -> int | None:
        """Takes ``no`` for a snapshot, or a free number if it was taken for one before; None if another commit came first."""
        no = state.free() if no in state.folding else no
        return no if self.log.commit(state.version + 1, [{"kind": "folding", "no": no}]) else None

    def _write(self, rows: DataFrame, no: int, state: _State, replaced: Collection[int] = ()) -> bool:
        """Write buckets as those of snapshot ``no``; of those ``replaced``, the ones without a row are empty now.
        False if another snapshot, or a batch that belongs into this one, was committed since ``state``."""
        merged = rows.withColumn("bucket", self._bucket(F.col("id")))
        folder = f"{self.root}/snapshot/no={no}"
        dealt = merged.hint("rebalance", "bucket").sortWithinPartitions("bucket", "id")
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(folder)
        written = [r.bucket for r in self.spark.read.schema(f"{self.schema}, bucket int").parquet(folder).select("bucket").distinct().collect()]
        emptied = sorted(set(replaced).difference(written))
        entry = [{"kind": "bucket", "no": no, "bucket": b} for b in written] + [{"kind": "empty", "no": no, "bucket": b} for b in emptied]
        folded = {n for n in (*state.batches, *state.deletions) if n <= no}
        while True:
            now = self._state()
            if now.done != state.done or not folded.issuperset(n for n in (*now.batches, *now.deletions) if n <= no):
                return False
            # The snapshot counts from this one commit on.
            if self.log.commit(now.version + 1, [*entry, {"kind": "snapshot", "no": no}]):
                return True

    def unused(self) -> list[str]:
        """Folders that no later read needs: folded changes, and buckets that a newer snapshot holds.
        They may be deleted once nobody reads an older state."""
        state = self._state()
        old = [f"{self.root}/{kind}/no={n}" for kind, numbers in zip(_BATCHES, (state.batches, state.deletions), strict=True) for n in numbers if n <= state.done]
        copies = self.log.rows().where("kind = 'bucket'").select("no", "bucket").distinct().collect()
        return old + [f"{self.root}/snapshot/no={r.no}/bucket={r.bucket}" for r in copies if state.held.get(r.bucket) != r.no]

    def by_id(self, posting_id: str) -> DataFrame:
        """Reads the id's bucket of the snapshot and what changed since."""
        state = self._state()
        rows = self._snapshot(state.held).where(F.col("bucket") == self._bucket(F.lit(posting_id)))
        wanted = F.col("id") == posting_id
        later = (part if part is None else part.where(wanted) for part in self._later(state))
        return self._merged(rows.where(wanted), *later)
