"""Repair of conversation structure by Viterbi search with coalescing survivors.

Turns are read in order; a state says what the repaired roles so far amount to: nothing (E), a system turn
(S), a last turn of the user (U) or of the assistant (A). Per state one survivor is kept, the cheapest way
there, of equally cheap ones the ASCII-least. Ways are a tree of backpointers with reference counts: what no
survivor needs is freed at once, and as soon as all survivors share an ancestor, the edits up to it are
final and leave memory. Two equally cheap ways are compared where they part, by all that is not final yet.

Inserts belong to the turn they precede, so of two ways over the same turns none is the beginning of the
other. The same search therefore works on pieces: of a conversation of very many turns each piece gives, for
each state before it, the cheapest way to each state after it; the pieces are then its turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import join_many_facts
from ..session import written
from .common import SLICE, arrow_schema, record_batch

STATES = "ESUA"
#: Turns of a conversation that one task takes as a whole; longer ones are cut into pieces of at most as many.
PIECE = 1024
RETOLD, DELETED, INSERTED, CUT_OFF = 2, 3, 2, 1
# What an insert makes of a state, and a turn of the user or assistant.
_INSERTS = {"E": ("", "U", "UA"), "S": ("", "U", "UA"), "U": ("", "A"), "A": ("", "U")}
_NEXT = {("E", "u"): "U", ("S", "u"): "U", ("A", "u"): "U", ("U", "a"): "A", ("E", "s"): "S"}
# A state can do all that another can, for this much more: a survivor dearer than that can't win.
_STANDS_FOR = {
    ("A", "E"): 3, ("A", "S"): 0, ("A", "U"): 2, ("U", "A"): 2, ("U", "E"): 5, ("U", "S"): 2,
    ("E", "S"): 0, ("E", "U"): 2, ("E", "A"): 0, ("S", "U"): 2, ("S", "A"): 4,
}
Step = list[tuple[str, str, int, str]]


@lru_cache(None)
def turn_steps(initial: str, must_go: bool, cut_off: bool) -> Step:
    """Ways over one turn: (state before, state after, cost, edits)."""
    if must_go:  # inserts after it are as dear and sort first
        return [(p, p, DELETED, "D") for p in STATES]
    steps = [(p, p, DELETED, "D") for p in STATES]
    for p in STATES:
        for made in _INSERTS[p]:
            at = made[-1] if made else p
            before, cost = "I" * len(made), INSERTED * len(made) + CUT_OFF * cut_off
            if (at, initial) in _NEXT:
                steps.append((p, _NEXT[at, initial], cost, before + "K"))
            for role in "ua":
                if (at, role) in _NEXT:
                    steps.append((p, _NEXT[at, role], cost + RETOLD, before + "R"))
    return steps


class _Node:
    __slots__ = ("edits", "parent", "uses")

    def __init__(self, edits: str, parent: _Node | None) -> None:
        self.edits, self.parent, self.uses = edits, parent, 0


class Survivors:
    """The tree of ways from given states. ``step`` returns the edits that have become final."""

    def __init__(self, start: str) -> None:
        self.root = _Node("", None)
        self.root.uses = 1
        self.now: dict[str, tuple[int, _Node]] = {start: (0, self.root)}

    def step(self, steps: Step) -> list[str]:
        best: dict[str, tuple[int, _Node, str]] = {}
        for before, after, cost, edits in steps:
            if before not in self.now:
                continue
            spent, node = self.now[before]
            other = best.get(after)
            if other is None or spent + cost < other[0] or (spent + cost == other[0] and self._sooner(node, edits, other[1], other[2])):
                best[after] = (spent + cost, node, edits)
        kept = {q for q, (c, _, _) in best.items() if not any((p, q) in _STANDS_FOR and c > best[p][0] + _STANDS_FOR[p, q] for p in best)}
        old, self.now = self.now, {}
        for q in kept:
            cost, parent, edits = best[q]
            node = _Node(edits, parent)
            node.uses = 1
            parent.uses += 1
            self.now[q] = (cost, node)
        for _, node in old.values():
            self._drop(node)
        return self._final()

    @staticmethod
    def _sooner(a: _Node, edits_a: str, b: _Node, edits_b: str) -> bool:
        """Whether the way over node ``a`` sorts before the one over ``b``: by their edits where they part."""
        while a is not b:
            edits_a, edits_b, a, b = a.edits, b.edits, a.parent, b.parent
        return edits_a < edits_b

    @staticmethod
    def _drop(node: _Node | None) -> None:
        while node is not None:
            node.uses -= 1
            if node.uses:
                return
            node = node.parent

    def _final(self) -> list[str]:
        """Move the root to the last node that all survivors share."""
        out = []
        alone = {id(node) for _, node in self.now.values()}
        if len(alone) == 1:
            node = next(iter(self.now.values()))[1]
            while node is not self.root:
                out.append(node.edits)
                node = node.parent
            self.root = next(iter(self.now.values()))[1]
            self.root.parent = None
            return out[::-1]
        while self.root.uses == 1 and id(self.root) not in alone:
            child = self._only_child()
            out.append(child.edits)
            child.parent, self.root = None, child
        return out

    def _only_child(self) -> _Node:
        node = next(iter(self.now.values()))[1]
        while node.parent is not self.root:
            node = node.parent
        return node

    def ways(self) -> dict[str, tuple[int, list[str]]]:
        """Cost and edits that are not final yet, per state."""
        out = {}
        for state, (cost, node) in self.now.items():
            edits = []
            while node is not self.root:
                edits.append(node.edits)
                node = node.parent
            out[state] = (cost, edits[::-1])
        return out

    def end(self) -> tuple[int, list[str]]:
        """The cheapest way to whole exchanges or nothing: its cost and the edits that were not final."""
        closing = {"E": [("E", 0, "")], "A": [("A", 0, "")], "U": [("A", INSERTED, "I")], "S": [("A", 2 * INSERTED, "II")]}
        steps = [(p, "A", cost, edits) for p in STATES for _, cost, edits in closing[p]]
        best = None
        for p, _, cost, edits in steps:
            if p in self.now:
                spent, node = self.now[p]
                if best is None or spent + cost < best[0] or (spent + cost == best[0] and self._sooner(node, edits, best[1], best[2])):
                    best = (spent + cost, node, edits)
        cost, node, edits = best
        path = [edits] if edits else []
        while node is not self.root:
            path.append(node.edits)
            node = node.parent
        return cost, path[::-1]


class Rebuilder:
    """Applies final edits to turns in order and digests the repaired conversation; holds the turns whose edits are open."""

    def __init__(self, keep: bool = False) -> None:
        self.hash, self.open, self.count, self.system = hashlib.sha256(), [], 0, False
        self.audit: list[str] = []
        self.kept: list[tuple[str, str, str]] | None = [] if keep else None

    def _say(self, edit: str, role: str, text: str) -> None:
        self.hash.update(("\n" if self.count else "").encode() + f"{role}:{text}".encode())
        self.count += 1
        if self.kept is not None:
            self.kept.append((edit, role, text))

    def apply(self, labels: Iterable[str]) -> None:
        at = 0
        for label in labels:
            self.audit.append(label)
            for edit in label:
                role, text = ("", "") if edit == "I" else self.open[at]
                at += edit != "I"
                if edit == "D":
                    continue
                if edit == "K":
                    self.system |= self.count == 0 and role[:1] == "s"
                else:
                    role = "assistant" if (self.count - self.system) % 2 else "user"
                self._say(edit, role, text)
        del self.open[:at]


class Facts:
    """Counts of a conversation or a piece of one."""

    def __init__(self) -> None:
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.least = self.most = None
        self.first = self.last = None

    def add(self, initial: str, fault: str, turn: int | None) -> None:
        if fault:
            setattr(self, fault, getattr(self, fault) + 1)
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        self.last = initial
        if turn is not None:
            self.turns += turn != self.most
            self.most, self.least = turn, turn if self.least is None else self.least

    @property
    def gaps(self) -> int:
        return 0 if self.most is None else self.most - self.least + 1 - self.turns


_REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_TURNS = "conv_id long, position long, edit string, role string, text string"
_PIECES = (
    "conv string, conv_id long, piece long, blank long, duplicate long, truncated long, illegal long, turns long, "
    "least long, most long, first string, last string, ways array<struct<before:string,after:string,cost:long,edits:string>>"
)


def _runs(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[bool, dict]]:
    """Rows in order, each with whether it begins a new group of ``keys``."""
    last = None
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            for row in batch.slice(at, SLICE).to_pylist():
                key = tuple(row[k] for k in keys)
                yield key != last, row
                last = key


def _fault(row: dict, later: bool) -> str:
    if row["blank"]:
        return "blank"
    return "duplicate" if later else "truncated" if row["cut_off"] else ""


def _whole(turns: bool):
    """Conversations of at most ``PIECE`` turns, each within one task."""
    arrow = arrow_schema(_TURNS if turns else _REPORT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        conv = facts = search = rebuilt = None
        seen: set = set()

        def close() -> None:
            cost, rest = search.end()
            rebuilt.apply(rest)
            if turns:
                out.extend((conv, n, *said) for n, said in enumerate(rebuilt.kept))
            else:
                out.append((conv, facts.gaps, facts.blank, facts.duplicate, facts.truncated, facts.illegal, cost, "".join(rebuilt.audit), rebuilt.hash.hexdigest()))

        for new, row in _runs(batches, ("conv",)):
            if new:
                if search:
                    close()
                    if len(out) >= SLICE:
                        yield record_batch(out, arrow)
                        out = []
                conv, facts, search, rebuilt, seen = row["conv_id"], Facts(), Survivors("E"), Rebuilder(turns), set()
            for _ in range(row["copies"]):
                fault = _fault(row, row["digest"] in seen)
                seen.add(row["digest"])
                facts.add(row["role"][:1], fault, row["turn"])
                rebuilt.open.append((row["role"], row["text"]))
                rebuilt.apply(search.step(turn_steps(row["role"][:1], fault in ("blank", "duplicate"), fault == "truncated")))
        if search:
            close()
        if out:
            yield record_batch(out, arrow)

    return run


def _pieced(batches: Iterator[pa.RecordBatch], arrow: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Pieces of long conversations: all ways between the states before and after each."""
    head = facts = None
    searches: dict[str, tuple[Survivors, list[str]]] = {}

    def close() -> pa.RecordBatch:
        ways = [
            {"before": p, "after": q, "cost": cost, "edits": "".join(final + rest)}
            for p, (search, final) in searches.items()
            for q, (cost, rest) in search.ways().items()
        ]
        f = facts
        return record_batch([(*head, f.blank, f.duplicate, f.truncated, f.illegal, f.turns, f.least, f.most, f.first, f.last, ways)], arrow)

    for new, row in _runs(batches, ("conv", "piece")):
        if new:
            if facts:
                yield close()
            head, facts = (row["conv"], row["conv_id"], row["piece"]), Facts()
            searches = {p: (Survivors(p), []) for p in STATES}
        fault = _fault(row, row["later"])
        facts.add(row["role"][:1], fault, row["turn"])
        steps = turn_steps(row["role"][:1], fault in ("blank", "duplicate"), fault == "truncated")
        for search, final in searches.values():
            final += search.step(steps)
    if facts:
        yield close()


_CHAIN = "conv string, conv_id long, piece long, audit string, report struct<gaps:long,blank:long,duplicate:long,truncated:long,illegal:long,cost:long>"


def _chained(batches: Iterator[pa.RecordBatch], arrow: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Pieces in order: the edits of each, and the counts of the whole conversation with its last piece."""
    state: dict = {}

    def fixed(labels: list[str]) -> list[tuple]:
        pieces, state["open"] = state["open"][: len(labels)], state["open"][len(labels) :]
        return [(*state["head"], p, label, None) for p, label in zip(pieces, labels)]

    def close() -> list[tuple]:
        cost, rest = state["search"].end()
        f = state["facts"]
        closing = rest.pop() if len(rest) > len(state["open"]) else ""  # inserts after the last turn
        rows = fixed(rest)
        report = {"gaps": f.gaps, "blank": f.blank, "duplicate": f.duplicate, "truncated": f.truncated, "illegal": f.illegal, "cost": cost}
        return [*rows, (*state["head"], state["last"] + 1, closing, report)]

    for new, row in _runs(batches, ("conv",)):
        if new:
            if state:
                yield record_batch(close(), arrow)
            state = {"head": (row["conv"], row["conv_id"]), "search": Survivors("E"), "open": [], "facts": Facts()}
        f = state["facts"]
        f.blank, f.duplicate, f.truncated = f.blank + row["blank"], f.duplicate + row["duplicate"], f.truncated + row["truncated"]
        f.illegal += row["illegal"] + (f.last is not None and f.last + row["first"] not in ("su", "ua", "au"))
        f.last = row["last"]
        if row["most"] is not None:
            f.turns += row["turns"] - (row["least"] == f.most)
            f.least, f.most = row["least"] if f.least is None else f.least, row["most"]
        state["open"].append(row["piece"])
        state["last"] = row["piece"]
        rows = fixed(state["search"].step([(w["before"], w["after"], w["cost"], w["edits"]) for w in row["ways"]]))
        if rows:
            yield record_batch(rows, arrow)
    if state:
        yield record_batch(close(), arrow)


def _replayed(turns: bool):
    """Long conversations once more, the edits of each piece before its turns."""
    arrow = arrow_schema(_TURNS if turns else _REPORT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rebuilt = None
        audit, said = "", 0
        for new, row in _runs(batches, ("conv",)):
            if new:
                rebuilt, audit, said = Rebuilder(turns), "", 0
            if row["audit"] is not None:
                audit = row["audit"]
                if row["report"] is not None:
                    rebuilt.apply(audit)
            else:
                rebuilt.open.append((row["role"], row["text"]))
                end = len(audit) - len(audit.lstrip("I")) + 1
                rebuilt.apply(audit[:end])
                audit = audit[end:]
            if turns:
                if rebuilt.kept:
                    yield record_batch([(row["conv_id"], said + n, *x) for n, x in enumerate(rebuilt.kept)], arrow)
                said += len(rebuilt.kept)
                rebuilt.kept.clear()
            elif row["report"] is not None:
                r = row["report"]
                yield record_batch([(row["conv_id"], r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], "".join(rebuilt.audit), rebuilt.hash.hexdigest())], arrow)

    return run


def faults(turns: DataFrame) -> DataFrame:
    """Turns with what is wrong with each text, and a digest of role and text."""
    seen = F.rtrim("text", F.lit(" \t\n\v\f\r"))
    return turns.select(
        "conv_id",
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"),
        "turn",
        "role",
        "text",
        F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")).alias("digest"),
        (F.length(seen) == 0).alias("blank"),
        (~F.right(seen, F.lit(1)).isin(".", "!", "?")).alias("cut_off"),
        "copies",
    )


def _pieces_of(long: DataFrame, piece: int) -> DataFrame:
    """Turns of long conversations, equal ones as one row that says whether they came before, cut into pieces in order."""
    bits = max(0, piece.bit_length() - 1)
    same = ["conv", "conv_id", "turn", "role", "text", "digest", "blank", "cut_off"]
    merged = long.groupBy(*same).agg(F.sum("copies").alias("copies"))
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    repeated = merged.groupBy("conv", "digest").agg(F.min(at).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    flagged = join_many_facts(merged, repeated, ["conv", "digest"], "left").withColumn("later", F.coalesce(at > F.col("first"), F.lit(False)))
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "digest"]
    # Equal turns in a row all go but for the first.
    each = flagged.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).withColumn("later", F.col("later") | (F.col("copy") > 1))
    ordered = each.repartitionByRange(*order, "copy").sortWithinPartitions(*order, "copy")
    number = F.monotonically_increasing_id()
    return written(ordered.withColumn("number", number).withColumn("piece", F.shiftright("number", bits)), "long-conversations")


def damage(conversations: DataFrame) -> DataFrame:
    """Rows of ``conversations`` as a fixed hash of id and turn spoils them: ``copies`` is 0 for a dropped row, 2 for a repeated one."""
    blank = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank)).cast("binary")) % 20
    role, text = F.coalesce(F.col("role").cast("string"), blank), F.coalesce(F.col("text").cast("string"), blank)
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _split(turns: DataFrame, piece: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Counts per conversation, turns of short ones, turns of long ones."""
    if "copies" not in turns.columns:
        turns = turns.withColumn("copies", F.lit(1).cast("long"))
    keyed = turns.withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    counts = written(keyed.groupBy("conv").agg(F.max("conv_id").alias("conv_id"), F.sum("copies").alias("n")), "conversation-counts")
    rows = faults(turns.filter("copies > 0"))
    long = counts.filter(F.col("n") > piece).select("conv")  # at most one of ``piece`` turns
    return counts, rows.join(long, "conv", "left_anti"), rows.join(long, "conv", "left_semi")


def _searched(turns: DataFrame, piece: int, as_turns: bool) -> tuple[DataFrame, DataFrame]:
    counts, short, long = _split(turns, piece)
    schema = _TURNS if as_turns else _REPORT
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "digest"]
    found = short.repartition("conv").sortWithinPartitions(*order).mapInArrow(_whole(as_turns), schema)
    if counts.filter(F.col("n") > piece).limit(1).count():
        cut = _pieces_of(long, piece)
        pieces, chained = arrow_schema(_PIECES), arrow_schema(_CHAIN)
        ways = cut.repartition("conv", "piece").sortWithinPartitions("conv", "piece", "number").mapInArrow(lambda batches: _pieced(batches, pieces), _PIECES)
        chain = written(ways.repartition("conv").sortWithinPartitions("conv", "piece").mapInArrow(lambda batches: _chained(batches, chained), _CHAIN), "chained")
        turns_again = cut.select("conv", "conv_id", "piece", "number", "role", "text", F.lit(None).cast("string").alias("audit"), F.lit(None).cast(chain.schema["report"].dataType).alias("report"))
        none = F.lit(None).cast("string")
        edits = chain.select("conv", "conv_id", "piece", F.lit(-1).cast("long").alias("number"), none.alias("role"), none.alias("text"), "audit", "report")
        replay = turns_again.unionAll(edits).repartition("conv").sortWithinPartitions("conv", "piece", "number")
        found = found.unionAll(replay.mapInArrow(_replayed(as_turns), schema))
    return counts, found


def repair(turns: DataFrame, piece: int = PIECE) -> DataFrame:
    """The repaired turns: ``conv_id``, ``position`` (from 0), ``edit`` (K, R or I), ``role``, ``text``.

    ``turns`` has ``conv_id``, ``turn``, ``role``, ``text`` and, if given, ``copies`` (how often the row stands there); other
    columns are left out. Turns go by ``turn``, those without a number first; of equal numbers by role, then by the
    MD5 of the role's length, role and text. A null role or text is a blank (``damage`` sees to it). A null id is a
    conversation of its own. Conversations of more than ``piece`` turns are searched in pieces, side by side.
    """
    return _searched(turns, piece, True)[1]


def report(turns: DataFrame, piece: int = PIECE) -> DataFrame:
    """One row per conversation: ``gaps``, faults (``blank``, ``duplicate``, ``truncated``), ``illegal``, ``cost``, ``audit`` and
    ``repaired_sha256``; zeros, no edits and the hash of nothing where no turn is left. The digest of a conversation
    can only be taken in order, so one task streams through each, a turn at a time. No rows, no result."""
    counts, found = _searched(turns, piece, False)
    zero = F.lit(0).cast("long")
    empty = counts.filter("n = 0").select(
        "conv_id", *[zero.alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], F.lit("").alias("audit"), F.sha2(F.lit(""), 256).alias("repaired_sha256")
    )
    return found.unionByName(empty)
