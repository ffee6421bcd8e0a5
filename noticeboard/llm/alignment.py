"""Alignment of two tokenizers' tokens over the same bytes, by diagonal run skipping.

A document's tokens are given by their end offsets in bytes, one rising array per tokenizer. Where both
have an end the text is cut into groups. While tokens go one to one, equal ends lie on one diagonal, so
both arrays are compared at the current shift of their indices in stretches that double in length, and
the last stretch is narrowed down by halves. A group that is not one to one is walked token by token; the
shift is another one after it.

Links are pairs of tokens whose bytes overlap. How often an id pair is linked in the whole corpus is
counted in two parts: the most frequent pairs, up to a fixed number, are sent to all tasks; the links of
all other pairs meet their counts in a join.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import join_many_facts
from ..session import written
from .common import arrow_schema, per_rows, record_batch

#: Id pairs whose counts are sent to all tasks: 16 bytes each.
SENT_PAIRS = 1 << 18
#: Units remembered by a worker at least (twice as many at most), and the characters of one.
KEPT, KEPT_CHARS = 120_000, 48

#: Numbers of tokens of A and B and of groups, the groups as text, the linked id pairs (64-bit numbers).
Unit = tuple[int, int, int, str, bytes]

# A blank after anything but a blank and before anything but white space: both tokenizers begin a token there.
_CUT = re.compile(r"(?<=[^ ]) (?=\S)")


def runs(ends_a: list[int], ends_b: list[int]) -> Iterator[tuple[int, int, int, int]]:
    """Stretches ``(i, k, j, l)`` of tokens ``i..k`` of A and ``j..l`` of B that begin and end together: one-to-one
    stretches (as many groups as tokens), and single groups in which the tokens don't go one to one."""
    i = j = 0
    n, m = len(ends_a), len(ends_b)
    while i < n:
        start = i
        if ends_a[i] == ends_b[j]:
            i, j, w = i + 1, j + 1, 1
            while i < n and ends_a[i : i + w] == ends_b[j : j + w]:
                i, j, w = min(i + w, n), min(j + w, m), w * 2
            while w > 1:  # the stretch of w differs somewhere: its first half, then a half of the rest
                w //= 2
                if i < n and ends_a[i : i + w] == ends_b[j : j + w]:
                    i, j = min(i + w, n), min(j + w, m)
            yield start, i, j - (i - start), j
            if i >= n:
                return
        start, first = i, j
        x, y = ends_a[i], ends_b[j]
        while x != y:
            if x < y:
                i += 1
                x = ends_a[i]
            else:
                j += 1
                y = ends_b[j]
        i, j = i + 1, j + 1
        yield start, i, first, j


class Pair:
    """Both tokenizers, with the bytes of their ids, and the units they have aligned lately.

    No token of either reaches over a single blank between words, so groups don't either: texts are aligned in units
    between such blanks, and a unit that was seen lately is not aligned again."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = _byte_level(self.a.get_vocab(with_added_tokens=True))
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [_piece(p) for p in pieces]
        self.names_a = [str(i) for i in range(len(self.bytes_a))]
        self.names_b = [str(i) for i in range(len(self.bytes_b))]
        self.lengths_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.lengths_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # Without pieces that reach over a blank, units between blanks can be encoded one by one.
        self.by_unit = not any("▁" in p.lstrip("▁") or (p.startswith("▁▁") and p.strip("▁")) for p in pieces) and _cuts_at_blanks(path_a)
        self.young: dict[str, Unit | None] = {}
        self.old: dict[str, Unit | None] = {}

    def _learn(self, units: list[str], into: dict[str, Unit | None]) -> None:
        """Align new units: those that a blank before and after sets apart as one text, cut again where they end."""
        apart = [u for u in units if not u[0].isspace() and u[-1] != " "]
        for u in set(units).difference(apart):
            into.update(self._together([u]))
        waiting = [apart] if apart else []
        while waiting:
            part = waiting.pop()
            found = self._together(part)
            if found is not None:
                into.update(found)
            else:  # some unit's tokens don't give back its bytes
                waiting += [part[: len(part) // 2], part[len(part) // 2 :]]

    def _together(self, units: list[str]) -> dict[str, Unit | None] | None:
        """The parts of an alignment of all ``units`` in one text; None where it is not possible for all. A single unit always has a result."""
        text = " ".join(units)
        (encoding,), b = self.a.encode_batch_fast([" " + text], add_special_tokens=False), self.b.encode(text)
        a, whole = encoding.ids, (" " + text).encode()
        if b"".join([self.bytes_a[x] for x in a]) != whole or b"".join([self.bytes_b[x] for x in b]) != whole:
            return {units[0]: None} if len(units) == 1 else None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        groups, ends, links_a, links_b, ends_a, ends_b = align(a, b, self)
        keys = a[links_a] * len(self.bytes_b) + b[links_b]
        stops = np.cumsum([len(u.encode()) + 1 for u in units])
        at, at_a, at_b = (np.searchsorted(x, stops) for x in (ends, ends_a, ends_b))
        if (at == len(ends)).any() or (np.asarray(ends)[at] != stops).any():
            return None
        link = np.searchsorted(np.asarray(ends_a)[links_a], stops, side="right")
        out, g, x, y, k = {}, 0, 0, 0, 0
        for u, g1, x1, y1, k1 in zip(units, (at + 1).tolist(), (at_a + 1).tolist(), (at_b + 1).tolist(), link.tolist()):
            out[u] = (x1 - x, y1 - y, g1 - g, ";".join(groups[g:g1]), keys[k:k1].tobytes())
            g, x, y, k = g1, x1, y1, k1
        return out

    def align(self, texts: list[str]) -> list[Unit | None]:
        """The alignment of each text; None for an empty text and where bytes differ."""
        split = [_CUT.split(" " + t) if self.by_unit else [" " + t] for t in texts]
        for units in split:
            units[0] = units[0][1:]
        missing = set(chain.from_iterable(split)).difference(self.young)
        missing.discard("")
        known = missing.intersection(self.old)
        self.young.update((u, self.old[u]) for u in known)
        missing -= known
        long = [u for u in missing if len(u) > KEPT_CHARS]
        self._learn(list(missing.difference(long)), self.young)
        for u in long:
            self.young.update(self._together([u]))
        young, out = self.young, []
        for text, units in zip(texts, split):
            found = list(map(young.__getitem__, units)) if text else [None]
            if None in found:
                out.append(None)
            else:
                n_a, n_b, n, said, keys = zip(*found)
                out.append((sum(n_a), sum(n_b), sum(n), ";".join(said), b"".join(keys)))
        for u in long:
            del young[u]
        if len(young) > KEPT:
            self.young, self.old = {}, young
        return out


def _byte_level(vocabulary: dict[str, int]) -> list[bytes]:
    """Bytes of the entries of a byte-level vocabulary: printable Latin characters stand for themselves, the other
    bytes, in order, for the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    byte = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}
    out = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        out[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
    return out


def _piece(piece: str) -> bytes:
    if re.fullmatch("<0x[0-9A-F]{2}>", piece):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


def _cuts_at_blanks(path: str) -> bool:
    """Whether the tokenizer splits texts by the usual pattern, in which a blank before a word begins a part."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    split = spec["pre_tokenizer"] or {}
    return spec["normalizer"] is None and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")


@lru_cache(1)
def _pair(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


def align(a: np.ndarray, b: np.ndarray, pair: Pair) -> tuple[list[str], list[int], list[int], list[int], list[int], list[int]]:
    """Groups of one text, each as ``a1,a2|b1``, and their ends; the places of linked tokens in A and B; the ends of tokens."""
    ends_a, ends_b = np.cumsum(pair.lengths_a[a]).tolist(), np.cumsum(pair.lengths_b[b]).tolist()
    said_a, said_b = [pair.names_a[x] for x in a.tolist()], [pair.names_b[x] for x in b.tolist()]
    groups: list[str] = []
    ends: list[int] = []
    links_a: list[int] = []
    links_b: list[int] = []
    for i, k, j, l in runs(ends_a, ends_b):
        if ends_a[i] == ends_b[j]:  # one to one
            groups.extend(map("|".join, zip(said_a[i:k], said_b[j:l])))
            ends.extend(ends_a[i:k])
            links_a.extend(range(i, k))
            links_b.extend(range(j, l))
            continue
        groups.append(",".join(said_a[i:k]) + "|" + ",".join(said_b[j:l]))
        ends.append(ends_a[k - 1])
        while True:
            links_a.append(i)
            links_b.append(j)
            if ends_a[i] < ends_b[j]:
                i += 1
            elif j + 1 < l:
                j += 1
            else:
                break
    return groups, ends, links_a, links_b, ends_a, ends_b


def _aligned(path_a: str, path_b: str):
    def run(rows: list[dict]) -> Iterator[tuple]:
        pair = _pair(path_a, path_b)
        for row, found in zip(rows, pair.align([r["text"] or "" for r in rows])):
            if found is None:
                yield row["doc_id"], 0, 0, 0, "", [], []
                continue
            *counts, groups, keys = found
            pairs, times = np.unique(np.frombuffer(keys, np.int64), return_counts=True)
            yield row["doc_id"], *counts, groups, pairs, times

    return run


def align_tokens(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): ``n_a``, ``n_b``, ``n_groups``, ``groups`` (all ids, as ``a1,a2|b1;a3|b2,b3``), and
    the distinct linked id pairs with how often each is linked (``pairs``: A's id times B's vocabulary plus B's id; ``times``).

    A encodes a blank and the text, B the text, to which it adds the blank itself; special tokens' strings are
    plain text. A null or empty text, and one whose tokens don't give back the bytes, has no tokens, groups or links.
    Other columns are left out; rows without an id or with a repeated one are rows like others; no rows, no result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return per_rows(rows, _aligned(path_a, path_b), "doc_id long, n_a long, n_b long, n_groups long, groups string, pairs array<long>, times array<int>")


def count_pairs(aligned: DataFrame, vocabulary_b: int) -> DataFrame:
    """Corpus-wide counts of linked id pairs: ``pair``, ``count``, ``best`` (its count is the highest of its B id)."""
    each = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).select(F.col("x.pairs").alias("pair"), F.col("x.times").alias("n"))
    counts = written(each.groupBy("pair").agg(F.sum("n").alias("count")), "pair-counts").withColumn("b", F.col("pair") % vocabulary_b)
    highest = counts.groupBy("b").agg(F.max("count").alias("most"))  # a row per id of B
    return counts.join(highest, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


_RATED = "row long, n_best long, count_sum long, pairs array<long>, times array<int>"


def _rated(shared):
    """Sums over the pairs whose counts were sent; the other pairs are passed on."""
    arrow = arrow_schema(_RATED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, best = shared.value
        for batch in batches:
            rows = batch.column("row").to_pylist()
            lists = batch.column("pairs")
            sizes = np.diff(lists.offsets.to_numpy())
            pairs = lists.flatten().to_numpy().astype(np.int64)
            times = batch.column("times").flatten().to_numpy().astype(np.int64)
            owner = np.repeat(np.arange(len(rows)), sizes)
            at = np.searchsorted(keys, pairs)
            hit = keys[np.minimum(at, len(keys) - 1)] == pairs if len(keys) else np.zeros(len(pairs), bool)
            total, good = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
            np.add.at(total, owner[hit], times[hit] * counts[at[hit]])
            np.add.at(good, owner[hit], times[hit] * best[at[hit]])
            rest = np.bincount(owner[~hit], minlength=len(rows))
            cuts = np.cumsum(rest)[:-1]
            columns = zip(rows, good.tolist(), total.tolist(), np.split(pairs[~hit], cuts), np.split(times[~hit], cuts))
            if rows:
                yield record_batch(list(columns), arrow)

    return run


def rate_links(aligned: DataFrame, counts: DataFrame, sent: int = SENT_PAIRS) -> DataFrame:
    """Per row of ``aligned`` (``row``, ``pairs``, ``times``): ``n_best``, its links whose pair is a best one of its B id,
    and ``count_sum``, the counts of the pairs of all its links."""
    counts = written(counts, "rated-pairs")
    top = counts.orderBy(F.desc("count"), "pair").limit(sent).toPandas().sort_values("pair")
    context = aligned.sparkSession.sparkContext
    shared = context.broadcast((top["pair"].to_numpy(np.int64), top["count"].to_numpy(np.int64), top["best"].to_numpy(np.int64)))
    rated = written(aligned.select("row", "pairs", "times").mapInArrow(_rated(shared), _RATED), "rated-links")
    rest = rated.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("n"))
    more = join_many_facts(rest, counts, ["pair"]).groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("b"), F.sum(F.col("n") * F.col("count")).alias("c"))
    joined = rated.drop("pairs", "times").join(more, "row", "left")
    return joined.select("row", (F.col("n_best") + F.coalesce("b", F.lit(0))).alias("n_best"), (F.col("count_sum") + F.coalesce("c", F.lit(0))).alias("count_sum"))


def describe(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, sent: int = SENT_PAIRS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``,
    ``groups_sha256`` ('' without tokens)."""
    path_a = path_a or public_tokenizers.path("byte_bpe_50k.json")
    path_b = path_b or public_tokenizers.path("piece_bpe_32k.model")
    vocabulary_b = len(_pair(path_a, path_b).bytes_b)
    whole = align_tokens(docs, path_a, path_b).select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        F.aggregate("times", F.lit(0).cast("long"), lambda x, y: x + y).alias("n_links"),
        F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256"),
        "pairs",
        "times",
    )
    aligned = written(whole, "aligned")
    rated = rate_links(aligned, count_pairs(aligned, vocabulary_b), sent)
    return aligned.join(rated, "row").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
