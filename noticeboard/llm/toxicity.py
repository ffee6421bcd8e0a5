"""Toxicity of whole texts by their nearest labelled examples.

Examples and texts are TF-IDF vectors; nearness is their cosine. Terms are the telling words and beginnings
of words, and one more that stands for all the words of a text, so that few telling words among many
others weigh less than among few. The examples
lie in an inverted index whose postings are cut into blocks of examples, each with the largest
weight a term reaches in it. For a text the blocks are taken by their best possible cosine, and the
search ends when no block left can beat the neighbours found: the result is exactly that of
comparing the text with every example. The neighbours vote with their cosine as weight.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import written
from .common import held_out, per_rows

#: Labelled rows learned from, about: those whose id's hash lies below a bound that follows from their number.
SAMPLE = 20_000
#: Rows of the sample that become examples, at most this many per label: those with the smallest hash of their id.
EXAMPLES = 4_000
#: Telling words, at most: those whose odds differ most between the labels.
TERMS = 20_000
#: A word is telling if, with 99 % confidence, its odds differ between the labels by this factor.
ODDS = 3.0
NEIGHBOURS = 15
BLOCK = 512
THRESHOLD = 0.3
#: Words whose terms a worker remembers, at most.
_MEMO = 300_000
_WORD = re.compile(r"[^\W_]+")


#: Lengths of the beginnings of words that are terms.
_BEGINNINGS = range(3, 8)
#: The term for all words, and its weight in place of an IDF: it is in every text.
ALL, ALL_WEIGHT = "", 2.0


def words(text: str | None) -> Counter:
    return Counter(_WORD.findall(text.lower())) if text else Counter()


def terms(word: str) -> list[str]:
    """A word and its beginnings, which end in a hyphen."""
    return [word, *(word[:n] + "-" for n in _BEGINNINGS if len(word) > n)]


def _presence(rows: list[dict]) -> Iterator[tuple]:
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for row in rows:
        counts[row["toxic"]].update({t for w in words(row["text"]) for t in terms(w)})
    for toxic in (0, 1):
        for t, n in counts[toxic].items():
            yield t, toxic, n


def telling(labelled: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """``word`` and in how many toxic (``a``) and clean (``b``) rows it is, for the terms whose log odds ratio is
    surely beyond ``ODDS``. Counted per slice of rows first, then by term."""
    counts = per_rows(labelled, _presence, "word string, toxic int, n long").groupBy("word").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("b")
    )
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    c, d = F.lit(sizes.get(1, 0) + 0.5) - F.col("a"), F.lit(sizes.get(0, 0) + 0.5) - F.col("b")
    odds = F.abs(F.log(a * d / (b * c)))
    sure = odds - 2.576 * F.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
    return counts.withColumn("sure", sure).filter(F.col("sure") > math.log(ODDS)).orderBy(F.desc("sure"), "word").limit(TERMS)


@dataclass(frozen=True)
class Index:
    """Examples in blocks. ``postings``: per term the examples' places and weights, by place;
    ``peaks``: per term and block the largest weight."""

    idf: dict[str, tuple[int, float]]
    ids: np.ndarray
    toxic: np.ndarray
    postings: list[tuple[np.ndarray, np.ndarray]]
    bounds: list[np.ndarray]  # per term: where each block's postings begin
    peaks: np.ndarray
    prior: float
    worth: np.ndarray  # per example the labelled rows it stands for
    calibration: tuple[float, ...]

    @property
    def blocks(self) -> int:
        return self.peaks.shape[1]


def vector(counts: Counter, idf: dict[str, tuple[int, float]], memo: dict[str, tuple[str, ...]] | None = None) -> list[tuple[int, float]]:
    """(1 + log tf) * idf over the known terms, of length 1. ``memo`` remembers the known terms of words."""
    memo = {} if memo is None else memo
    tf: Counter = Counter()
    for w, n in counts.items():
        known = memo.get(w)
        if known is None:
            known = memo[w] = tuple(t for t in terms(w) if t in idf)
        for t in known:
            tf[t] += n
    if counts:
        tf[ALL] = sum(counts.values())
    found = [(idf[t][0], (1 + math.log(n)) * idf[t][1]) for t, n in tf.items() if t in idf]
    norm = math.sqrt(sum(x * x for _, x in found))
    return sorted((t, x / norm) for t, x in found) if norm else []


def _hashed(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode())


def build(idf: dict[str, tuple[int, float]], examples: list[tuple[int, int, list[tuple[int, float]]]], prior: float, worth: dict[int, float]) -> Index:
    """Index (id, label, vector) rows; ``worth`` says how many labelled rows an example of a label stands for. Examples with the same leading terms lie in the same blocks, which
    keeps the blocks' bounds tight; among those a hash of the id decides, never the label, so of equally near examples a
    blind choice votes."""
    rows = sorted((e for e in examples if e[2]), key=lambda e: (sorted(e[2], key=lambda x: (-x[1], x[0]))[:3], _hashed(e[0])))
    blocks = max(1, -(-len(rows) // BLOCK))
    lists: list[list[tuple[int, float]]] = [[] for _ in idf]
    for place, (_, _, vec) in enumerate(rows):
        for t, x in vec:
            lists[t].append((place, x))
    postings, bounds, peaks = [], [], np.zeros((len(idf), blocks))
    for t, posting in enumerate(lists):
        places, weights = np.array([p for p, _ in posting], np.int64), np.array([x for _, x in posting])
        postings.append((places, weights))
        bounds.append(np.searchsorted(places, np.arange(blocks + 1) * BLOCK))
        np.maximum.at(peaks[t], places // BLOCK, weights)
    index = Index(idf, np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.float64), postings, bounds, peaks, prior, np.array([worth[r[1]] for r in rows]), ())
    return replace(index, calibration=_calibrate(index, rows))


def nearest(vec: list[tuple[int, float]], index: Index, k: int = NEIGHBOURS, but: int | None = None) -> list[tuple[float, int]]:
    """The k examples of largest cosine above zero: (cosine, place), nearest first. Of examples as near as the
    last one any may be left out; those kept stand by place."""
    if not vec or not len(index.ids):
        return []
    weights = np.array([x for _, x in vec])
    best = weights @ index.peaks[[t for t, _ in vec]]
    found: list[tuple[float, int]] = []
    floor = 0.0  # the cosine to beat
    for block in np.argsort(-best, kind="stable").tolist():
        if best[block] <= floor + 1e-9 * (floor > 0):
            break
        scores, at = np.zeros(BLOCK), block * BLOCK
        for t, x in vec:
            a, b = index.bounds[t][block], index.bounds[t][block + 1]
            if a < b:
                places, values = index.postings[t]
                scores[places[a:b] - at] += x * values[a:b]
        if but is not None and 0 <= but - at < BLOCK:
            scores[but - at] = 0
        hits = np.flatnonzero(scores > floor)
        if len(hits) > k:
            hits = hits[np.argpartition(-scores[hits], k - 1)[:k]]
        found += zip(scores[hits].tolist(), (hits + at).tolist())
        if len(found) >= k:
            found = sorted(found, key=lambda s: (-s[0], s[1]))[:k]
            floor = found[-1][0]
    return sorted(found, key=lambda s: (-s[0], s[1]))


def _vote(found: list[tuple[float, int]], index: Index) -> float:
    """Share of toxic neighbours, weighted by cosine, with the prior as one more weak neighbour."""
    if not found:
        return index.prior
    weights = [s * index.worth[p] for s, p in found]
    return (sum(w * index.toxic[p] for w, (_, p) in zip(weights, found)) + 0.05 * index.prior) / (sum(weights) + 0.05)


_BINS = 10


def _calibrate(index: Index, rows: list) -> tuple[float, ...]:
    """Observed toxic share per tenth of the vote, each example judged by the others; made rising."""
    hits, seen = [0.0] * _BINS, [0.0] * _BINS
    for place in range(0, len(rows), max(1, len(rows) // 2000)):
        b = min(_BINS - 1, int(_vote(nearest(rows[place][2], index, but=place), index) * _BINS))
        hits[b] += index.toxic[place] * index.worth[place]
        seen[b] += index.worth[place]
    shares = [(h + (i + 0.5) / _BINS) / (n + 1) for i, (h, n) in enumerate(zip(hits, seen))]
    return tuple(max(shares[: i + 1]) for i in range(_BINS))


def score(found: list[tuple[float, int]], index: Index) -> float:
    """The vote, averaged with what examples of such a vote turned out to be; the prior without neighbours."""
    if not found:
        return index.prior
    vote = _vote(found, index)
    return (vote + index.calibration[min(_BINS - 1, int(vote * _BINS))]) / 2


def learn(docs: DataFrame, labels: DataFrame, rows: Column) -> Index:
    """Build the index from about ``SAMPLE`` of the labelled rows that ``rows`` marks; the examples are bounded by
    ``EXAMPLES`` per label, the terms by ``TERMS``. The sample's ids are few at any size, so they go to the texts
    and no text is moved."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    once = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).filter(rows)
    n = once.count()
    chosen_ids = once.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE / max(1, n))))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    labelled = written(texts.join(F.broadcast(chosen_ids), "doc_id"), "labelled")
    sizes = {r.toxic: r.n for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    chosen = telling(labelled, sizes).collect()
    total = sum(sizes.values())
    idf = {r.word: (i + 1, math.log((1 + total) / (1 + r.a + r.b)) + 1) for i, r in enumerate(chosen)} | {ALL: (0, ALL_WEIGHT)}
    shared = docs.sparkSession.sparkContext.broadcast(idf)

    memo: dict[str, tuple[str, ...]] = {}

    def vectors(part: list[dict]) -> Iterator[tuple]:
        if len(memo) > _MEMO:
            memo.clear()
        for row in part:
            vec = vector(words(row["text"]), shared.value, memo)
            yield row["doc_id"], row["toxic"], [t for t, _ in vec], [x for _, x in vec]

    # Vectors are narrow, so drawing by the smallest hash moves little; a task keeps EXAMPLES rows per label at most.
    every = per_rows(labelled, vectors, "doc_id long, toxic int, terms array<int>, weights array<double>")
    rank = F.row_number().over(W.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id"))
    sample = every.withColumn("rank", rank).filter(F.col("rank") <= EXAMPLES)
    examples = [(r.doc_id, r.toxic, list(zip(r.terms, r.weights))) for r in sample.toLocalIterator()]
    drawn = Counter(e[1] for e in examples)
    worth = {t: sizes.get(t, 0) / max(1, drawn[t]) for t in (0, 1)}
    return build(idf, examples, (sizes.get(1, 0) + 0.5) / (total + 5), worth)


def assess(docs: DataFrame, index: Index, k: int = NEIGHBOURS) -> DataFrame:
    """``doc_id``, ``score``, ``predicted`` and ``evidence`` (ids of the nearest examples) per row."""
    shared = docs.sparkSession.sparkContext.broadcast(index)
    memo: dict[str, tuple[str, ...]] = {}
    # Texts without a telling term all have one vector, and so one answer.
    plain = nearest([(0, 1.0)], index, k)

    def judge(rows: list[dict]) -> Iterator[tuple]:
        index = shared.value
        if len(memo) > _MEMO:
            memo.clear()
        for row in rows:
            vec = vector(words(row["text"]), index.idf, memo)
            found = plain if len(vec) == 1 and vec[0][0] == 0 else nearest(vec, index, k)
            value = min(1.0, max(0.0, score(found, index)))
            yield row["doc_id"], row["held_out"], value, int(value >= THRESHOLD), [int(index.ids[p]) for _, p in found[:5]]

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id").alias("held_out"), F.col("text").cast("string").alias("text"))
    return per_rows(rows, judge, "doc_id long, held_out boolean, score double, predicted int, evidence array<long>")


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every row of ``docs`` (``doc_id``, ``text``), learning from ``labels`` (``doc_id``, ``toxic``)
    of the rows that are not held out.

    A null or empty text, one without a word, and every text where nothing can be learned get the share of
    toxic labels (0.1 of nothing) and no evidence; other texts always have neighbours. Labels other than 0 and 1 and labels without a
    document teach nothing; a document labelled twice counts once, as toxic if any label says so.
    Rows without an id or with a repeated one are scored like any other.
    """
    return assess(docs, learn(docs, labels, ~held_out("doc_id")))
