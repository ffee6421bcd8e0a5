"""Language of whole texts: known words first, character n-grams for the rest.

A word that the model knows counts with its smoothed log frequency in each language. A word it does
not know is scored by its character n-grams: the longest length at which any n-gram is known is
used, so it falls back from 5 characters to 1. Long runs of letters, as of scripts without blanks, are
read piece by piece.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import written
from .common import SLICE, held_out, per_rows, unused

UNKNOWN = "und"
#: Labelled documents learned from, about: as many of every language as it has, up to an equal share (``LEAST`` at least).
SAMPLE, LEAST = 20_000, 500
#: Words and n-grams (per length) remembered per language, at most; the most frequent stay.
WORDS = 20_000
GRAMS = 6_000
LONGEST = 5
#: Longest piece of a run of letters that counts as a word; pieces overlap so that no n-gram is cut.
PIECE = 64
_RUN = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Runs of letters, lower-cased. Number signs count as word characters, so a run must hold a letter."""
    return [w for w in _RUN.findall(text.lower()) if w.isalpha() or any(map(str.isalpha, w))]


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    words: dict[str, tuple[float, ...]]
    grams: dict[str, tuple[float, ...]]


def pieces(word: str) -> list[str]:
    """A word as it is, or the overlapping pieces of a long run of letters."""
    if len(word) <= PIECE:
        return [word]
    return [word[i : i + PIECE] for i in range(0, len(word) - LONGEST + 1, PIECE - LONGEST + 1)]


def _sample(docs: DataFrame, learn: Column) -> DataFrame:
    """About ``SAMPLE`` labelled rows, an equal share of every language (all rows of a rarer one): those whose hash lies
    below a bound that follows from their language's number. Only ids and labels are read to count them."""
    labelled = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    found = labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()  # a row per language
    if not found:
        return labelled.select("lang", F.col("text").cast("string").alias("text"))
    share = max(LEAST, SAMPLE // len(found))
    bounds = F.create_map(*(F.lit(x) for r in found for x in (r.lang, int((1 << 30) * min(1.0, share / r.n)))))
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.xxhash64("text")), F.lit(1 << 30))
    return labelled.filter(place < bounds[F.col("lang")]).select("lang", F.col("text").cast("string").alias("text"))


def _words(rows: list[dict]) -> Iterator[tuple]:
    counts: Counter = Counter()
    for row in rows:
        for word, n in Counter(words_of(row["text"])).items():
            for piece in pieces(word):
                counts[row["lang"], piece] += n
    for (lang, word), n in counts.items():
        yield lang, word, n


def _grams(rows: list[dict]) -> Iterator[tuple]:
    counts: Counter = Counter()
    for row in rows:
        for gram in grams(row["piece"]):
            counts[row["lang"], len(gram), gram] += row["n"]
    for (lang, length, gram), n in counts.items():
        yield lang, length, gram, n


def grams(word: str) -> list[str]:
    """All n-grams of a word with its ends marked, longest first."""
    marked = f"\x02{word}\x03"
    return [marked[i : i + n] for n in range(LONGEST, 0, -1) for i in range(len(marked) - n + 1)]


def _logs(pieces: dict[str, dict[str, int]], languages: tuple[str, ...], totals: dict[str, int], kinds: int) -> dict[str, tuple[float, ...]]:
    """Log frequency per language with half a count added."""
    return {p: tuple(math.log((by.get(x, 0) + 0.5) / (totals.get(x, 0) + 0.5 * kinds + 1)) for x in languages) for p, by in pieces.items()}


def learn(docs: DataFrame, rows: Column) -> Model:
    """Learn from the labelled rows of ``docs`` that ``rows`` marks. Counting runs in Spark; what comes
    back is bounded by ``WORDS`` and ``GRAMS`` per language, whatever the size of the table."""
    words = written(per_rows(_sample(docs, rows), _words, "lang string, piece string, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n")), "words")
    spelled = per_rows(words, _grams, "lang string, length int, piece string, n long").groupBy("lang", "length", "piece").agg(F.sum("n").alias("n"))
    counts = words.select("lang", F.lit(0).alias("length"), "piece", "n").unionAll(spelled)
    rank = F.row_number().over(W.partitionBy("lang", "length").orderBy(F.desc("n"), "piece"))
    top = counts.withColumn("rank", rank).filter(F.when(F.col("length") == 0, F.col("rank") <= WORDS).otherwise(F.col("rank") <= GRAMS))
    seen: dict[int, dict[str, dict[str, int]]] = {}
    total: dict[int, Counter] = {}
    for r in top.select("lang", "length", "piece", "n").toLocalIterator():
        seen.setdefault(r.length, {}).setdefault(r.piece, {})[r.lang] = r.n
        total.setdefault(r.length, Counter())[r.lang] += r.n
    by_words = total.get(0, Counter())
    languages = tuple(sorted(by_words))
    known_words = _logs(seen.get(0, {}), languages, by_words, len(seen.get(0, {})))
    known = {}
    for length in range(1, LONGEST + 1):
        known |= _logs(seen.get(length, {}), languages, total.get(length, Counter()), len(seen.get(length, {})))
    return Model(languages, known_words, known)


def backoff(word: str, model: Model) -> tuple[float, ...] | None:
    """Score of an unseen word: the mean over its known n-grams of the longest length that has any."""
    marked = f"\x02{word}\x03"
    known = model.grams
    for n in range(LONGEST, 0, -1):
        found = [known[g] for g in (marked[i : i + n] for i in range(len(marked) - n + 1)) if g in known]
        if found:
            return tuple(sum(c) / len(found) for c in zip(*found))
    return None


def predict(text: str | None, model: Model, memo: dict | None = None) -> tuple[str, float]:
    """The language and its probability; ``und`` and 0 for a text without a letter.

    Scores are summed over all words and tempered to the power 1 / sqrt(words), so the
    probability doesn't run to 1 with the mere length of a text.
    """
    counts = Counter(words_of(text)) if text else None
    if not counts or not model.languages:
        return UNKNOWN, 0.0
    memo = {} if memo is None else memo
    words = model.words
    total, n = [0.0] * len(model.languages), 0
    for run, times in counts.items():
        for word in pieces(run) if len(run) > PIECE else (run,):
            scores = words.get(word)
            if scores is None:
                if word in memo:
                    scores = memo[word]
                else:
                    scores = memo[word] = backoff(word, model)
            if scores is not None:
                n += times
                for i, s in enumerate(scores):
                    total[i] += times * s
    if not n:
        return UNKNOWN, 0.0
    best = max(range(len(total)), key=lambda i: (total[i], -i))
    temper = math.sqrt(n)
    return model.languages[best], 1 / sum(math.exp(max(-700.0, (t - total[best]) / temper)) for t in total)


#: Unseen words whose scores a worker remembers, at most.
_MEMO = 50_000


def tag(docs: DataFrame, model: Model, into: str) -> DataFrame:
    """Add the struct ``into`` with ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    memo: dict = {}

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def found(texts: pa.Array) -> pa.Array:
        judged = []
        for at in range(0, len(texts), SLICE):  # a slice of texts at a time as Python values
            if len(memo) > _MEMO:
                memo.clear()
            judged += [predict(t, shared.value, memo) for t in texts.slice(at, SLICE).to_pylist()]
        return pa.StructArray.from_arrays([pa.array([x for x, _ in judged], pa.string()), pa.array([y for _, y in judged], pa.float64())], ["lang_pred", "score"])

    return docs.withColumn(into, found(F.col("text").cast("string")))


def identify(docs: DataFrame, learned: Column | None = None) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (0 to 1) per row of ``docs`` (``doc_id``, ``text``, ``lang``), learned
    from the rows that ``learned`` marks (by default those that are not held out).

    Null, empty and letterless texts are ``und`` with score 0, as is every text where nothing could be
    learned. Rows without an id or with a repeated one are predicted like any other; a null language
    teaches nothing. Only the text goes into a prediction. Apart from the bounded sample that is
    learned from, the work is map-only.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    known = tag(rows, learn(rows, ~held_out("doc_id") if learned is None else learned), "found")
    return known.select("doc_id", held_out("doc_id").alias("held_out"), "found.lang_pred", "found.score")


#: Texts whose language is less probable than this are rejected: such a text mixes languages or is in none.
LEAST_SCORE = 0.5


def accept(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose language is rejected: ``und``, or a score below ``LEAST_SCORE``.
    Where no language could be learned nothing is rejected but texts without a letter."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    model = learn(rows, ~held_out("doc_id"))
    if not model.languages:
        return docs.filter(F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False)))
    found = unused(docs, "found")
    known = tag(docs, model, found)
    return known.filter((F.col(f"{found}.lang_pred") != UNKNOWN) & (F.col(f"{found}.score") >= LEAST_SCORE)).drop(found)
