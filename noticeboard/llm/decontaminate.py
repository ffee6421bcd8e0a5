"""Benchmark items in documents, re-parameterised ones included.

Texts become templates: numbers, names and units give way to typed placeholders. Windows of eight
template tokens are hashed and joined with those of the benchmark. What stood in the slots is then
compared: along one alignment every benchmark value must stand for one value of the document and the
other way round. Windows with a value that breaks this don't count; windows that are equal word for word,
upper and lower case aside, always do. A document is contaminated by an item if enough of the item's windows
match so, or a long enough run of them.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .common import per_rows

WINDOW = 8
#: A window with fewer plain words than this is compared word by word: placeholders alone say little.
PLAIN = 3
#: Items of fewer tokens are only compared with whole documents.
SHORTEST = 4
COVERAGE = 0.5
#: Running tokens of an item that make a leak, whatever their share of the item.
RUN = 16
#: Bits of the filter that spares windows the join. Its size does not depend on the benchmark's; a
#: benchmark beyond some millions of windows lets more windows pass, and the join still decides.
FILTER_BITS = 1 << 24

# Units that count as such after a number.
_UNITS = frozenset(
    "mm cm m km inch inches ft feet yard yards mile miles mg g kg lb lbs oz pound pounds ton tons gram grams ml l liter liters litre litres "
    "s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years meter meters metre metres "
    "dollar dollars cent cents euro euros usd eur percent % degree degrees °c °f mph kmh km/h w kw kwh v hz gb mb tb".split()
)
# Numbers in words.
_SPELLED = frozenset(
    "zero two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty "
    "forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
)
_NUMBER = re.compile(r"[+-]?[$€£]?[0-9](?:[0-9.,:/]*[0-9])?%?")
_EDGE = re.compile(r"^[^\w$€£%°+-]+|[^\w%°]+$")
_GLUED = re.compile(r"(?<=[0-9])(?=[A-Za-z°%])")
_HAS_GLUED = re.compile(r"[0-9][A-Za-z°%]")
_ENDS = re.compile(r"[.!?:]['\")\]]*$")

_EMPTY, _END, _NUM, _UNIT, _CAPITAL = 1, 2, 4, 8, 16
_DIGEST = xxhash.xxh64_intdigest
_PLACEHOLDERS = {k: _DIGEST(f"<{k}>") for k in ("number", "unit", "name")}
_FACTORS = [pow(0x9E3779B97F4A7C15, j + 1, 1 << 64) for j in range(WINDOW)]


class _Codes(dict):
    """Numbers of words; an unknown word gets one."""

    def __init__(self, new) -> None:
        super().__init__()
        self.new = new

    def __missing__(self, word: str) -> int:
        return self.new(word)


class Words:
    """What a word can stand for, worked out once per word as long as it is remembered."""

    KEPT = 150_000

    def __init__(self) -> None:
        self.codes = _Codes(self.code)
        self.cores: list[str] = []
        self.hashes, self.flags = array("Q"), array("B")

    def code(self, word: str) -> int:
        core, flags = word, 0
        if not word.isalpha():
            core = _EDGE.sub("", word)
            flags = _END if _ENDS.search(word) else 0
            if not core:
                flags |= _EMPTY
            elif not core[0].isalpha() and _NUMBER.fullmatch(core):
                flags |= _NUM
        lower = core.lower()
        if lower in _SPELLED:
            flags |= _NUM
        if lower in _UNITS:
            flags |= _UNIT
        if core != lower and core[0].isupper():
            flags |= _CAPITAL
        at = self.codes[word] = len(self.cores)
        self.cores.append(lower)
        self.hashes.append(_DIGEST(lower))
        self.flags.append(flags)
        return at

    def template(self, text: str) -> "Template":
        if len(self.cores) > self.KEPT:
            self.__init__()
        if _HAS_GLUED.search(text):
            text = _GLUED.sub(" ", text)
        words = text.split()
        codes = np.fromiter(map(self.codes.__getitem__, words), np.int64, len(words))
        if len(codes):
            flags, plain = np.frombuffer(self.flags, np.uint8)[codes], np.frombuffer(self.hashes, np.uint64)[codes]
        else:
            flags, plain = np.zeros(0, np.uint8), np.zeros(0, np.uint64)
        # A sentence begins with the first word after the end of another.
        filled = (flags & _EMPTY) == 0
        words_before = np.cumsum(filled)
        first = np.zeros(len(codes) + 1, bool)
        first[0] = True
        first[words_before[(flags & _END) > 0]] = True
        codes, flags, plain, begins = codes[filled], flags[filled], plain[filled], first[: int(filled.sum())]
        number = (flags & _NUM) > 0
        unit = ((flags & _UNIT) > 0) & np.concatenate(([False], number[:-1])) if len(codes) else number
        name = ((flags & _CAPITAL) > 0) & ~begins & ~number & ~unit
        return Template(codes, plain, number, unit, name, self)


def _finished(h: np.ndarray, length: int) -> np.ndarray:
    h = h + np.uint64(length)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


class Template:
    """The tokens of a text: their plain hashes and what is a number, a unit or a name."""

    def __init__(self, codes, plain, number, unit, name, words: Words) -> None:
        self.codes, self.plain, self.slots, self.words = codes, plain, number | unit | name, words
        self.typed = plain.copy()
        for kind, mask in (("number", number), ("unit", unit), ("name", name)):
            self.typed[mask] = _PLACEHOLDERS[kind]

    def __len__(self) -> int:
        return len(self.codes)

    def both(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of every window of ``length`` tokens, word by word and with placeholders, and where the
        latter say more: windows with a placeholder and enough plain words."""
        n = len(self) - length + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, bool)
        typed, plain = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        for j in range(length):
            typed += self.typed[j : j + n] * np.uint64(_FACTORS[j])
            plain += self.plain[j : j + n] * np.uint64(_FACTORS[j])
        literal = np.concatenate(([0], np.cumsum(~self.slots)))
        literal = literal[length:] - literal[:-length]
        plain = _finished(plain ^ np.uint64(0x5851F42D4C957F2D), length)
        more = (literal < length) & (literal >= min(PLAIN, length))
        return plain, np.where(literal < min(PLAIN, length), plain, _finished(typed, length)), more

    def windows(self, length: int) -> np.ndarray:
        """Hash of every window of ``length`` tokens."""
        return self.both(length)[1]

    def values(self, at: int, length: int) -> list[str]:
        """What stands in the slots of a window."""
        cores = self.words.cores
        return [cores[self.codes[i]] for i in range(at, at + length) if self.slots[i]]


def _item_length(n: int) -> int:
    """Window length of an item of n tokens."""
    return min(n, WINDOW)


def _signed(h: np.ndarray) -> list[int]:
    return h.view(np.int64).tolist()


def _item_rows(rows: list[dict]) -> Iterator[tuple]:
    words = Words()
    for row in rows:
        t = words.template(row["text"] or "")
        if not len(t):
            continue
        length = _item_length(len(t))
        plain, typed, more = t.both(length)
        whole = len(t) < SHORTEST
        for at, x in enumerate(_signed(plain)):
            yield row["item_id"], x, at, length, whole, len(plain), True, t.values(at, length)
        typed = _signed(typed)
        for at in np.flatnonzero(more).tolist():
            yield row["item_id"], typed[at], at, length, whole, len(plain), False, t.values(at, length)


def _positions(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of the filter that a hash sets."""
    return h & np.uint64(FILTER_BITS - 1), (h >> np.uint64(32)) & np.uint64(FILTER_BITS - 1)


def _bits(rows: list[dict]) -> Iterator[tuple]:
    h = np.array([r["hash"] for r in rows], np.int64).view(np.uint64)
    for p in np.concatenate(_positions(h)).tolist():
        yield p >> 6, (1 << (p & 63)) - ((1 << 64) if p & 63 == 63 else 0)


def _filter(windows: DataFrame) -> np.ndarray:
    """All windows of the benchmark as a bit set, put together in Spark: at most FILTER_BITS / 64 rows come back."""
    cells = per_rows(windows.select("hash"), _bits, "cell long, bits long").groupBy("cell").agg(F.bit_or("bits").alias("bits"))
    out = np.zeros(FILTER_BITS >> 6, np.uint64)
    for r in cells.toLocalIterator():
        out[r.cell] = r.bits & 0xFFFFFFFFFFFFFFFF
    return out


def _passes(h: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Places of the hashes that the filter lets pass."""
    at = np.arange(len(h))
    for p in _positions(h):
        p = p[at]
        at = at[(bits[p >> np.uint64(6)] >> (p & np.uint64(63)) & np.uint64(1)) > 0]
    return at


def find(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, run: int = RUN) -> DataFrame:
    """Contaminated documents: ``doc_id``, ``item_id``, ``matched`` and ``windows`` (of the item),
    ``coverage``, ``verbatim`` (every slot holds the benchmark's own value).

    ``docs`` has ``doc_id`` and ``text``, ``benchmark`` has ``item_id`` and ``text``. Null and empty texts match
    nothing; items of fewer than ``SHORTEST`` tokens only match documents that hold nothing else; items
    shorter than a window are one window. Rows without an id are left out of the result, as nothing could
    name them; repeated rows and items give one row per pair of ids. Equal values in the slots of an item
    must have equal values in the document, different ones different values; windows where they have not don't
    count. A share of ``coverage`` of an item's windows makes a leak, as do ``run`` running tokens of a longer item.
    """
    spark = docs.sparkSession
    items = benchmark.filter(F.col("item_id").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    known = written(per_rows(items, _item_rows, "item_id long, hash long, item_pos int, length int, whole boolean, windows int, plain boolean, item_values array<string>"), "item-windows")
    bits = spark.sparkContext.broadcast(_filter(known))
    short = sorted(r.length for r in known.filter(F.col("length") < WINDOW).select("length").distinct().collect())
    words = None

    def doc_rows(rows: list[dict]) -> Iterator[tuple]:
        nonlocal words
        words = words or Words()
        for row in rows:
            t = words.template(row["text"] or "")
            for length in [*short, WINDOW]:
                if len(t) < length or (length < SHORTEST and len(t) != length):
                    continue
                plain, typed, more = t.both(length)
                for at in _passes(plain, bits.value).tolist():
                    yield row["doc_id"], int(plain[at : at + 1].view(np.int64)[0]), at, length, None
                places = np.flatnonzero(more)
                for at in places[_passes(typed[places], bits.value)].tolist():
                    yield row["doc_id"], int(typed[at : at + 1].view(np.int64)[0]), at, length, t.values(at, length)

    texts = docs.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    seen = per_rows(texts, doc_rows, "doc_id long, hash long, doc_pos int, length int, doc_values array<string>")
    # A window that is equal word for word has the item's own values.
    joined = seen.join(known, ["hash", "length"]).withColumn("doc_values", F.when(F.col("plain"), F.col("item_values")).otherwise(F.col("doc_values")))
    joined = joined.filter(F.size("item_values") == F.size("doc_values")).withColumn("pairs", F.arrays_zip("item_values", "doc_values"))
    aligned = joined.groupBy("doc_id", "item_id", "windows", (F.col("doc_pos") - F.col("item_pos")).alias("shift")).agg(
        F.collect_set(F.struct("item_pos", "pairs")).alias("matches"),
        F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"),
    )

    def breaks(x):
        """Not the item's own value, and not the only pair of its two values."""
        return (x["item_values"] != x["doc_values"]) & (F.size(F.filter("pairs", lambda y: (x["item_values"] == y["item_values"]) | (x["doc_values"] == y["doc_values"]))) > 1)

    torn = aligned.withColumn("torn", F.filter("pairs", breaks))
    consistent = torn.withColumn("matches", F.filter("matches", lambda m: ~F.arrays_overlap(m["pairs"], "torn"))).filter(F.size("matches") > 0)
    consistent = consistent.withColumn("places", F.array_sort(F.array_distinct(F.col("matches.item_pos"))))
    # So many windows in a row are a run of RUN tokens.
    row = max(1, run - WINDOW + 1)
    in_a_row = F.exists(F.sequence(F.lit(1), F.size("places") - (row - 1)), lambda i: F.element_at("places", i + (row - 1)) - F.element_at("places", i) == row - 1)
    consistent = consistent.withColumn("run", F.when(F.size("places") >= row, in_a_row).otherwise(False) & (F.col("windows") >= row))
    matched = F.size(F.array_distinct(F.flatten(F.collect_list("places"))))
    verbatim = F.bool_and(F.forall(F.flatten("matches.pairs"), lambda x: x["item_values"] == x["doc_values"]))
    found = consistent.groupBy("doc_id", "item_id", "windows").agg(matched.alias("matched"), verbatim.alias("verbatim"), F.bool_or("run").alias("run"))
    best = found.withColumn("coverage", F.col("matched") / F.col("windows")).filter((F.col("coverage") >= coverage) | F.col("run"))
    return best.groupBy("doc_id", "item_id").agg(F.max_by(F.struct("matched", "windows", "coverage", "verbatim"), F.struct("coverage", "windows")).alias("b")).select("doc_id", "item_id", "b.matched", "b.windows", "b.coverage", "b.verbatim")


def clean(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """``docs`` without the contaminated documents. Rows without an id stay."""
    leaked = written(find(docs, benchmark, coverage).select("doc_id").distinct(), "leaked")
    return docs.join(leaked, docs["doc_id"].cast("long") == leaked["doc_id"], "left_anti")
