"""Personal data in whole texts, in plain and in disguised writing.

``find`` gives the plain spans, ``disguised`` those that show only once a text is normalised.
Normalising is done by transducers that keep, for every character they write, the source
characters it stands for, so a span found in the normalised text maps back to the source.
All offsets are code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import covered, per_rows

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A digit run is entered at its start only: a match cannot begin inside one, as each match takes its last run whole.
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """An @ can only follow the run of local characters before it, so every @ is looked at once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        after = at + 1
        if start < at and (found := _DOMAIN.match(text, after)):
            yield start, found.end()
            after = done = found.end()
        at = text.find("@", after)


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])) % 10 == 0


def find(text: str) -> list[tuple[str, int, int]]:
    """Plain spans (kind, start, end) by kind as listed, then start."""
    spans = [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            spans.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _NO_DIGIT.sub("", m[0])
        if 13 <= len(digits) <= 19 and _luhn(digits):
            spans.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_NO_DIGIT.sub("", m[0])) <= 15:
            spans.append(("phone", *m.span()))
    return spans


# Letters of other scripts that look like Latin ones, in the order of the pairs.
_LOOKALIKES = dict(zip("аеіјорсухѕԁһӏАВЕІЈКМНОРСТУХЅαικνορυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aeijopcyxsdhlABEIJKMHOPCTYXSaikvopuxABEZHIKMNOPTYX"))
# Characters that show nothing, and dashes.
_UNSEEN = "­​‌‍⁠﻿"
_DASHES = "‐‑‒–—−"
# Spelled digits and the ends of addresses that are taken after bare "at" and "dot".
_SPELLED = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}
_ENDINGS = ("com", "org", "net", "edu", "gov", "info", "io", "co", "de", "fr", "es", "uk", "eu")


def _single(code: int) -> str:
    """What a character outside ASCII is read as: one ASCII character, nothing, or itself."""
    c = chr(code)
    if c in _UNSEEN:
        return ""
    if c in _DASHES:
        return "-"
    if c in _LOOKALIKES:
        return _LOOKALIKES[c]
    if unicodedata.category(c) == "Nd":
        return str(unicodedata.digit(c))
    plain = unicodedata.normalize("NFKC", c)
    return plain if len(plain) == 1 and "!" <= plain <= "~" else c


_FOLDED = {code: _single(code) for code in range(0x80, 0x20000) if _single(code) != chr(code)}
_FOLDED_CHARACTERS = frozenset(map(chr, _FOLDED))

_DIGIT = "(?:" + "|".join(_SPELLED) + ")"
_SPELLED_RUN = re.compile(rf"\b(?:plus[\x20,-]+)?{_DIGIT}(?:(?:[\x20,-]+|[\x20]+(?:dot|point)[\x20]+){_DIGIT})+\b", re.I | re.A)
_SPELLED_PART = re.compile(rf"plus|dot|point|{_DIGIT}", re.I | re.A)
_AT = re.compile(r"\s{0,3}[\[({<]\s{0,3}(?:at|@)\s{0,3}[\])}>]\s{0,3}", re.I)
_DOT = re.compile(r"\s{0,3}[\[({<]\s{0,3}(?:dot|\.)\s{0,3}[\])}>]\s{0,3}", re.I)
_BARE = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}(?P<at>\x20at\x20)(?P<rest>[A-Za-z0-9-]{1,63}(?:(?:\x20dot\x20|\.)[A-Za-z0-9-]{1,63}){0,4}(?:\x20dot\x20|\.)(?:" + "|".join(_ENDINGS) + r"))(?![A-Za-z0-9])",
    re.I,
)
_BARE_DOT = re.compile(r"\x20dot\x20", re.I)
_BRACKETED = re.compile(r"[\[({<]\s{0,3}(?:at|@|dot|\.)\s{0,3}[\])}>]")
_TWO_DIGITS = re.compile(_DIGIT + r"(?:[\x20,-]+|\x20+(?:dot|point)\x20+)" + _DIGIT + r"(?![a-z0-9_])")
_BARE_AT = re.compile(r"\x20at\x20[a-z0-9-]{1,63}(?:\x20dot\x20|\.)")
# Lower-casing changes these in another way than the patterns, which take them for an i.
_ODD_CASE = frozenset("\u0130\u0131")


def _worth_a_look(text: str) -> bool:
    """A cheap test that every disguise passes."""
    lower = text.lower()
    if " dot " in lower or _BRACKETED.search(lower) or _TWO_DIGITS.search(lower) or (" at " in lower and _BARE_AT.search(lower)):
        return True
    if text.isascii():
        return False
    letters = set(text)
    return not _FOLDED_CHARACTERS.isdisjoint(letters) or not _ODD_CASE.isdisjoint(letters)


class Normalised:
    """A text on its way through transducers: ``text``, and for each character the source span it stands for."""

    def __init__(self, text: str) -> None:
        self.text, self.starts, self.ends = text, list(range(len(text))), list(range(1, len(text) + 1))

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Put each (start, end, replacement) in place; its characters stand for the whole span.
        The edits come by start and don't overlap."""
        if not edits:
            return
        text, starts, ends, done = [], [], [], 0
        for a, b, new in edits:
            text += [self.text[done:a], new]
            starts += self.starts[done:a] + [self.starts[a]] * len(new)
            ends += self.ends[done:a] + [self.ends[b - 1]] * len(new)
            done = b
        self.text = "".join(text) + self.text[done:]
        self.starts, self.ends = starts + self.starts[done:], ends + self.ends[done:]


def _digits(m: re.Match) -> str:
    words = [w.lower() for w in _SPELLED_PART.findall(m[0])]
    return "".join({"plus": "+", "dot": ".", "point": "."}.get(w) or _SPELLED[w] for w in words)


def normalise(text: str) -> Normalised:
    """Homoglyphs, then spelled digits, then "at" and "dot", each as one pass."""
    out = Normalised(text)
    if not text.isascii():
        out.rewrite([(i, i + 1, _FOLDED[ord(c)]) for i, c in enumerate(text) if c in _FOLDED_CHARACTERS])
    out.rewrite([(m.start(), m.end(), _digits(m)) for m in _SPELLED_RUN.finditer(out.text)])
    bracketed = [(m.start(), m.end(), "@") for m in _AT.finditer(out.text)]
    taken = {a for a, _, _ in bracketed}
    bracketed += [(m.start(), m.end(), ".") for m in _DOT.finditer(out.text) if m.start() not in taken]
    edits: list[tuple[int, int, str]] = []
    for edit in sorted(bracketed):
        if not edits or edit[0] >= edits[-1][1]:
            edits.append(edit)
    out.rewrite(edits)
    edits = []
    for m in _BARE.finditer(out.text):
        dots = [i for i in range(*m.span("rest")) if out.text[i] == "."]
        if out.text[m.start() : m.start("at")].isalpha() and not _BARE_DOT.search(m["rest"]) and all(out.ends[i] - out.starts[i] == 1 for i in dots):
            continue  # "met at example.com", with a plain word and plain dots, is prose
        edits.append((*m.span("at"), "@"))
        edits += [(m.start("rest") + d.start(), m.start("rest") + d.end(), ".") for d in _BARE_DOT.finditer(m["rest"])]
    out.rewrite(edits)
    return out


def disguised(text: str, plain: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans that only the normalised text shows; none touches a plain span."""
    if not _worth_a_look(text):
        return []
    normal = normalise(text)
    if normal.text == text:
        return []
    taken = covered([(a, b) for _, a, b in plain])
    ends = [y for _, y in taken]
    found = []
    for kind, a, b in find(normal.text):
        start, end = normal.starts[a], normal.ends[b - 1]
        at = bisect_right(ends, start)  # the first span that ends behind the start
        if text[start:end] != normal.text[a:b] and not (at < len(taken) and taken[at][0] < end):
            found.append((kind, start, end))
    return found


def listed(spans: list[tuple[str, int, int]]) -> str:
    order = {k: i for i, k in enumerate(KINDS)}
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (order[s[0]], s[1], s[2])))


def scan(rows: list[dict]) -> Iterator[tuple]:
    for row in rows:
        text = row["text"] or ""
        plain = find(text)
        hidden = disguised(text, plain)
        counts = [sum(s[0] == k for s in plain) for k in KINDS]
        yield row["doc_id"], *counts, hashlib.sha256(listed(plain).encode()).hexdigest(), listed(plain + hidden), len(hidden)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Spans of personal data per row of ``docs`` (``doc_id``, ``text``; other columns are not read).

    A null or empty text has no span (``spans`` empty, the digest is that of an empty string); a null
    id stays null; repeated rows give repeated results; no input rows, no result. Map-only: nothing
    is shuffled, and a very long text is read in time linear in its length.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return per_rows(rows, scan, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_disguised long")
