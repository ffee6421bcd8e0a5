"""Text cleaning as Column expressions."""

from __future__ import annotations

import re

from py4j.protocol import Py4JJavaError
from pyspark import SparkContext
from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column
from pyspark.sql import functions as F

# Control and non-character code points that are removed (tab, line feed and
# carriage return stay; of the block U+FDD0..U+FDEF both ends stay).
NON_CHARACTERS = r"[\x00-\x08\x0B\x0C\x0E-\x1F\uFDD1-\uFDEE\uFFFE\uFFFF]"

# Named entities in plain-text rendering; the ampersand is decoded last. The
# semicolon may be missing where HTML has always allowed that.
ENTITIES = {
    "&nbsp;?": " ",
    "&lt;?": "<",
    "&gt;?": ">",
    "&quot;?": '"',
    "&apos;": "'",
    "&middot;?": "·",
    "&copy;?": "©",
    "&reg;?": "®",
    "&bull;": "•",
    "&ndash;": "–",
    "&mdash;": "—",
    "&hellip;": "…",
    "&amp;?": "&",
}


def strip_nonchar(text: Column) -> Column:
    return F.regexp_replace(text, NON_CHARACTERS, "")


def drop_replacement(text: Column) -> Column:
    return F.replace(text, F.lit("\uFFFD"), F.lit(""))


def _split_spec(spec: str, lead: str) -> tuple[list[str], str]:
    body = spec.strip()
    body = body[len(lead):] if body.startswith(lead) else body
    delimiter = body[:1]
    parts = re.split(r"(?<!\\)" + re.escape(delimiter), body[1:]) if delimiter else []
    if not parts or delimiter.isalnum():
        raise ValueError(f"not a pattern: {spec!r}")
    flags = parts.pop()
    inline = "".join(sorted(set(flags) & set("imsx")))
    if set(flags) - set("gimsx"):
        raise ValueError(f"unknown flags {flags!r}: {spec!r}")
    parts[0] = (f"(?{inline})" if inline else "") + parts[0]
    return parts, flags


def _groups(pattern: str, spec: str) -> int:
    """How many groups a pattern has, as the engine that runs it reads it."""
    try:
        return SparkContext._active_spark_context._jvm.java.util.regex.Pattern.compile(pattern).matcher("").groupCount()
    except (Py4JJavaError, IllegalArgumentException) as error:
        raise ValueError(f"not a pattern: {spec!r}") from error


def substitution(spec: str) -> tuple[str, str]:
    """Pattern and replacement of ``s/pattern/replacement/g``, with any delimiter.

    Checked when rules are loaded: only the replace-all form is taken.
    """
    parts, flags = _split_spec(spec, "s")
    if len(parts) != 2 or "g" not in flags:
        raise ValueError(f"expected s/pattern/replacement/g: {spec!r}")
    groups = _groups(parts[0], spec)
    if any(int(n) > groups for n in re.findall(r"\$(\d)", parts[1])):
        raise ValueError(f"replacement names a group the pattern lacks: {spec!r}")
    return parts[0], parts[1]


def regex_sub(text: Column, spec: str) -> Column:
    pattern, replacement = substitution(spec)
    return F.regexp_replace(text, pattern, replacement)


def matching(spec: str, group: int = 1) -> str:
    """The pattern of ``/pattern/``, which has at least so many groups."""
    parts, _ = _split_spec(spec, "m")
    if len(parts) != 1 or _groups(parts[0], spec) < group:
        raise ValueError(f"expected /pattern/ with group {group}: {spec!r}")
    return parts[0]


def match_nth(text: Column, spec: str, which: int = 0, group: int = 1) -> Column:
    """One group of the which-th match of ``/pattern/``: 0 all (joined by comma), -1 last.

    Empty text when there is no such match.
    """
    found = F.regexp_extract_all(text, F.lit(matching(spec, group)), F.lit(group))
    if which == 0:
        return F.array_join(F.filter(found, lambda x: x != ""), ",")
    return F.when(text.isNotNull(), F.coalesce(F.try_element_at(found, F.lit(which)), F.lit("")))


def match_by(text: Column, pattern: Column, which: Column, group: Column) -> Column:
    """``match_nth`` with everything from the row."""
    found = F.regexp_extract_all(text, pattern, group)
    one = F.coalesce(F.try_element_at(found, F.nullif(which, F.lit(0))), F.lit(""))
    return F.when(which == 0, F.array_join(F.filter(found, lambda x: x != ""), ",")).when(text.isNotNull(), one)


def join_values(values: Column, separator: str = "<BR/>") -> Column:
    """Several elements to one value; empty ones are dropped, null stays null."""
    return F.array_join(F.filter(values, lambda x: x != ""), separator)


def _decode_numbers(text: Column, pattern: str, lead: str, base: int) -> Column:
    """Numeric entities to characters; what is no character becomes U+FFFD."""

    def decode(acc: Column, code: Column) -> Column:
        point = F.conv(code, base, 10).cast("bigint")
        valid = point.between(1, 0xD7FF) | point.between(0xE000, 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, point).otherwise(0xFFFD)), 8, "0")), "UTF-32")
        return F.replace(acc, F.concat(F.lit(lead), code, F.lit(";")), char)

    codes = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))
    return F.when(F.contains(text, F.lit(lead)), F.reduce(codes, text, decode)).otherwise(text)


def _decode_entities(text: Column) -> Column:
    # Arrays of one bind the text, so that it is worked out once and read many times.
    text = F.transform(F.array(text), lambda t: _decode_numbers(t, r"&#(\d{1,9});", "&#", 10))
    text = F.transform(text, lambda t: _decode_numbers(t, r"&#x([0-9a-fA-F]{1,8});", "&#x", 16))[0]
    for entity, char in ENTITIES.items():
        text = F.regexp_replace(text, entity, char)
    return text


def html_to_text(html: Column) -> Column:
    """Plain text of a description: paragraphs and headings on their own lines, list items
    as bullets, links followed by their absolute address."""
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</(script|style)>|<!--.*?-->", "")
    text = F.regexp_replace(text, r"\s+", " ")
    text = F.regexp_replace(
        text, r"(?is)<a\b[^>]*?href\s*=\s*[\"'](https?://[^\"']*)[\"'][^>]*>(.*?)</a\s*>", "$2 \u0001$1\u0002"
    )
    text = F.regexp_replace(text, r"(?i)</a\s*>", " \u0001\u0002")
    text = F.regexp_replace(text, r"(?i)<li\b[^>]*>", "\n * ")
    text = F.regexp_replace(text, r"(?i)<dt\b[^>]*>", "  ")
    text = F.regexp_replace(text, r"(?i)<(p|h[1-5]|tr)\b[^>]*>", "\n")
    text = F.regexp_replace(text, r"(?i)<br\b[^>]*>|</(dd|dt|p|h[1-5])\s*>", "\n")
    text = F.regexp_replace(text, r"<[^>]*>", "")
    text = F.replace(F.replace(text, F.lit("\u0001"), F.lit("<")), F.lit("\u0002"), F.lit(">"))
    text = F.regexp_replace(text, r" +", " ")
    return _decode_entities(text)
