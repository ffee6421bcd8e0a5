"""Posting dates as Column expressions.

Dates are ``timestamp_ntz`` holding UTC wall-clock time, so no result depends on
the session time zone. ``as_of`` is always a parameter: nothing reads the clock.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Chinese month names and the English short names they stand for.
CHINESE_MONTHS = {
    "一月": "Jan",
    "二月": "Feb",
    "三月": "Mar",
    "四月": "Apr",
    "五月": "May",
    "六月": "Jun",
    "七月": "Jul",
    "八月": "Aug",
    "九月": "Sep",
    "十月": "Oct",
    "十一月": "Nov",
    "十二月": "Dec",
}

# The nine named layouts, each a pattern and its replacement.
DATE_LAYOUTS = {
    "MM-dd-yyyy": (r"\D*(\d{1,})[^-]*-\D*(\d{1,})[^-]*-\D*(\d{4})", "$3-$1-$2"),
    "MM dd yyyy": (r"\D*(\d{1,})\D+(\d{1,})\D+(\d{4})", "$3-$1-$2"),
    "MMM dd yyyy": (r"([a-zA-Z]{3})\S*\s+\D*(\d{1,})\D+(\d{4})", "$2 $1 $3"),
    "MMM-dd-yyyy": (r"\s*([a-zA-Z]{3})[^-]*-\D*(\d{1,})[^-]*-\D*(\d{4})", "$2-$1-$3"),
    "dd MM yyyy": (r"\D*(\d{1,})\D*(\d{1,})\D*(\d{4})", "$3-$2-$1"),
    "yyyy-MM-dd": (r"\D*(\d{4})[^-]*-\D*(\d{1,})[^-]*-\D*(\d{1,})", "$1-$2-$3"),
    "yyyy MM dd": (r"\D*(\d{4})\S*\s\D*(\d{1,})\S*\s\D*(\d{1,})", "$1-$2-$3"),
    "yyyy/MM/dd": (r"\D*(\d{4})*[^/]*/[^\d]*(\d{1,})[^/]*/[^\d]*(\d{1,})", "$1-$2-$3"),
    "yyyyMMdd": (r"\D*(\d{4})(\d{2})(\d{2})", "$1-$2-$3"),
}

# Zone abbreviations that several zones share, and the most usual ones, in minutes
# from UTC. All others are looked up in the zone data of the engine.
ZONE_MINUTES = {
    "GMT": 0,
    "UTC": 0,
    "UT": 0,
    "EST": -300,
    "EDT": -240,
    "CST": -360,
    "CDT": -300,
    "MST": -420,
    "MDT": -360,
    "PST": -480,
    "PDT": -420,
    "BST": 60,
    "IST": 330,
}

_MONTH = (
    "(?i:(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?"
    "|sep(?:tember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?|[一二三四五六七八九]月|十[一二]?月))"
)
_WEEKDAY = "(?i:(?:sun|mon|tue|wed|thu|fri|sat)(?:s|nes|rs|ur)?(?:day)?)"
_ZONE = r"((?:[A-Z]{2,5}(?:[+-]\d{1,2}:?\d{2})?)|(?:[+-]\d{1,2}:?\d{2}))"
_N, _S = r"(\d{1,9})", r"[ \t]*"
_YMD = f"{_N}-{_S}{_N}-{_S}{_N}"
_HMS = f"{_S}{_N}:{_S}{_N}:{_S}{_N}"
_HEAD = f"{_WEEKDAY} {_S}{_MONTH} {_S}{_N} {_HMS}"

# The default formats by the shape of a text, so that only the one that can fit is tried. Each is a prefix
# pattern (text after it is ignored) and how its groups give year, month (number or name), day, hour, minute,
# second, fraction, zone and a mark: h for a clock of 12 hours, e for epoch milliseconds in place of the year.
_READ = "\u0001"  # marks a text that a format has fitted
_YMD_FORMAT = (f"{_YMD}(?:T{_HMS}(?:\\.(\\d+)Z)?)?", "$1|$2|$3|$4|$5|$6|$7||")
_DMY_DASH = (f"{_N}-{_S}{_MONTH}-{_S}{_N}", "$3|$2|$1||||||")
_DMY_BLANK = (f"{_N} {_S}{_MONTH} {_S}{_N}", "$3|$2|$1||||||")
_MDY = (f"{_N}/{_S}{_N}/{_S}{_N}", "$3|$1|$2||||||")
_EPOCH = (r"([+-]?\d{1,15})'?\z", "$1||||||||e")
_ZONED = (f"{_HEAD} {_S}{_ZONE} {_S}{_N}", "$7|$1|$2|$3|$4|$5||$6|h")
_UNZONED = (f"{_HEAD} {_S}{_N}", "$6|$1|$2|$3|$4|$5|||")
_MAIL_DASH = (f"{_WEEKDAY}, {_S}{_N}-{_S}{_MONTH}-{_S}(\\d{{2}}) {_HMS} {_S}{_ZONE}", "20$3|$2|$1|$4|$5|$6||$7|")
_MAIL_BLANK = (f"{_WEEKDAY}, {_S}{_N} {_S}{_MONTH} {_S}{_N} {_HMS} {_S}{_ZONE}", "$3|$2|$1|$4|$5|$6||$7|")
_FIELDS = "yMdHmsfzk"
_DIGITS, _LETTERS, _BLANKS = "0123456789", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", " \t"


def _bind(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once, however often it is read."""
    return F.transform(F.array(value), then)[0]


def _bare(trimmed: Column) -> Column:
    """Without quotes around it and blanks before it."""
    unquoted = F.when(F.startswith(trimmed, F.lit("'")), F.regexp_replace(trimmed, "^'(?=.*'$)", "")).otherwise(trimmed)
    return F.ltrim(unquoted, F.lit(_BLANKS))


def _first(text: Column) -> Column:
    return F.substring(text, 1, 1)


def _fit(text: Column, form: tuple[str, str]) -> Column:
    return F.regexp_replace(text, f"^{form[0]}(?s:.*)$", _READ + form[1])


def _read_shape(text: Column) -> Column:
    """A bare text by the format of its shape: what follows the number or word it begins with decides."""
    first = _first(text)
    after_number, after_word = F.ltrim(text, F.lit(_DIGITS)), F.ltrim(text, F.lit(_LETTERS))
    mark = _first(after_number)
    beyond = _first(F.ltrim(F.substring(after_number, 2, 64), F.lit(_BLANKS)))
    day_end = _first(F.ltrim(F.ltrim(F.substring(after_word, 2, 64), F.lit(_BLANKS)), F.lit(_DIGITS)))
    number = (
        F.when((mark == "-") & beyond.between("0", "9"), _fit(text, _YMD_FORMAT))
        .when(mark == "-", _fit(text, _DMY_DASH))
        .when(mark == "/", _fit(text, _MDY))
        .when(mark == " ", _fit(text, _DMY_BLANK))
        .otherwise(_fit(text, _EPOCH))
    )
    zoned = _fit(text, _ZONED)
    word = (
        F.when((_first(after_word) == ",") & (day_end == "-"), _fit(text, _MAIL_DASH))
        .when(_first(after_word) == ",", _fit(text, _MAIL_BLANK))
        .when(F.rlike(text, F.lit(f"^{_ZONED[0]}")), zoned)
        .otherwise(_fit(text, _UNZONED))
    )
    return F.when(first.between("0", "9"), number).when(first.isin("+", "-"), _fit(text, _EPOCH)).when(F.lower(first).between("a", "z"), word)


_MONTH_INDEX = ",   ,jan,feb,mar,apr,may,jun,jul,aug,sep,oct,nov,dec"
_LAST_MILLI = 253402300799999  # 9999-12-31T23:59:59.999


def ntz(moment: datetime) -> Column:
    """A UTC wall-clock literal."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def on_the_hour(moment: datetime) -> datetime:
    return moment.replace(minute=0, second=0, microsecond=0)


def english_months(text: Column) -> Column:
    """Chinese month names to Jan…Dec, longest name first."""
    for name in sorted(CHINESE_MONTHS, key=len, reverse=True):
        text = F.replace(text, F.lit(name), F.lit(CHINESE_MONTHS[name]))
    return text


def apply_layout(text: Column, layout: str | None) -> Column:
    """Rewrite a date text by a named layout; an unknown layout leaves it as it is."""
    if layout not in DATE_LAYOUTS:
        return text
    pattern, replacement = DATE_LAYOUTS[layout]
    return F.regexp_replace(text, pattern, replacement)


def _zone_minutes(zone: Column, local: Column) -> Column:
    """Minutes from UTC of a zone name, an offset or both; null for a name nobody knows."""
    name = F.regexp_extract(zone, r"^([A-Z]*)", 1)
    number = _number(F.regexp_replace(zone, r"[^0-9]", ""))
    sign = F.when(F.contains(zone, F.lit("-")), -1).otherwise(1)
    named = F.when(name == "", 0)
    for abbreviation, offset in ZONE_MINUTES.items():
        named = named.when(name == abbreviation, offset)
    day = F.substring(local.cast("string"), 1, 19)
    there = F.try_to_timestamp(F.concat(day, F.lit(" "), name), F.lit("yyyy-MM-dd HH:mm:ss z"))
    here = F.try_to_timestamp(F.concat(day, F.lit(" UTC")), F.lit("yyyy-MM-dd HH:mm:ss z"))
    named = named.otherwise(((F.unix_seconds(here) - F.unix_seconds(there)) / 60).cast("int"))
    return named + sign * (F.floor(number / 100).cast("int") * 60 + number % 100)


def _number(digits: Column) -> Column:
    """Up to nine digits; none is 0. Never a failing cast, which would cost more than the parse."""
    return F.concat(F.lit("0"), digits).cast("int")


def _month(name: Column) -> Column:
    english = F.when(name < "{", name).otherwise(english_months(name))
    named = F.instr(F.lit(_MONTH_INDEX), F.concat(F.lit(","), F.rpad(F.lower(english), 3, " ")))
    return F.when(_first(name).between("0", "9"), _number(name)).otherwise(F.floor((named - 1) / 4).cast("int"))


def _local(field: dict[str, Column]) -> Column:
    """Wall-clock time in the text's own zone; null where no format has fitted or a part is out of range."""
    year = _number(F.substring(field["y"], 2, 9))
    hour = F.when((field["k"] == "h") & (field["H"] == "12"), 0).otherwise(_number(field["H"]))
    millis = F.substring(F.concat(field["f"], F.lit("000")), 1, 3)
    second = F.concat(F.lit("0"), field["s"], F.lit("."), millis).cast("decimal(16,6)")
    day = F.try_make_timestamp_ntz(year, _month(field["M"]), _number(field["d"]), F.lit(0), F.lit(0), F.lit(0).cast("decimal(16,6)"))
    moment = F.try_make_timestamp_ntz(year, _month(field["M"]), _number(field["d"]), hour, _number(field["m"]), second)
    moment = F.when(F.length(field["y"]) > 5, F.when(year <= 9999, moment)).when(field["H"] == "", day).otherwise(moment)
    fitted = F.when(field["k"] == "e", _from_millis(F.substring(field["y"], 2, 16))).otherwise(moment)
    return F.when(F.startswith(field["y"], F.lit(_READ)), fitted)


def _from_millis(text: Column) -> Column:
    millis = text.cast("bigint")
    seconds = (millis.cast("decimal(18,0)") / 1000).cast("decimal(18,6)")
    start = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.when(F.abs(millis) <= _LAST_MILLI, start + F.make_dt_interval(secs=seconds))


def _parts(read: Column) -> Column:
    return F.split(read, r"\|", len(_FIELDS))


def _named(parts: Column) -> dict[str, Column]:
    return {name: F.get(parts, F.lit(i)) for i, name in enumerate(_FIELDS)}


def _of_bare(text: Column) -> Column:
    def of_parts(parts: Column) -> Column:
        field = _named(parts)
        zoned = _bind(_local(field), lambda local: local - F.make_dt_interval(mins=_zone_minutes(field["z"], local)))
        return F.when(F.length(field["z"]) > 0, zoned).otherwise(_local(field))

    return _bind(_parts(_read_shape(text)), of_parts)


def parse_date(text: Column, layout: str | None = None) -> Column:
    """Layout, then the default formats in order, then epoch milliseconds. Quotes around the
    text do not count; month names may be Chinese.

    Out-of-range fields make a text unparseable; null when nothing fits. For elements of arrays;
    a column of texts is read by ``with_dates``.
    """
    return _bind(F.trim(apply_layout(text, layout)), lambda trimmed: _bind(_bare(trimmed), _of_bare))


def with_dates(df: DataFrame, texts: dict[str, Column], layouts: dict[str, str] | None = None) -> DataFrame:
    """Add a date column for each text, read by ``parse_date``. Each is one expression in which nothing stands twice, so
    a filter on a date that is pushed below it doesn't multiply it."""
    return df.withColumns({out: parse_date(text, (layouts or {}).get(out)) for out, text in texts.items()})


def whole_days(since: Column, as_of: Column) -> Column:
    """Whole days from ``since`` to ``as_of``, cut off towards zero."""
    return F.extract(F.lit("DAY"), as_of - since).cast("int")


def outdated(date: Column, as_of: Column, n_days: Column | int | None) -> Column:
    """More than n whole days old; a missing date or no limit is never outdated."""
    if n_days is None:
        return F.lit(False)
    return F.coalesce(whole_days(date, as_of) > n_days, F.lit(False))


def not_outdated(date: Column, as_of: Column, n_days: int) -> Column:
    """The rows ``outdated`` leaves, as a plain comparison that a scan can be given: a date is
    more than n whole days old when n + 1 days have passed. No date lies 100 million days back."""
    until = F.try_subtract(as_of, F.make_dt_interval(days=F.lit(min(n_days + 1, 100_000_000))))
    return date.isNull() | until.isNull() | (date > until)


def days_delta(date: Column, as_of: Column) -> Column:
    """Whole days since the date, plus one; 0 when there is no date."""
    return F.coalesce(whole_days(date, as_of) + 1, F.lit(0))


def iso_text(date: Column) -> Column:
    """ISO text in UTC, milliseconds without trailing zeros, no fraction when it is 0."""
    text = F.regexp_replace(date.cast("string"), r"(\.\d{1,3})\d*$", "$1")
    text = F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.concat(F.replace(text, F.lit(" "), F.lit("T")), F.lit("Z"))


def index_text(date: Column) -> Column:
    """ISO text in UTC with exactly three fraction digits."""

    def render(text: Column) -> Column:
        fraction = F.rpad(F.substring(F.regexp_extract(text, r"\.(\d+)$", 1), 1, 3), 3, "0")
        whole = F.replace(F.substring(text, 1, 19), F.lit(" "), F.lit("T"))
        return F.concat(whole, F.lit("."), fraction, F.lit("Z"))

    # The array of one binds the text, so that the date is worked out once.
    return F.transform(F.array(date.cast("string")), render)[0]
