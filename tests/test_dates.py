from datetime import datetime

import pytest
from pyspark.sql import functions as F

from noticeboard.functions import dates

def t_():
    return F.col("t")


@pytest.mark.parametrize(
    ("text", "layout", "day"),
    [
        ("m06a - a19b - c2014", "MM-dd-yyyy", datetime(2014, 6, 19)),
        ("April a15b   year2014a", "MMM dd yyyy", datetime(2014, 4, 15)),
        ("April-a15b-year2014a", "MMM-dd-yyyy", datetime(2014, 4, 15)),
        ("d19a   m06b  y2014c", "dd MM yyyy", datetime(2014, 6, 19)),
        ("y2014a-m6b - d19c - ", "yyyy-MM-dd", datetime(2014, 6, 19)),
        ("19 Jun 2014", "dd MMM yyyy", datetime(2014, 6, 19)),
    ],
)
def test_layouts(values, text, layout, day):
    assert values([text], dates.parse_date(t_(), layout)) == [day]


def test_default_formats(values):
    cases = {
        "2015-03-02T10:20:30Z": datetime(2015, 3, 2, 10, 20, 30),
        "2015-03-02T10:20:30.2Z": datetime(2015, 3, 2, 10, 20, 30, 200000),
        "2015-03-02T10:20:30.1239Z": datetime(2015, 3, 2, 10, 20, 30, 123000),
        "2015-03-02T10:20:30 and more": datetime(2015, 3, 2, 10, 20, 30),
        "2015-03-02 10:20:30": datetime(2015, 3, 2),
        "'2015-3-2'": datetime(2015, 3, 2),
        " 2015- 3- 2 ": datetime(2015, 3, 2),
        "Fri Jun 20 12:30:00 GMT 2014": datetime(2014, 6, 20, 0, 30),
        "Fri Jun 20 13:30:00 PST 2014": datetime(2014, 6, 20, 21, 30),
        "Fri Jun 20 13:30:00 2014": datetime(2014, 6, 20, 13, 30),
        "Friday, 20-Jun-14 13:30:00 UTC": datetime(2014, 6, 20, 13, 30),
        "Fri, 20 June 2014 13:30:00 +0530": datetime(2014, 6, 20, 8, 0),
        "Fri, 20 June 2014 13:30:00 GMT-02:00": datetime(2014, 6, 20, 15, 30),
        "20-JUN-2014": datetime(2014, 6, 20),
        "20 十一月 2014": datetime(2014, 11, 20),
        "1 二月 2014": datetime(2014, 2, 1),
        "6/20/2014": datetime(2014, 6, 20),
        "1403272800123": datetime(2014, 6, 20, 14, 0, 0, 123000),
        "-86400000": datetime(1969, 12, 31),
        "2014-13-45": None,
        "2014-02-30": None,
        "soon": None,
        "": None,
        "Fri Jun 20 13:30:00 XYZ 2014": None,
        "999999999999999": None,
        "a|b|c": None,
        "x||||||||e": None,
        "12345678901-1-1": None,
        "2014-06-20T10:20": datetime(2014, 6, 20),
        "5 - 6 - 2014": None,
        "Fri Jun 20 12:30:00 2014 GMT": datetime(2014, 6, 20, 12, 30),
        "1403272800123 ": datetime(2014, 6, 20, 14, 0, 0, 123000),
        None: None,
    }
    got = values(list(cases), dates.parse_date(t_()))
    assert dict(zip(cases, got)) == cases


def test_iso_text(values):
    moment = t_().cast("timestamp_ntz")
    inputs = ["2014-06-20 10:20:30.1200", "2014-06-20 10:20:00", "2014-06-20 10:20:30.1239"]
    assert values(inputs, dates.iso_text(moment)) == [
        "2014-06-20T10:20:30.12Z", "2014-06-20T10:20:00Z", "2014-06-20T10:20:30.123Z",
    ]
    assert values(inputs[1:2], dates.index_text(moment)) == ["2014-06-20T10:20:00.000Z"]


def test_outdated_counts_whole_days(values):
    now = dates.ntz(datetime(2024, 1, 31, 10))
    inputs = ["2024-01-30 10:00:00", "2024-01-30 10:00:01", "2024-01-29 10:00:01", "2024-02-05 00:00:00", None]
    moment = t_().cast("timestamp_ntz")
    assert values(inputs, dates.outdated(moment, now, 0)) == [True, False, True, False, False]
    assert values(inputs, dates.outdated(moment, now, 1)) == [False] * 5
    assert values(inputs, dates.outdated(moment, now, None)) == [False] * 5
    assert values(inputs, dates.days_delta(moment, now)) == [2, 1, 2, -3, 0]


def test_odd_dates_never_fail_a_job(values):
    odd = [
        "999999999-1-1", "999999-12-31", "0-0-0", "1-1-1T99:99:99Z", "Fri Jun 99 99:99:99 GMT 99999", "9999999999999999999999",
        "2014-06-20T10:20:999999999Z", "2014-06-20T10:20:30.99999999999999999999Z", "1/1/999999999", "\x01|||||||||||", "+", "-",
        "Fri, 20 June 2014 13:30:00 +9999", "0001-01-01",
    ]
    now = dates.ntz(datetime(2024, 1, 31))
    got = values(odd, dates.outdated(dates.parse_date(t_()), now, 5))
    assert got[0] is False and got[-1] is True and None not in got
    values(odd, dates.iso_text(dates.parse_date(t_())))
    for layout in dates.DATE_LAYOUTS:
        values(odd, dates.days_delta(dates.parse_date(t_(), layout), now))
