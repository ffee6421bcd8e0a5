"""Personal data: plain spans against the patterns as written, disguises, edge texts."""

import hashlib
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from noticeboard.llm import pii

# The contract's patterns, tried as they stand.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(text):
    digits = [int(c) for c in text if c.isdigit()]
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _count(text):
    return len(re.sub("[^0-9]", "", text))


def brute(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= _count(m[0]) <= 19 and _luhn(m[0])]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= _count(m[0]) <= 15]


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="a1.9@- +()0%_Zé25", max_size=60))
def test_plain_spans(text):
    assert pii.find(text) == brute(text)


def test_valid_cards_and_limits():
    text = "4111 1111 1111 1111 and 4111-1111-1111-1112, 255.255.255.255 256.1.1.1 1.2.3.4.5.6.7.8 0001.2.3.4 +1 (212) 555-0100 +123"
    assert pii.find(text) == brute(text)
    assert [s[0] for s in pii.find(text)].count("card") == 1


def _found(text):
    plain = pii.find(text)
    return [(k, text[a:b]) for k, a, b in pii.disguised(text, plain)]


def test_disguises_map_back_to_the_source():
    assert _found("write to jane.doe (at) example (dot) com now") == [("email", "jane.doe (at) example (dot) com")]
    assert _found("jane [at] example.org") == [("email", "jane [at] example.org")]
    assert _found("mail jane at example dot com please") == [("email", "jane at example dot com")]
    assert _found("jаne@exаmple.com") == [("email", "jаne@exаmple.com")]
    assert _found("call plus four nine one five one two three four five six seven today") == [("phone", "plus four nine one five one two three four five six seven")]
    assert _found("＋４９ １５１ ２３４５６７８") == [("phone", "＋４９ １５１ ２３４５６７８")]
    assert _found("four one one one one one one one one one one one one one one one ok") == [("card", "four one one one one one one one one one one one one one one one")]
    assert _found("host one nine two dot one six eight dot zero dot one") == [("ip", "one nine two dot one six eight dot zero dot one")]
    assert _found("ja​ne@example.com") == []  # "ne@example.com" is a plain span


def test_clean_texts_stay_clean():
    for text in ("We met at noon. The dot is one of two.", "look at this dot", "one two three go", "été à l'école, él niño", "Привет, как дела", "naïve café (a) [b] {c}"):
        assert _found(text) == [], text


def test_plain_spans_stay_beside_disguised_ones():
    text = "a@b.co or jane (at) example (dot) com"
    plain = pii.find(text)
    assert plain == [("email", 0, 6)] and [text[a:b] for _, a, b in pii.disguised(text, plain)] == ["jane (at) example (dot) com"]


def test_long_texts_take_linear_time():
    for text in ("a" * 200_000, "1" * 200_000, "a@" * 100_000, "+1((((" * 30_000, "1." * 100_000, "one " * 50_000, "a at " * 40_000):
        begin = time.time()
        pii.disguised(text, pii.find(text))
        assert time.time() - begin < 5, text[:10]


def test_table(texts, documents):
    rows = [None, "", "x@y.zz and jane (at) example (dot) com", "x@y.zz and jane (at) example (dot) com"]
    got = pii.find_personal_data(texts(*rows)).orderBy("doc_id").collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert [(r.n_email, r.base_sha256, r.spans) for r in got[:2]] == [(0, empty, "")] * 2
    assert got[2].n_email == 1 and got[2].base_sha256 == hashlib.sha256(b"email:0:6").hexdigest()
    assert got[2].spans == "email:0:6,email:11:38" == got[3].spans
    assert pii.find_personal_data(documents([(None, "1.2.3.4", None, None)])).first().n_ip == 1
    assert pii.find_personal_data(documents([])).count() == 0


def test_disguises_are_found_whatever_else_the_text_holds():
    assert _found("jane.doe at example.com") == [("email", "jane.doe at example.com")]
    assert _found("eight point eight point eight point eight") == [("ip", "eight point eight point eight point eight")]
    assert _found("host 192[.]168[.]0[.]1 is down") == [("ip", "192[.]168[.]0[.]1")]
    assert _found("jane at example [dot] com") == [("email", "jane at example [dot] com")]


PIECES = ["jane", "a1", " at ", " AT ", "[at]", " ( at ) ", "@", "example", "exİmple", "ın", ".", ". ", " dot ", "[.]", "{dot}", " point ", "  point  ", "one", "Eight", "oh", "plus", " ", ", ", "-", "com", "ORG", "io", "é", "1", "192", "ſ"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_no_text_with_a_disguise_is_passed_over(text):
    assert pii._worth_a_look(text) or pii.normalise(text).text == text


@pytest.mark.parametrize("text", ["We met at example.com.", "find us at example.com", "Arrive at www.example.org today"])
def test_prose_holds_no_address(text):
    assert pii.disguised(text, pii.find(text)) == []


@pytest.mark.parametrize("text", ["jane.doe at example.com", "jane at example dot com", "jane at example [dot] com", "jane7 at example.com", "jane (at) example.com"])
def test_disguised_addresses_are_found(text):
    assert [k for k, _, _ in pii.disguised(text, pii.find(text))] == ["email"]


def test_many_spans_of_both_kinds_take_linear_time():
    def seconds(n):
        text = "a1@b.example and j.doe at c.example.com, " * n
        plain = pii.find(text)
        start = time.process_time()
        assert len(pii.disguised(text, plain)) == n
        return time.process_time() - start

    seconds(200)
    assert seconds(8000) < 16 * max(seconds(1000), 0.01)
