"""Secrets: base spans against the patterns as written, ownership against a count by hand."""

import hashlib
import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from noticeboard.llm import secrets

ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute(text):
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["token", "PassWord", "ſecret", "api_key", "toKen", "=", ":", " ", '"', "'", "abc", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "é", "deadbeefdeadbeef", "."]), max_size=14).map("".join))
def test_base_spans(text):
    assert [s[:3] for s in secrets.find(text)] == brute(text)


KEY = "gH7kQ2mZ9xB4nV1cW8pL5rT3yJ6d"


def test_ownership(spark, documents):
    shared, own = "AKIA" + "Q7ZX" * 4, "AKIA" + "ABCD2345EFGH6789"
    rows = [(i, f"key {shared} here", "en", f"s{i % 3}") for i in range(9)]
    rows += [(9, f"mine {own}", "en", "s0"), (10, f"mine {own}", "en", "s0"), (11, f"see {KEY} end", "en", "s1"), (12, None, None, None), (13, "", "en", None), (None, f"x {own}", "en", "s0"), (14, "token = 0011aabb", None, None)]
    got = {r.doc_id: r for r in secrets.scan_secrets(documents(rows), "source", "source").collect()}
    assert (got[0].n_example, got[0].n_live, got[0].max_owners) == (1, 0, 3)
    assert (got[9].n_example, got[9].n_live, got[9].max_owners) == (0, 1, 1)
    assert got[0].spans == "access:4:24" and got[0].base_sha256 == hashlib.sha256(b"access:4:24").hexdigest()
    assert got[11].spans == f"generic:4:{4 + len(KEY)}" and got[11].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[12].spans == "" == got[13].spans and got[None].n_access == 1 and got[14].n_assign == 1
    assert secrets.scan_secrets(documents([]), "source", "source").count() == 0


def test_copied_token_like_strings_are_no_spans(documents):
    got = secrets.scan_secrets(documents([(i, f"see {KEY} end", "en", f"s{i}") for i in range(4)]), "source", "source").collect()
    assert {(r.spans, r.n_example, r.n_live) for r in got} == {("", 0, 0)}


def test_spans_are_the_base_and_more(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in secrets.scan_secrets(docs).collect():
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in brute(texts[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))
        assert r.n_assign + r.n_access + r.n_hex == len(brute(texts[r.doc_id]))


def test_long_tokens_are_candidates(documents):
    own, copied = ("".join(f"{KEY}{c}" for c in x) for x in ("aBcDeF2iJ", "QrStUv9xY"))
    got = {r.doc_id: r for r in secrets.scan_secrets(documents([(0, f"see {own} end", "en", "s0"), (1, f"see {copied} end", "en", "s0"), (2, f"see {copied} end", "en", "s1")])).collect()}
    assert len(own) > 200 and got[0].spans == f"generic:4:{4 + len(own)}" and got[0].n_live == 1
    assert (got[1].spans, got[2].spans) == ("", "")


def test_very_long_runs_take_linear_time():
    begin = time.time()
    assert [s[:3] for s in secrets.generic(f"x {KEY * 20_000} y", [])] == [("generic", 2, 2 + len(KEY) * 20_000)]
    assert time.time() - begin < 5


def test_many_candidates_beside_many_base_spans_take_linear_time():
    def seconds(n):
        text = ("token=abcdef12345 " + "aB3dE5fG7hJ9kL1mN3pQ5rS7 ") * n
        base = secrets.find(text)
        start = time.process_time()
        secrets.generic(text, base)
        return time.process_time() - start

    seconds(200)
    assert seconds(8000) < 16 * max(seconds(1000), 0.01)
