"""Alignment: groups and links against a plain walk over offsets, counts against a plain count, encoding against whole texts."""

import hashlib
from collections import Counter

import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from noticeboard.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _sets(draw):
    return st.integers(1, 60).flatmap(lambda n: st.tuples(st.sets(st.integers(1, n)).map(lambda s: sorted(s | {n})), st.sets(st.integers(1, n)).map(lambda s: sorted(s | {n}))))


@settings(max_examples=500, deadline=None)
@given(st.data())
def test_runs_cut_at_every_common_end(data):
    a, b = data.draw(_sets(data))
    if data.draw(st.booleans()):  # long diagonals with few faults
        b = sorted({*a, b[-1]} - set(b[: len(b) // 4])) if a[-1] == b[-1] else b
    cuts, i, j = [], 0, 0
    for x, k, y, l in alignment.runs(a, b):
        assert (x, y) == (i, j)
        if a[x] == b[y]:
            assert k - x == l - y and a[x:k] == b[y:l]
            cuts += a[x:k]
        else:
            assert a[k - 1] == b[l - 1]
            cuts.append(a[k - 1])
        i, j = k, l
    assert (i, j) == (len(a), len(b)) and cuts == sorted(set(a) & set(b))


def _plain(texts):
    """The whole report by dictionaries, from whole texts."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    pair = alignment.Pair(A, B)
    docs, counts = [], Counter()
    for text in texts:
        whole = (" " + (text or "")).encode()
        ids_a, ids_b = a.encode(whole.decode(), add_special_tokens=False).ids, b.encode(text or "")
        if not text or b"".join(pair.bytes_a[x] for x in ids_a) != whole or b"".join(pair.bytes_b[x] for x in ids_b) != whole:
            docs.append(None)
            continue

        def spans(ids, sizes):
            at, out = 0, []
            for x in ids:
                out.append((at, at + len(sizes[x])))
                at = out[-1][1]
            return out

        sa, sb = spans(ids_a, pair.bytes_a), spans(ids_b, pair.bytes_b)
        common = sorted({e for _, e in sa} & {e for _, e in sb})
        groups, start = [], 0
        for end in common:
            inside = lambda ids, s: ",".join(str(x) for x, (f, t) in zip(ids, s) if start <= f and t <= end)  # noqa: B023, E731
            groups.append(inside(ids_a, sa) + "|" + inside(ids_b, sb))
            start = end
        links = [(x, y) for x, (f, t) in zip(ids_a, sa) for y, (g, u) in zip(ids_b, sb) if f < u and g < t]
        counts.update(links)
        docs.append((len(ids_a), len(ids_b), groups, links))
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(most.get(y, 0), n)
    zeros = (0, 0, 0, 0, 0, 0, "")
    return [
        zeros if d is None else (d[0], d[1], len(d[2]), len(d[3]), sum(counts[x] == most[x[1]] for x in d[3]), sum(counts[x] for x in d[3]), hashlib.sha256(";".join(d[2]).encode()).hexdigest())
        for d in docs
    ]


ODD = [
    None, "", " ", "  two  blanks ", "a", "tail  ", "\nline\n next\n\n  end", "naïve café — “quoted” 日本語のテキスト 🙂🏽", "it's they'll 's  's", "under▁score", "<s> </s> <unk> <|endoftext|>",
    "x" * 3000, "nul\x00char", "\ttab nbsp  mixed 　wide", "é combining", "1234567890 12 3", "the cat sat on the mat and the cat sat on the mat. " * 40, "<0x0A> <0xFF>", " sep \x85nel \x1cfs",
]


def _same(docs, texts, sent=1 << 18):
    got = {r.doc_id: tuple(r)[1:] for r in alignment.describe(docs, sent=sent).collect()}
    assert [got[i] for i in range(len(texts))] == _plain(texts)


def test_equals_a_plain_walk(texts):
    _same(texts(*ODD), ODD)


def test_counts_beyond_those_sent_come_by_a_join(texts):
    _same(texts(*ODD), ODD, sent=5)
    _same(texts(*ODD), ODD, sent=0)


def test_units_align_as_whole_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(120).collect()
    pair = _shared()
    assert pair.by_unit
    texts = [r.text or "" for r in docs] + [t for t in ODD if t]
    assert pair.align(texts) == [pair._together([t])[t] if t else None for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\tab'st.1é日 　▁\r-"), max_size=30), max_size=5))
def test_units_align_as_whole_texts_of_any_kind(texts):
    pair = _shared()
    assert pair.align(texts) == [pair._together([t])[t] if t else None for t in texts]


def _shared(made=[]):  # noqa: B006
    if not made:
        made.append(alignment.Pair(A, B))
    return made[0]


def test_no_rows_and_repeated_and_missing_ids(documents):
    assert alignment.describe(documents([])).count() == 0
    rows = [(None, "a b", "en", "s"), (1, "a b", "en", "s"), (1, "a b", "en", "s")]
    got = alignment.describe(documents(rows)).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "1", "None"] and len({tuple(r)[1:] for r in got}) == 1
