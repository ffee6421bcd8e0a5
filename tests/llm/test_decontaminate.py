"""Decontamination: templates, slot consistency, whole items against a plain search."""

import numpy as np
import pytest

from noticeboard.llm import decontaminate as d


def _template(text):
    words = d.Words()
    t = words.template(text)
    names = {v: f"<{k}>" for k, v in d._PLACEHOLDERS.items()}
    return [names.get(int(h), words.cores[c]) for h, c in zip(t.typed, t.codes)]


def test_templates():
    assert _template("Alice bought 12 apples for 3.50 dollars. Then Bob ate 5km worth.") == ["alice", "bought", "<number>", "apples", "for", "<number>", "<unit>", "then", "<name>", "ate", "<number>", "<unit>", "worth"]
    assert _template("the meters (and \"Paris\")... - So it ended, two days later!") == ["the", "meters", "and", "<name>", "so", "it", "ended", "<number>", "<unit>", "later"]
    assert _template("") == [] == _template(" .. -- ")


def test_windows_are_hashes_of_their_tokens():
    words = d.Words()
    a, b = words.template("one cat sat near the old red door today"), words.template("zebra x one cat sat near the old red door today")
    assert len(a.windows(8)) == 2 and a.windows(8)[1] == b.windows(8)[-1] and len(set(b.windows(8).tolist())) == 4
    assert len(a.windows(20)) == 0


def test_words_are_forgotten(monkeypatch):
    monkeypatch.setattr(d.Words, "KEPT", 4)
    words = d.Words()
    first = words.template("a quick brown fox jumps over the lazy dog").windows(8).tolist()
    words.template("something else entirely different from before now")
    assert words.template("a quick brown fox jumps over the lazy dog").windows(8).tolist() == first


QUESTION = "A train leaves the station at 40 km per hour and after 3 hours Maria counts how many km it went before 40 birds landed"


def _find(spark, documents, texts, items, **more):
    docs = documents([(i, t, "en", "s") for i, t in enumerate(texts)])
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in d.find(docs, bench, **more).collect()}


def test_changed_parameters_are_caught_and_inconsistent_ones_not(spark, documents):
    changed = QUESTION.replace("40", "55").replace(" 3 ", " 7 ").replace("Maria", "Peter")
    torn = QUESTION.replace("at 40", "at 55").replace(" 3 ", " 55 ").replace("Maria", "Peter")
    other = "A train of thought leaves the reader at a loss and after a while nobody counts how many words it took"
    found = _find(spark, documents, [QUESTION, f"Some words before. {changed} Some after.", torn, other, None, "", QUESTION.upper()], [QUESTION, None, ""])
    assert (0, 0) in found and found[0, 0].verbatim and found[0, 0].coverage == 1
    assert (1, 0) in found and not found[1, 0].verbatim
    assert not {(2, 0), (3, 0), (4, 0), (5, 0)} & set(found)


def test_short_items(spark, documents):
    found = _find(spark, documents, ["Name the capital of France", "please name the capital of France now", "Yes", "Yes it is", "yes"], ["Name the capital of France", "Yes"])
    assert {(0, 0), (2, 1), (4, 1)} <= set(found) and (3, 1) not in found


def test_table_against_a_plain_search(spark):
    sf = "/root/testdata/sf0.01"
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in d.find(docs, bench).collect()}
    items = {r.item_id: r.text.lower().split() for r in bench.collect()}
    want = set()
    for r in docs.collect():
        words = r.text.lower().split()
        windows = {tuple(words[i : i + 8]) for i in range(len(words) - 7)}
        for item, w in items.items():
            own = {tuple(w[i : i + 8]) for i in range(len(w) - 7)}
            if own and len(own & windows) / len(own) >= 0.5:
                want.add((r.doc_id, item))
    assert want <= got and len(got - want) <= 0.02 * len(got)


def test_clean(spark, documents):
    bench = spark.createDataFrame([(1, QUESTION), (1, QUESTION), (None, "x y z a b c d e")], "item_id long, text string")
    docs = documents([(1, QUESTION, "en", "s"), (2, "fine", "en", "s"), (None, QUESTION, "en", "s"), (1, "fine too", "en", "s"), (3, QUESTION + " " + "word " * 50_000, "en", "s")])
    kept = d.clean(docs, bench)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["2", "None"]
    assert d.clean(documents([]), bench).count() == 0
    assert d.clean(docs, spark.createDataFrame([], "item_id long, text string")).count() == 5


@pytest.mark.parametrize("n", [1, 100, 5000])
def test_the_filter_lets_known_windows_pass(spark, n):
    h = np.random.default_rng(n).integers(-(1 << 63), 1 << 63, n)
    bits = d._filter(spark.createDataFrame([(int(x),) for x in h], "hash long"))
    assert len(d._passes(h.view(np.uint64), bits)) == n
    other = np.random.default_rng(7).integers(0, 1 << 63, 10_000).astype(np.uint64)
    assert len(d._passes(other, bits)) < 10


LONG = " ".join(f"{a} {b}" for a, b in zip("river stone window market garden letter bridge winter candle forest mirror ladder pepper silver kettle basket harbor meadow ribbon saddle".split(), "runs falls opens sells grows comes stands ends burns spreads shows leans tastes shines boils holds waits blooms hangs slips".split()))


def test_a_long_run_is_a_leak_whatever_its_share(spark, documents):
    words = LONG.split()
    texts = ["before " + " ".join(words[9 : 9 + n]) + " after" for n in (15, 16, 18)]
    found = _find(spark, documents, texts, [LONG])
    assert set(found) == {(1, 0), (2, 0)} and found[1, 0].coverage < 0.5


def test_one_broken_value_does_not_hide_the_rest(spark, documents):
    item = "There are 5 red apples in the first basket on the old table and there are 3 green pears in the second basket under the tall tree near 2 white doors and 2 black gates"
    clash, apart = item.replace(" 5 ", " 4 ").replace(" 3 ", " 4 "), item.replace("2 black", "7 black")
    found = _find(spark, documents, [clash, apart], [item])
    assert set(found) == {(0, 0), (1, 0)}


def test_case_does_not_matter(spark, documents):
    item = "the old captain told Maria Lopez about a storm near Lisbon and how Pedro Alvarez saved the boat from Porto"
    found = _find(spark, documents, [item.upper(), item.title(), item.lower()], [item, QUESTION])
    assert {(0, 0), (1, 0), (2, 0)} == set(found) and all(r.coverage == 1 for r in found.values())
