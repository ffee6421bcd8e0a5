"""Mixing: the schedule against its windows, places against a plain simulation."""

import math
import zlib
from collections import Counter
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st

from noticeboard.llm import mixing


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.floats(1e-4, 1000), st.integers(0, 60)), min_size=1, max_size=12))
def test_every_block_keeps_the_window_of_its_weight(sources):
    weights, blocks = [w for w, _ in sources], [n for _, n in sources]
    share = [Fraction(w) / sum(map(Fraction, weights)) for w in weights]
    done, last = [0] * len(sources), -1
    for i, j, slot in mixing.schedule(weights, blocks):
        assert j == done[i] and slot > last
        assert math.floor(j / share[i]) <= slot < math.ceil((j + 1) / share[i])
        done[i], last = j + 1, slot
    assert done == blocks


def test_no_source_is_a_block_from_its_target_over_many_slots():
    parts = [1, 500, 3333, 2000, 7, 4159]  # of 10,000
    slots = 100_000
    taken = [0] * len(parts)
    for i, _, slot in mixing.schedule([float(p) for p in parts], [20 * p for p in parts]):
        if slot == slots:
            break
        taken[i] += 1
        assert all(abs(n * 10_000 - (slot + 1) * p) < 10_000 for n, p in zip(taken, parts))
    assert taken == [10 * p for p in parts]


def _check(rows, got, block):
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    assert sorted(r.position for r in got) == list(range(len(rows)))
    by_slot = sorted(got, key=lambda r: r.position)
    assert [r.slot for r in by_slot] == sorted(r.slot for r in got)
    for source in {r.source for r in got}:
        blocks = Counter(r.block for r in got if r.source == source)
        n = sum(blocks.values())
        assert blocks == {b: min(block, n - b * block) for b in range(math.ceil(n / block))}


def test_mix_keeps_all_rows_and_the_shares(spark, documents):
    rows = [(i, "t", "en", "hot" if i % 3 else f"s{i % 5}") for i in range(600)]
    weights = spark.createDataFrame([("hot", 2.0), ("s0", 1.0), ("s1", 1.0), ("s2", 1.0), ("s3", 1.0), ("s4", 2.0)], "key string, weight double")
    got = mixing.mix(documents(rows), weights=weights, block=2).collect()
    _check(rows, got, 2)
    by_slot = {r.slot: r.source for r in got}
    share = {r.key: r.weight / 8 for r in weights.collect()}
    ends = min(max(s for s, x in by_slot.items() if x == key) for key in share)  # until the first source runs out
    taken = Counter()
    for slot in range(ends):
        taken[by_slot[slot]] += 1
        for key, w in share.items():
            assert abs(taken[key] - (slot + 1) * w) < 1


def _replay(weights, sizes, block):
    """Slots by a plain simulation: at every slot look at all sources."""
    whole = sum(map(Fraction, weights.values()))
    share = {x: Fraction(w) / whole for x, w in weights.items()}
    left, done, out = {x: math.ceil(n / block) for x, n in sizes.items()}, Counter(), {}
    slot = 0
    while any(done[x] < left[x] for x in sizes):
        due = [(math.ceil((done[x] + 1) / share[x]), x) for x in sorted(sizes) if done[x] < left[x] and math.floor(done[x] / share[x]) <= slot]
        if due:
            x = min(due)[1]
            out[x, done[x]] = slot
            done[x] += 1
        slot += 1
    return out


def test_a_plain_simulation_gives_the_same_slots(spark, documents):
    rows = [(i, "t", "en", "abcd"[zlib.crc32(b"%d" % i) % 7 % 4]) for i in range(400)]
    weights = {"a": 5.0, "b": 2.0, "c": 0.75, "d": 0.25}
    given = spark.createDataFrame(list(weights.items()), "key string, weight double")
    got = mixing.mix(documents(rows), weights=given, block=4).collect()
    assert {(r.source, r.block): r.slot for r in got} == _replay(weights, Counter(r[3] for r in rows), 4)
    places = {}
    for r in sorted(got, key=lambda r: (r.slot, r.position)):
        places.setdefault((r.source, r.block), []).append(r.position)
    assert [p for ps in places.values() for p in ps] == list(range(400))


def test_blocks_grow_so_that_they_stay_as_many(documents, monkeypatch):
    rows = [(i, "t", "en", "hot" if i % 3 else "s") for i in range(900)]
    monkeypatch.setattr(mixing, "MOST", 10)
    got = mixing.mix(documents(rows), block=2).collect()
    _check(rows, got, 90)


def test_weights_that_are_none(spark, documents):
    rows = [(i, "t", "en", "abcd"[i % 4]) for i in range(80)]
    given = [("a", None), ("b", 0.0), ("c", float("nan")), ("d", float("inf")), ("e", 3.0)]
    got = mixing.mix(documents(rows), weights=spark.createDataFrame(given, "key string, weight double"), block=2).collect()
    assert {(r.doc_id, r.position) for r in got} == {(r.doc_id, r.position) for r in mixing.mix(documents(rows), block=2).collect()}


def test_rows_without_ids_are_spread_by_their_tag(spark, documents):
    docs = documents([(None, f"t{i}", "en", "s") for i in range(200)]).selectExpr("doc_id", "source", "xxhash64(text) AS tag", "1 AS __row", "2 AS `__key`")
    got = mixing.mix(docs, block=8, tag="tag")
    assert got.columns == ["doc_id", "source", "tag", "block", "slot", "position"]
    assert sorted(r.position for r in got.collect()) == list(range(200))
    dealt = docs.selectExpr("shiftright(xxhash64(CAST(doc_id AS LONG), tag, 42), 52) AS slice").distinct().count()
    assert dealt > 150


def test_missing_sources_and_ids_and_no_rows(documents):
    rows = [(None, "a", "en", None), (None, "b", "en", "s"), (1, "c", "en", None), (2, "d", "en", "s"), (2, "d", "en", "s"), (3, None, None, "")]
    _check(rows, mixing.mix(documents(rows), block=2).collect(), 2)
    assert mixing.mix(documents([])).count() == 0


def test_arranged_files_hold_the_mixture_in_order(spark, documents, tmp_path):
    rows = [(i if i % 10 else None, f"text {i % 40}", "en", f"s{i % 3}") for i in range(120)]
    docs = documents(rows)
    out = mixing.arrange(docs)
    assert out.columns == docs.columns
    out.write.parquet(f"{tmp_path}/mixed")
    back = spark.read.parquet(f"{tmp_path}/mixed").select("doc_id", "text", "source", "_metadata.file_name", "_metadata.row_index").collect()
    back.sort(key=lambda r: (r.file_name, r.row_index))
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(r[0]), r[1]) for r in rows)
    tagged = docs.selectExpr("doc_id", "source", "xxhash64(text) AS tag")
    place = {r.doc_id: r.position for r in mixing.mix(tagged, tag="tag").collect() if r.doc_id is not None}
    found = [place[r.doc_id] for r in back if r.doc_id is not None]
    assert found == sorted(found)
