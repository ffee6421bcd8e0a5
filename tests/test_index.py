import threading
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from noticeboard.operators import index
from noticeboard.session import cut_lineage, new_folder, shared_folder, written
from noticeboard.sources.log import CommitLog
from noticeboard.sources.table import PostingTable
from noticeboard.streaming.indexing import index_stream

SCHEMA = "id string, job_title string, job_expired boolean, seq int"


def _df(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def _dict(df):
    rows = df.select("id", "job_title", "job_expired").collect()
    assert len({r.id for r in rows}) == len(rows)
    return {r.id: (r.job_title, r.job_expired) for r in rows}


def test_upsert_is_idempotent_and_last_wins(spark):
    base = _df(spark, ("a", "old", False, 0), ("b", "old", True, 0))
    batch = _df(spark, ("a", "x", False, 1), ("a", "y", False, 2), ("c", "new", False, 1))
    once = index.upsert(base, batch, "seq")
    assert _dict(once) == {"a": ("y", False), "b": ("old", True), "c": ("new", False)}
    assert _dict(index.upsert(once, batch, "seq")) == _dict(once)


def test_one_id_with_most_copies_is_limited_before_the_shuffle(spark):
    batch = spark.range(20_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("id"),
        F.col("id").cast("string").alias("job_title"), F.lit(False).alias("job_expired"), F.col("id").cast("int").alias("seq"),
    )
    last = index.last_per_id(batch, "seq")
    assert "WindowGroupLimit" in last._jdf.queryExecution().executedPlan().toString()
    assert last.where("id = 'hot'").first().job_title == "19999"


def test_mark_expired_changes_the_flag_alone(spark):
    base = _df(spark, ("a", "t", False, 0), ("b", "u", False, 0), ("c", "v", True, 0))
    ids = spark.createDataFrame([("a",), ("a",), ("zzz",)], "id string")
    assert _dict(index.mark_expired(base, ids)) == {"a": ("t", True), "b": ("u", False), "c": ("v", True)}


def test_delete_only_when_allowed(spark):
    base = _df(spark, ("a", "t", False, 0), ("b", "u", False, 0))
    ids = spark.createDataFrame([("a",)], "id string")
    assert index.delete_ids(base, ids).count() == 2
    assert set(_dict(index.delete_ids(base, ids, allow_delete=True))) == {"b"}


def test_route_writes_lets_the_last_event_decide(spark):
    base = _df(spark, ("a", "t", False, 0), ("b", "u", False, 0))
    batch = _df(spark, ("a", "gone", True, 1), ("b", "gone", True, 1), ("b", "back", False, 2), ("c", "new", False, 1), ("c", "x", True, 2), ("d", "x", True, 1))
    assert _dict(index.route_writes(base, batch, "seq")) == {"a": ("t", True), "b": ("back", False), "c": ("new", True)}


def test_windows_read_on_from_a_key(spark):
    day = datetime(2020, 1, 1)
    rows = [(f"{i:02}", day, "c") for i in range(10)]
    df = spark.createDataFrame(rows, "id string, job_post_date timestamp_ntz, job_company string")
    first = index.window_after(df, None, 4).collect()
    second = index.window_after(df, (first[-1].job_post_date, first[-1].id), 4).collect()
    assert [r.id for r in first + second] == [f"{i:02}" for i in range(8)]
    assert [r.id for r in index.window_by_offset(df, 4, 4).collect()] == [r.id for r in second]


def test_unknown_companies_are_ignored(spark):
    df = spark.createDataFrame([("1", "A"), ("2", "B")], "id string, job_company string")
    wanted = lambda *n: spark.createDataFrame([(x,) for x in n], "display_name string")
    assert index.of_companies(df, wanted("A", "unknown")).count() == 1
    assert index.of_companies(df, wanted("unknown")).count() == 2


def test_posting_table(spark):
    table = PostingTable(spark, new_folder(spark, "table"), SCHEMA, ["seq"], buckets=4)
    assert table.current().count() == 0 and table.compact() == -1
    table.append(_df(spark, ("a", "x", False, 1), ("b", "x", False, 1)), 0)
    table.append(_df(spark, ("a", "x", False, 1), ("b", "x", False, 1)), 0)  # the same batch again
    assert _dict(table.current()) == {"a": ("x", False), "b": ("x", False)}
    assert table.compact() == 0
    table.append(_df(spark, ("a", "x", True, 2), ("c", "n", False, 1)), 1)
    assert _dict(table.current()) == {"a": ("x", True), "b": ("x", False), "c": ("n", False)}
    assert _dict(table.by_id("a")) == {"a": ("x", True)}
    assert table.compact() == 1 and table.compact() == 1
    assert _dict(table.current()) == {"a": ("x", True), "b": ("x", False), "c": ("n", False)}
    plan = table.by_id("b")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan
    assert _dict(table.by_id("b")) == {"b": ("x", False)}


def test_stream_equals_batch(spark):
    folder = new_folder(spark, "stream")
    batches = [
        _df(spark, ("a", "x", False, 1), ("b", "x", False, 1)),
        _df(spark, ("a", "gone", True, 2), ("c", "y", False, 2)),
        _df(spark, ("b", "z", False, 3), ("c", "w", False, 3)),
    ]
    table = PostingTable(spark, f"{folder}/table", SCHEMA, ["seq"], buckets=4)
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(f"{folder}/source")
        got = index_stream(spark, f"{folder}/source", table, f"{folder}/checkpoint", "*.parquet", files_per_batch=1)
    empty = spark.createDataFrame([], SCHEMA)
    whole = index.route_writes(empty, index.append_batches(batches), "seq")
    assert _dict(got) == _dict(whole) == {"a": ("x", True), "b": ("z", False), "c": ("w", False)}
    assert _dict(index_stream(spark, f"{folder}/source", table, f"{folder}/checkpoint", "*.parquet")) == _dict(got)


def test_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_folder(spark) == (named or spark.sparkContext.getCheckpointDir())
    df = spark.range(5)
    assert written(df, "stage").count() == 5
    assert cut_lineage(df).count() == 5
    with pytest.raises(Exception):  # noqa: B017
        written(df.select("nope"), "stage")


def test_late_batches_fail_and_known_ones_change_nothing(spark):
    table = PostingTable(spark, new_folder(spark, "table"), SCHEMA, ["seq"], buckets=4)
    row = lambda i, title: spark.createDataFrame([(i, title, False, 1)], SCHEMA)
    table.append(row("a", "x"), 5)
    table.compact()
    with pytest.raises(ValueError):
        table.append(row("b", "late"), 3)
    table.append(row("a", "other"), 5)
    table.append(row("b", "y"), 6)
    assert _dict(table.current()) == {"a": ("x", False), "b": ("y", False)}


def test_only_touched_buckets_are_rewritten(spark):
    table = PostingTable(spark, new_folder(spark, "table"), SCHEMA, ["seq"], buckets=4)
    table.load(spark.createDataFrame([(str(i), "x", i % 2 == 0, 1) for i in range(40)], SCHEMA))
    assert table.compact() == 0 and table.unused() == []
    table.append(spark.createDataFrame([("7", "new", False, 2)], SCHEMA), 1)
    assert table.compact() == 1 and table.last_number() == 1
    paths = {f.split("/snapshot/")[1].rsplit("/", 1)[0] for f in table.current().inputFiles()}
    assert sum(p.startswith("no=1") for p in paths) == 1 and len(paths) == 4
    assert len(table.unused()) == 2  # the folded change, and the old copy of one bucket
    got = _dict(table.current())
    assert got["7"] == ("new", False) and got["8"] == ("x", True) and len(got) == 40


def test_a_new_checkpoint_goes_on_above_what_the_table_has(spark):
    folder = new_folder(spark, "stream")
    table = PostingTable(spark, f"{folder}/table", SCHEMA, ["seq"], buckets=4)
    table.append(spark.createDataFrame([("a", "old", False, 1)], SCHEMA), 9)
    table.compact()
    spark.createDataFrame([("a", "new", False, 1), ("b", "b", False, 1)], SCHEMA).write.parquet(f"{folder}/source")
    for checkpoint in ("one", "two"):
        got = index_stream(spark, f"{folder}/source", table, f"{folder}/{checkpoint}", "*.parquet")
        assert _dict(got) == {"a": ("new", False), "b": ("b", False)}


def _ids(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id string")


def test_deleting_takes_what_came_before(spark):
    table = PostingTable(spark, new_folder(spark, "table"), SCHEMA, ["seq"], buckets=4)
    table.delete(_ids(spark, "a"), 0)  # of an empty table
    assert table.current().count() == 0
    table.append(_df(spark, ("a", "x", False, 1), ("b", "x", False, 1), ("c", "x", False, 1)), 1)
    table.delete(_ids(spark, "a", "a", "zzz", None, "c"), 2)
    table.delete(_ids(spark, "b"), 2)  # the number again
    table.append(_df(spark, ("a", "gone", True, 0), ("c", "back", False, 0)), 3)
    want = {"b": ("x", False), "c": ("back", False)}  # expiring what is deleted changes nothing
    assert _dict(table.current()) == want and table.last_number() == 3
    assert _dict(table.by_id("a")) == {} and _dict(table.by_id("c")) == {"c": ("back", False)}
    assert table.compact() == 3 and _dict(table.current()) == want and table.compact() == 3
    assert {f.rsplit("/", 2)[1] for f in table.unused()} >= {"changes", "deletes"}
    with pytest.raises(ValueError, match="another kind"):
        table.delete(_ids(spark, "b"), 3)
    with pytest.raises(ValueError, match="another kind"):
        table.append(_df(spark, ("b", "y", False, 1)), 2)


def test_a_bucket_emptied_by_deletion_stays_empty_until_it_is_filled_again(spark):
    table = PostingTable(spark, new_folder(spark, "table"), SCHEMA, ["seq"], buckets=4)
    rows = spark.createDataFrame([(str(i), "x", False, 1) for i in range(40)], SCHEMA)
    table.load(rows)
    bucket = F.pmod(F.xxhash64("id"), F.lit(4))
    one = rows.where(bucket == 1)
    there = [r.id for r in one.collect()]
    assert there
    table.delete(one, 1)
    left = {str(i) for i in range(40)} - set(there)
    assert set(_dict(table.current())) == left
    assert table.compact() == 1
    assert set(_dict(table.current())) == left and _dict(table.by_id(there[0])) == {}
    assert not any("bucket=1/" in f for f in table.current().inputFiles())
    assert any(f.endswith("no=0/bucket=1") for f in table.unused())
    table.append(_df(spark, (there[0], "new", False, 2)), 2)
    assert table.compact() == 2 and _dict(table.by_id(there[0])) == {there[0]: ("new", False)}
    table.delete(rows, 3)
    assert table.compact() == 3 and table.current().count() == 0


def test_deleting_writes_the_ids_alone_and_rewrites_only_their_buckets(spark):
    table = PostingTable(spark, new_folder(spark, "table"), SCHEMA, ["seq"], buckets=4)
    table.load(spark.createDataFrame([(str(i), "x" * 1000, False, 1) for i in range(400)], SCHEMA))
    before = set(table.current().inputFiles())
    table.delete(_ids(spark, "7"), 1)
    written = spark.read.parquet(f"{table.root}/deletes/no=1")
    assert written.columns == ["id"] and written.count() == 1
    assert before < set(table.current().inputFiles())  # the snapshot as it was, and the ids
    table.compact()
    assert len(before & set(table.current().inputFiles())) == len(before) * 3 // 4


def test_of_two_writers_at_once_one_gets_the_number_and_no_row_is_lost(spark):
    table = PostingTable(spark, new_folder(spark, "table"), SCHEMA, ["seq"], buckets=4)
    table.append(_df(spark, ("z", "first", False, 1)), 0)
    start = threading.Barrier(3)

    def write(name):
        own = PostingTable(spark, table.root, SCHEMA, ["seq"], buckets=4)
        start.wait()
        return [own.append(_df(spark, (f"{name}{turn}", name, False, 1)), turn, name) for turn in (1, 2)]

    def fold():
        own = PostingTable(spark, table.root, SCHEMA, ["seq"], buckets=4)
        start.wait()
        return [own.compact() for _ in range(2)]

    with ThreadPoolExecutor(3) as pool:
        one, two, folds = pool.submit(write, "one"), pool.submit(write, "two"), pool.submit(fold)
        numbers = one.result() + two.result()
        assert folds.result() == sorted(folds.result())
    assert len(set(numbers)) == 4 and min(numbers) >= 1 and one.result() == sorted(one.result())
    want = {"z": ("first", False)} | {f"{n}{t}": (n, False) for n in ("one", "two") for t in (1, 2)}
    assert _dict(table.current()) == want
    assert table.append(_df(spark, ("one1", "again", False, 9)), 1, "one") == one.result()[0]  # a repeat
    table.compact()
    assert _dict(table.current()) == want and table.compact() == table.last_number()


def test_a_version_of_the_log_is_made_once(spark):
    log = CommitLog(spark, new_folder(spark, "log"), "no int")
    assert log.settled().count() == 0
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda i: log.commit(0, [{"no": i}]), range(8)))
    assert sum(got) == 1
    assert [tuple(r) for r in log.settled().collect()] == [(0, got.index(True))]
    assert log.commit(1, [{"no": 7}, {"no": 8}]) and not log.commit(1, [{"no": 9}])
    assert sorted(r.no for r in log.settled().where("version = 1").collect()) == [7, 8]


def test_a_lost_writer_goes_on_with_its_number_or_gets_a_later_one(spark):
    table = PostingTable(spark, new_folder(spark, "table"), SCHEMA, ["seq"], buckets=4)
    taken = lambda version, no, turn: table.log.commit(version, [{"kind": "taken", "no": no, "writer": "w", "turn": turn}])
    assert taken(0, 3, 0)  # lost before its folder was written
    with pytest.raises(ValueError, match="another writer"):
        table.append(_df(spark, ("a", "x", False, 1)), 3)
    assert table.append(_df(spark, ("a", "x", False, 1)), 0, "w") == 3
    assert taken(table._state().version + 1, 4, 1)
    table.append(_df(spark, ("b", "y", False, 1)), 5)
    assert table.compact() == 5
    assert table.append(_df(spark, ("b", "late", False, 1)), 1, "w") == 6  # 4 would come too late
    assert table.log.commit(table._state().version + 1, [{"kind": "folding", "no": 6}])  # a lost compaction
    assert table.compact() == 7 and _dict(table.current()) == {"a": ("x", False), "b": ("late", False)}
    assert table.delete(_ids(spark, "a"), 2, "w") == 8 and set(_dict(table.current())) == {"b"}


def test_streamed_orders_equal_their_sql_when_their_lines_come_from_many_files(spark, tmp_path):
    import duckdb

    from noticeboard import catalog

    catalog.load()
    folder = f"{tmp_path}/lineitem.parquet"
    spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").repartition(6).write.parquet(folder)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several staged files
    try:
        rows = catalog.QUERIES["stream_upsert"](spark, str(tmp_path))
        got = [tuple(r) for r in rows.collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{folder}/*.parquet')")
    theirs = con.execute(f"SELECT {', '.join(rows.columns)} FROM ({catalog.ORACLES['stream_upsert']})").fetchall()
    assert sorted(got) == sorted(theirs)
