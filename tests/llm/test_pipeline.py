"""The pipeline: each stage on its own input, and the chain, against brute force."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from noticeboard.llm import langid, mixing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The input and the result of every stage, read from Parquet."""
    folder = tmp_path_factory.mktemp("stages")
    table, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, table, SF).write.parquet(f"{folder}/{i}")
        out.append((table, spark.read.parquet(f"{folder}/{i}")))
        table = out[-1][1]
    return out


def test_all_but_the_last_keep_the_columns(spark, stages):
    columns = spark.read.parquet(f"{SF}/documents.parquet").dtypes
    assert all(after.dtypes == columns for _, after in stages[:-1])


def _ids(df):
    return [r.doc_id for r in df.select("doc_id").collect()]


def test_language(stages):
    before, after = stages[0]
    judged = langid.identify(before).collect()
    assert set(_ids(after)) == {r.doc_id for r in judged if r.lang_pred != "und" and r.score >= langid.LEAST_SCORE}


def test_near_copies(stages):
    from .test_simhash import _brute_kept

    rows = stages[1][0].orderBy("doc_id").collect()
    kept = _brute_kept([r.text for r in rows])
    assert sorted(_ids(stages[1][1])) == [rows[i].doc_id for i in sorted(kept)]


def test_benchmark_leaks(spark, stages):
    before, after = stages[2]
    items = [r.text.lower() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {r.doc_id for r in before.collect() if any(i in r.text.lower() for i in items)}
    assert leaked and leaked <= set(_ids(before)) - set(_ids(after))


def test_mixture(stages):
    before, after = stages[3]
    assert sorted(_ids(after)) == sorted(_ids(before))
    place = {r.doc_id: r.position for r in mixing.mix(before.selectExpr("doc_id", "source", "xxhash64(text) AS tag"), tag="tag").collect()}
    rows = after.select("doc_id", "_metadata.file_name", "_metadata.row_index").collect()
    rows.sort(key=lambda r: (r.file_name, r.row_index))
    assert [place[r.doc_id] for r in rows] == list(range(len(rows)))


def test_token_records(stages):
    before, after = stages[4]
    rows = before.select("doc_id", "text", "_metadata.file_name", "_metadata.row_index").collect()
    rows.sort(key=lambda r: (r.file_name, r.row_index))
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, start = [], 0
    for r in rows:
        ids = np.array([*tokenizer.encode(r.text, add_special_tokens=False).ids, 1], "<u4")
        want.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in after.orderBy("start").collect()] == want


def test_the_chain(spark, stages):
    got = corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, stages[-1][1].select("doc_id", "n_tokens", "ids_crc32").collect()))


def test_stages_take_odd_rows(spark, documents):
    rows = [(i, t, lang, "s") for i, (t, lang) in enumerate([("the cat is here today", "en"), ("der hund ist da heute", "de")] * 8)]
    rows += [(None, "the cat is", "en", None), (None, None, None, None), (50, None, "en", "s"), (51, "", None, "s"), (52, "the cat " * 20_000, "en", "s"), (0, rows[0][1], "en", "s")]
    for frame in (documents(rows), documents([])):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, SF)
            assert out.count() <= frame.count()
            if stage is not corpus_pipeline.token_records:
                assert out.columns == frame.columns
    assert corpus_pipeline.token_records(spark, documents(rows), SF).filter(F.col("doc_id").isNull()).count() == 2
