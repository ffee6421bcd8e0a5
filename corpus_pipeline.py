"""Documents to token records: language, near copies, benchmark leaks, mixture, records.

Each stage takes all that its predecessor kept, as a table read from Parquet. No stage can be put in
SQL as a whole (learned models, fingerprints, token ids), so there is no ``ORACLE_SQL``; the stages and
their chain are tested against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeboard.llm import decontaminate, langid, mixing, records, simhash
from noticeboard.llm.common import unused
from noticeboard.session import written

ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter and texts of no one language go."""
    return langid.accept(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays: shingles of three words, two bits at most."""
    return simhash.deduplicate(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, in the order in which the sources' blocks are to be read: its files hold them in that order."""
    return mixing.arrange(docs)


def token_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of all texts in binary records, in the order of the mixture, described per document.

    The order is that of the rows in the files of ``docs``; a table that comes from no files goes by id.
    """
    if not docs.inputFiles():
        return records.tokenise(docs, public_tokenizers.path("word_bpe_49k.json"))
    part, name, row = (unused(docs, c) for c in ("part", "name", "row"))
    placed = docs.select(
        "doc_id",
        "text",
        F.expr("try_cast(regexp_extract(_metadata.file_name, '^part-([0-9]+)', 1) AS long)").alias(part),
        F.col("_metadata.file_name").alias(name),
        F.col("_metadata.row_index").alias(row),
    )
    return records.tokenise(placed, public_tokenizers.path("word_bpe_49k.json"), [part, name, row])


STAGES = [
    ("language ID", language),
    ("SimHash near-dedup", near_copies),
    ("benchmark decontamination", benchmark_leaks),
    ("mixing", mixture),
    ("token records", token_records),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each result is written and read again."""
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        table = written(stage(spark, table, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, table, sf_dir)
