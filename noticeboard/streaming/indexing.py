"""Finished batches of postings, indexed while others are still being collected."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..sources.table import PostingTable


def _writer(spark: SparkSession, checkpoint: str) -> str:
    """The name under which a checkpoint's batches are written; it lives and goes with the checkpoint."""
    place = f"{checkpoint.rstrip('/')}/writer"
    try:
        return spark.read.schema("name string").parquet(place).first().name
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    name = uuid.uuid4().hex
    spark.createDataFrame([(name,)], "name string").coalesce(1).write.parquet(place)
    return name


def index_stream(
    spark: SparkSession, source: str, table: PostingTable, checkpoint: str, file_glob: str = "*", files_per_batch: int = 1000
) -> DataFrame:
    """Take all files waiting in ``source``, then fold them into the table's snapshot.

    A failed batch is retried under the same name and number, so the table gets each file's rows once.
    Several streams, each with a checkpoint of its own, may write one table.
    """
    writer = _writer(spark, checkpoint)
    stream = (
        spark.readStream.schema(table.schema)
        .option("pathGlobFilter", file_glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source)
    )

    query = (
        stream.writeStream.foreachBatch(lambda batch, no: table.append(batch, no, writer))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    table.compact()
    return table.current()
