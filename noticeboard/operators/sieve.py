"""A sieve for rows by the values of a column, sized by how many values are wanted.

Where wide rows are to be cut down to those with one of many keys, a join would move the wide rows.
A sieve lets all rows with one of the keys pass, and few others, where they are read; what comes
after narrows down further. It is a Bloom filter dealt into blocks by hash: a small table of
blocks, sent to every task up to a stated size, and a row looks into the one block of its value.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# With so many bits a key and four marks in them, about 0.24 % of other values pass.
BITS_PER_KEY = 16
_MARKS = 4
# A block is an array of 64-bit words.
_WORDS = 512
_BLOCK_BITS = 64 * _WORDS
_PLACE_BITS = int(math.log2(_BLOCK_BITS))
# Blocks of 4 KiB, 128 MiB in all: some 67 million keys. More keys than that let more rows pass, never fewer.
MOST_BLOCKS = 1 << 15


def blocks_for(keys: int) -> int:
    return min(max(1, math.ceil(keys * BITS_PER_KEY / _BLOCK_BITS)), MOST_BLOCKS)


def _block(value: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(blocks))


def _places(value: Column) -> list[Column]:
    """Bit positions in the block, from a hash of its own."""
    marks = F.xxhash64(value, F.lit(1))
    return [F.shiftrightunsigned(marks, n * _PLACE_BITS).bitwiseAND(F.lit(_BLOCK_BITS - 1)) for n in range(_MARKS)]


def _word(place: Column) -> Column:
    return F.shiftright(place, 6).cast("int")


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(F.lit(63)).cast("int"))


def filter_blocks(keys: DataFrame, column: str, blocks: int) -> DataFrame:
    """The filter as rows: ``block`` and its ``words``. Marks are put together map-side before they are shuffled."""
    wanted = keys.where(F.col(column).isNotNull())
    places = wanted.select(_block(F.col(column), blocks).alias("block"), F.explode(F.array(*_places(F.col(column)))).alias("place"))
    marks = places.select("block", _word(F.col("place")).alias("word"), _bit(F.col("place")).alias("bits"))
    unmarked = keys.sparkSession.range(blocks * _WORDS).select(
        F.floor(F.col("id") / _WORDS).alias("block"), (F.col("id") % _WORDS).cast("int").alias("word"), F.lit(0).cast("bigint").alias("bits")
    )
    words = marks.unionAll(unmarked).groupBy("block", "word").agg(F.bit_or("bits").alias("bits"))
    return words.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).getField("bits").alias("words"))


def sifted(rows: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose value is among the keys, and a small share of others; rows without a value go.

    ``keys`` are read twice: they are counted first, which sizes the filter.
    """
    count = keys.agg(F.approx_count_distinct(key)).first()[0]
    blocks = blocks_for(count)
    held = filter_blocks(keys, key, blocks).select(F.col("block").alias("__block"), F.col("words").alias("__words"))
    value = F.col(column)
    marked = [F.get(F.col("__words"), _word(p)).bitwiseAND(_bit(p)) != 0 for p in _places(value)]
    passing = value.isNotNull() & (_block(value, blocks) == F.col("__block"))
    for test in marked:
        passing = passing & test
    return rows.join(F.broadcast(held), passing).drop("__block", "__words")  # at most MOST_BLOCKS rows of 4 KiB
