"""Token ids in length-delimited binary records, with an offset index for reads in any order.

A record is: length of the data (8 bytes), masked CRC-32C of those, the data, masked CRC-32C of
the data (4 bytes each), all little-endian. The data are the ids of one document as unsigned 16-bit
integers, or 32-bit where the vocabulary needs them. Each task writes files of its own name; the
index, a Parquet table that Spark commits, names the file of every record, so what a lost or
repeated attempt leaves behind is never read.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import new_folder, written
from .common import SLICE, arrow_schema, filesystem, record_batch

END_ID = 1
_BLOCK = 512


def _tables() -> np.ndarray:
    """CRC-32C tables: [k][byte] is the effect of a byte that k further bytes follow."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0x82F63B78), table >> 1)
    tables = [table]
    for _ in range(_BLOCK - 1):
        tables.append(table[tables[-1] & 0xFF] ^ (tables[-1] >> 8))
    return np.array(tables)


_T = _tables()
# Effect of a whole block of zeros on each byte of the register.
_SHIFT = [[int(x) for x in _T[_BLOCK - 1 - k]] for k in range(4)]
_FIRST = [int(x) for x in _T[0]]


def _crc_short(data: bytes) -> int:
    crc = 0xFFFFFFFF
    for b in data:
        crc = _FIRST[(crc ^ b) & 0xFF] ^ (crc >> 8)
    return crc ^ 0xFFFFFFFF


def crc32c(datas: list[bytes]) -> list[int]:
    """CRC-32C of each of ``datas``: all their blocks at once, then one step per block to join them."""
    long = [i for i, d in enumerate(datas) if len(d) >= 64]
    out = [0 if len(d) >= 64 else _crc_short(d) for d in datas]
    if not long:
        return out
    counts = [-(-len(datas[i]) // _BLOCK) for i in long]
    padded = np.zeros(sum(counts) * _BLOCK, np.uint8)
    end = 0
    for i, n in zip(long, counts):
        end += n * _BLOCK
        start = end - len(datas[i])  # zeros in front change nothing while the register is zero
        padded[start:end] = np.frombuffer(datas[i], np.uint8)
        padded[start : start + 4] ^= 0xFF  # the register's start value
    blocks = padded.reshape(-1, _BLOCK)
    crc = np.zeros(len(blocks), np.uint32)
    for k in range(_BLOCK):
        crc ^= _T[_BLOCK - 1 - k][blocks[:, k]]
    values, at = crc.tolist(), 0
    s0, s1, s2, s3 = _SHIFT
    for i, n in zip(long, counts):
        c = 0
        for v in values[at : at + n]:
            c = s0[c & 0xFF] ^ s1[(c >> 8) & 0xFF] ^ s2[(c >> 16) & 0xFF] ^ s3[c >> 24] ^ v
        at += n
        out[i] = c ^ 0xFFFFFFFF
    return out


def masked(crc: int) -> int:
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


@lru_cache(100_000)
def _head(length: int) -> bytes:
    size = length.to_bytes(8, "little")
    return size + masked(_crc_short(size)).to_bytes(4, "little")


def frame(datas: list[bytes]) -> list[bytes]:
    return [b"".join((_head(len(d)), d, masked(c).to_bytes(4, "little"))) for d, c in zip(datas, crc32c(datas))]


def unframe(records: list[bytes]) -> list[bytes]:
    """The data of whole records; a wrong length or checksum fails."""
    datas = [r[12:-4] for r in records]
    for r, d, c in zip(records, datas, crc32c(datas)):
        if r[:12] != _head(len(d)) or int.from_bytes(r[-4:], "little") != masked(c):
            raise ValueError("broken record")
    return datas


_WIDE = re.compile("[^\u0000-\u00ff]")


def _latin(text: str) -> bool:
    """Only characters below U+0100: their lower case and their letters are the same to every library."""
    return text.isascii() or _WIDE.search(text) is None


class Encoder:
    """Ids of whole texts. Where the vocabulary drops blanks, no token reaches across one: it is then applied
    to the words between blanks, each at most once per worker as long as it is remembered."""

    #: Words remembered at least; memory is bounded by twice as many.
    KEPT = 250_000

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.kind = "<u2" if max(vocabulary.values()) < 1 << 16 else "<u4"
        self.by_word = self._ids(["a b"])[0] == b"".join(self._ids(["a", "b"])) and self._ids([" "]) == [b""]
        self.lowers = self._ids(["A", "\u00c9"]) == self._ids(["a", "\u00e9"])
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.has_ends = bool(self.ends.any())
        self.marks = {m: self._ids([m])[0] for m in ".,"}
        self.young: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return self._ids(texts)
        # Special tokens are told by their case, so texts that may hold one keep theirs.
        split = [(t.lower() if self.lowers and _latin(t) and "<|" not in t else t).replace("\n", " ").split(" ") for t in texts]
        young = self.young
        missing = set().union(*split).difference(young)
        self._learn(self._remember(missing))
        out = [b"".join(map(young.__getitem__, words)) for words in split]
        if len(young) > self.KEPT:
            self.young, self.old = {"": b""}, young
        return out

    def _remember(self, missing: set[str]) -> set[str]:
        """Take words back that were known of old; the others are given."""
        if not self.old:
            return missing
        young, old = self.young, self.old
        known = [w for w in missing if w in old]
        young.update(zip(known, map(old.__getitem__, known)))
        return missing.difference(known)

    def _learn(self, missing: set[str]) -> None:
        """Words of Latin letters are one piece each, so they are encoded in one text and cut at the ends of
        words; a full stop or comma after one is a piece of its own. All others are encoded one by one."""
        young = self.young
        letters, marked, rest = set(), [], []
        wide = _WIDE.search
        for w in missing:
            if not self.has_ends or not (w.isascii() or wide(w) is None):
                rest.append(w)
            elif w.isalpha():
                letters.add(w)
            elif w[-1] in self.marks and w[:-1].isalpha():
                marked.append(w)
            else:
                rest.append(w)
        cores = list(letters.union(self._remember({w[:-1] for w in marked}.difference(young))))
        if cores:
            (data,) = self._ids([" ".join(cores)])
            width = np.dtype(self.kind).itemsize
            cuts = (np.flatnonzero(self.ends[np.frombuffer(data, self.kind)]) + 1) * width
            if len(cuts) != len(cores):
                raise ValueError("a word of letters is not one piece in this vocabulary")
            ends = cuts.tolist()
            young.update(zip(cores, [data[a:b] for a, b in zip([0, *ends], ends)]))
        for w in marked:
            young[w] = young[w[:-1]] + self.marks[w[-1]]
        young.update(zip(rest, self._ids(rest)))


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


_INDEX = "shard int, doc_id long, file string, offset long, length long, width int, start_in_shard long, n_tokens long"


def write_records(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID) -> DataFrame:
    """Write the rows of ``docs`` (``doc_id``, ``text``) as they stand, a file per partition, and return
    the index: one row per record, ``shard`` being the number of the partition.

    A null text is an empty one: its record holds the end id alone. Nothing is dropped.
    """
    arrow = arrow_schema(_INDEX)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        width = np.dtype(encode.kind).itemsize
        end = end_id.to_bytes(width, "little")
        system, path = filesystem(folder)
        system.create_dir(path, recursive=True)
        shard = TaskContext.get().partitionId()
        name = f"{shard:06d}-{uuid.uuid4().hex}.rec"
        offset = start = 0
        out = None
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE):
                    part = batch.slice(at, SLICE).to_pydict()
                    datas = [d + end for d in encode.encode([t or "" for t in part["text"]])]
                    records = frame(datas)
                    out = out or system.open_output_stream(f"{path}/{name}")
                    out.write(b"".join(records))
                    rows = []
                    for doc_id, data, record in zip(part["doc_id"], datas, records):
                        n = len(data) // width
                        rows.append((shard, doc_id, name, offset, len(record), width, start, n))
                        offset += len(record)
                        start += n
                    yield record_batch(rows, arrow)
        finally:
            if out:
                out.close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return written(rows.mapInArrow(write, _INDEX), "record-index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that ``index`` names, in any order, with lengths and checksums verified: the index
    columns and ``ids`` (binary, unsigned 32-bit little-endian)."""
    out = _INDEX + ", ids binary"
    arrow = arrow_schema(out)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = filesystem(folder)
        name, source = None, None
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                rows = batch.slice(at, SLICE).to_pylist()
                records, run = [], []
                for row, after in zip(rows, [*rows[1:], None]):
                    run.append(row)
                    if after and after["file"] == row["file"] and after["offset"] == row["offset"] + row["length"]:
                        continue  # neighbours in the file are read together
                    if row["file"] != name:
                        if source:
                            source.close()
                        name, source = row["file"], system.open_input_file(f"{path}/{row['file']}")
                    begin = run[0]["offset"]
                    data = source.read_at(row["offset"] + row["length"] - begin, begin)
                    records += [data[r["offset"] - begin : r["offset"] - begin + r["length"]] for r in run]
                    run = []
                for row, data in zip(rows, unframe(records)):
                    row["ids"] = np.frombuffer(data, f"<u{row['width']}").astype("<u4").tobytes()
                yield record_batch([tuple(r.values()) for r in rows], arrow)
        if source:
            source.close()

    return index.select(*[c.split()[0] for c in _INDEX.split(", ")]).mapInArrow(read, out)


def _digest(read: DataFrame, index: DataFrame) -> DataFrame:
    """Per record its first id's place among all ids, its length and checksum."""
    totals = index.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    # One row per file written, not per document.
    before = totals.select("shard", (F.sum("total").over(W.orderBy("shard")) - F.col("total")).alias("before"))
    return read.join(before, "shard").select("doc_id", (F.col("before") + F.col("start_in_shard")).alias("start"), "n_tokens", "ids_crc32", "file", "offset")


def tokenise(docs: DataFrame, tokenizer: str, order: list[str] | None = None, folder: str | None = None) -> DataFrame:
    """Write all texts as records in the order of ``order`` (``doc_id`` if none), read the files back
    and describe every record: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``, ``file``, ``offset``.

    Rows without an id come first; rows with equal ids follow each other in the order of their texts'
    hashes; a null text is an empty one; no input rows, no files and no result. Rows are dealt by ranges
    of the order and sorted within them, never gathered; a text is held by one task at a time.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "records")
    keys = order or ["doc_id"]
    rows = docs.withColumn("__tie", F.xxhash64("text"))
    dealt = rows.repartitionByRange(*keys, "__tie").sortWithinPartitions(*keys, "__tie")
    index = write_records(dealt, tokenizer, folder)
    read = read_records(index, folder).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return _digest(read, index)
