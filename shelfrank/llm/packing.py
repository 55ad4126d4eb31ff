"""Token ids in binary form: best-fit-decreasing packing of documents into fixed-length rows.

Texts become ids of a public vocabulary (byte-level BPE, or SentencePiece pieces). A document longer than a row is split into whole rows and a rest,
without loss. Inside blocks of about ``block_tokens`` ids a task places the pieces longest first,
each into the fullest row that still has room; a segment tree over free capacities finds that row
in log2(row length) steps. Each block becomes one matrix of ids (rows x length, little-endian,
padded) with the cumulative segment lengths, the positions at which position ids start again, and
for every segment its document, its offset there and its place.

Blocks are cut from a partition's rows in order, so packing needs no shuffle; a lost task is
repeated with the same result.

Defined cases: a null or empty text is a segment of length 0, so no document is lost; texts are
encoded whole; rows that repeat a doc_id are packed each, a null doc_id is kept; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.common import table, text_slices
from shelfrank.llm.registry import query
from shelfrank.llm.sentencepiece import file_bytes

ROW_LENGTH, BLOCK_TOKENS = 2048, 1_000_000
RANKS_FILE = "/opt/tokenizers/byte_bpe_50k.tiktoken"   # default of the parameter ``ranks_file``
# fixed value: how the vocabulary's makers split a text before merging
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteBpe:
    """Byte-level BPE ranks; plain data that is shipped to the tasks once. Any text can be encoded
    and comes back byte for byte."""

    def __init__(self, raw: bytes, pattern: str = PATTERN):
        self.raw, self.pattern = raw, pattern

    @classmethod
    def load(cls, spark, ranks_file: str = RANKS_FILE) -> ByteBpe:
        return cls(file_bytes(spark, ranks_file))

    def open(self) -> ByteBpeEncoder:
        return ByteBpeEncoder(self)


class ByteBpeEncoder:
    def __init__(self, model: ByteBpe):
        import tiktoken
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, model.raw.splitlines())}
        self.bpe = tiktoken.Encoding("ranks", pat_str=model.pattern, mergeable_ranks=ranks, special_tokens={})
        self.width = "<u2" if max(ranks.values()) < 65536 else "<i4"

    def encode(self, text: str | None) -> np.ndarray:
        return np.array(self.bpe.encode_ordinary(text or ""), self.width)

    def decode(self, ids) -> str:
        return self.bpe.decode(list(ids))


class FreeCapacity:
    """Segment tree over capacities 0..size: which of them some open row has left."""

    def __init__(self, size: int):
        self.leaves = 1 << (size + 1 - 1).bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        i = capacity + self.leaves
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """(capacity, row) with the smallest capacity >= ``least``, removed; None if there is none."""
        i = least + self.leaves
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):   # up to the first right sibling in use
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        capacity = i - self.leaves
        while i:
            self.count[i] -= 1
            i >>= 1
        return capacity, self.rows[capacity].pop()


def best_fit_decreasing(lengths: np.ndarray, row_length: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(row, start in the row) of every piece and the number of rows; pieces are at most a row long."""
    row, start = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    free, n = FreeCapacity(row_length), 0
    for k in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[k])
        got = free.take(size) if size else None
        if got is None:
            if not size and n:
                continue                    # nothing to place: it stands at the start of row 0
            got, n = (row_length, n), n + 1
        capacity, row[k] = got
        start[k] = row_length - capacity
        if capacity > size:
            free.add(capacity - size, int(row[k]))
    return row, start, n


def pack_block(docs: list[tuple[object, np.ndarray]], row_length: int, pad: int, dtype: str) -> dict:
    """One matrix of the documents (key, ids)."""
    owner, offset, length = [], [], []
    for d, (_, ids) in enumerate(docs):
        for o in range(0, max(1, len(ids)), row_length):
            owner.append(d), offset.append(o), length.append(min(row_length, len(ids) - o))
    lengths = np.array(length, np.int64)
    row, start, n = best_fit_decreasing(lengths, row_length)
    matrix = np.full((n, row_length), pad, dtype)
    for k, d in enumerate(owner):
        matrix[row[k], start[k]:start[k] + length[k]] = docs[d][1][offset[k]:offset[k] + length[k]]
    order = np.lexsort((lengths, start, row))
    real = order[lengths[order] > 0]
    return {"n_rows": n, "row_length": row_length, "n_tokens": int(lengths.sum()), "ids": matrix.tobytes(),
            "cu_seqlens": np.r_[0, np.cumsum(lengths[real])].tolist(),
            "resets": (row[real] * row_length + start[real]).tolist(),
            "segments": [{"doc_id": docs[owner[k]][0], "offset": offset[k], "row": int(row[k]),
                          "start": int(start[k]), "length": length[k]} for k in order]}


SCHEMA = ("partition int, block int, n_rows int, row_length int, n_tokens long, ids binary, cu_seqlens array<long>, "
          "resets array<long>, segments array<struct<doc_id:long,offset:long,row:int,start:int,length:int>>")
_ARROW = pa.schema([("partition", pa.int32()), ("block", pa.int32()), ("n_rows", pa.int32()), ("row_length", pa.int32()),
                    ("n_tokens", pa.int64()), ("ids", pa.binary()), ("cu_seqlens", pa.list_(pa.int64())),
                    ("resets", pa.list_(pa.int64())),
                    ("segments", pa.list_(pa.struct([("doc_id", pa.int64()), ("offset", pa.int64()), ("row", pa.int32()),
                                                     ("start", pa.int32()), ("length", pa.int32())])))])


def pack(docs: DataFrame, model, row_length: int = ROW_LENGTH, block_tokens: int = BLOCK_TOKENS,
         pad: int = 0, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per matrix; ``unpack`` gives the documents' ids again. ``model`` is plain data whose
    ``open()`` gives a task its encoder (``encode`` and ``width``)."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        e = shipped.value.open()
        part, block, held, size = TaskContext.get().partitionId(), 0, [], 0

        def out():
            return pa.RecordBatch.from_pylist(
                [{"partition": part, "block": block, **pack_block(held, row_length, pad, e.width)}], _ARROW)

        for batch in batches:
            keys = batch.column(key).to_pylist()
            for at, texts in text_slices(batch, text, 2_000_000):
                for k, t in zip(keys[at:at + len(texts)], texts, strict=True):
                    ids = e.encode(t)
                    held.append((k, ids))
                    size += len(ids)
                    if size >= block_tokens:
                        yield out()
                        block, held, size = block + 1, [], 0
        if held:
            yield out()

    return docs.select(F.col(key).cast("long").alias(key), F.col(text).alias(text)).mapInArrow(run, SCHEMA)


def unpack(packed: DataFrame, dtype: str = "<u2") -> DataFrame:
    """(partition, block, doc_id, offset, ids) of every segment, read from the matrices."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                m = np.frombuffer(r["ids"], dtype).reshape(r["n_rows"], r["row_length"])
                s = r["segments"]
                yield pa.RecordBatch.from_pydict({
                    "partition": [r["partition"]] * len(s), "block": [r["block"]] * len(s),
                    "doc_id": [x["doc_id"] for x in s], "offset": [x["offset"] for x in s],
                    "ids": [m[x["row"], x["start"]:x["start"] + x["length"]].astype(np.int32) for x in s]},
                    pa.schema([("partition", pa.int32()), ("block", pa.int32()), ("doc_id", pa.int64()),
                               ("offset", pa.int64()), ("ids", pa.list_(pa.int32()))]))

    return packed.mapInArrow(run, "partition int, block int, doc_id long, offset long, ids array<int>")


def write(packed: DataFrame, path: str) -> None:
    """The matrices and their indexes as Parquet files in a store that Spark reaches."""
    packed.write.mode("errorifexists").parquet(path)


@query("op5_packed_tokens")
def op5_packed_tokens(spark, sf_dir, ranks_file: str = RANKS_FILE):
    return pack(table(spark, sf_dir, "documents"), ByteBpe.load(spark, ranks_file))
