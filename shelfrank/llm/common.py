"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.session import checkpoint_dir

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet into the shared checkpoint folder and read it back.

    The files outlive a lost executor, so nothing upstream is recomputed.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection of 64-bit words."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class TokenHashes(dict):
    """64-bit hash of a byte token, remembered; emptied when it holds ``limit`` tokens (a memory
    bound only: a token hashes to the same value again afterwards)."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, token: bytes) -> int:
        import xxhash
        if len(self) >= self.limit:
            self.clear()
        h = self[token] = xxhash.xxh3_64_intdigest(token)
        return h


def text_slices(batch: pa.RecordBatch, column: str, max_bytes: int = 4_000_000):
    """(first row, list of texts) in slices of about ``max_bytes``, so that the Python objects of
    a batch with long texts are never alive together."""
    col = batch.column(column)
    n, row = len(col), 0
    lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(col), 0))
    ends = np.cumsum(lengths)
    while row < n:
        base = ends[row - 1] if row else 0
        stop = max(row + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
        yield row, col.slice(row, stop - row).to_pylist()
        row = stop


def _fingerprint(edges: DataFrame):
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return r[0], r[1]


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected edge list (a, b): rows (node, component), the
    component being its smallest node. Nodes without an edge do not appear.

    Alternating large-star / small-star rounds; each is written to the shared folder. Every round
    is a grouped minimum (pre-aggregated before its shuffle) and an equi-join, so a hub is neither
    collected nor kept in one task.
    """
    e = (edges.where("a <> b")
         .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    e = written(e, "edges")
    before = _fingerprint(e)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = (both.groupBy("a").agg(F.min("b").alias("m"))
               .select("a", F.least("a", "m").alias("m")))
        large = (both.join(low, "a").where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        e = written(large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                    .union(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
        after = _fingerprint(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if a count proves it holds at most ``rows`` rows; without the
    hint, Spark joins by shuffle, so any size works."""
    return F.broadcast(df) if df.count() <= rows else df
