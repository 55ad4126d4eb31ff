"""Sharding by jump consistent hashing, in DataFrame expressions only.

Jump consistent hash (Lamping and Veach): the key seeds a linear congruential generator and every
draw says to which shard number the key would jump next while shards are appended one by one; the
last jump below the shard count is the key's shard. There is no ring table, and one more shard
takes rows only into itself.

Defined cases: a null key counts as key 0; a null text has no bytes (size 16, checksum 0); repeated
rows get the same shard and a slot each; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from shelfrank.llm.common import table
from shelfrank.llm.registry import query

# fixed values: multiplier 2862933555777941757 of the published generator, as two 32-bit halves
MUL_HIGH, MUL_LOW = 2862933555777941757 >> 32, 2862933555777941757 & 0xFFFFFFFF
LOW32 = 0xFFFFFFFF


def _next_state(high: Column, low: Column) -> tuple[Column, Column]:
    """key * multiplier + 1 modulo 2^64 on 32-bit halves; no partial product leaves 63 bits, so
    ANSI overflow checks hold."""
    l0, l1 = low.bitwiseAND(0xFFFF), F.shiftright(low, 16)
    t0, t1 = l0 * F.lit(MUL_LOW), l1 * F.lit(MUL_LOW)
    s = t0 + F.shiftleft(t1.bitwiseAND(0xFFFF), 16) + F.lit(1)
    carry = F.shiftright(s, 32) + F.shiftright(t1, 16)

    def product32(a: Column, b: int) -> Column:   # a * b modulo 2^32
        return ((a.bitwiseAND(0xFFFF) * F.lit(b))
                + F.shiftleft((F.shiftright(a, 16) * F.lit(b)).bitwiseAND(0xFFFF), 16)).bitwiseAND(LOW32)

    return ((carry + product32(high, MUL_LOW) + product32(low, MUL_HIGH)).bitwiseAND(LOW32),
            s.bitwiseAND(LOW32))


def jump_shards(key: Column, n_shards: int) -> Column:
    """struct(shard, grown): the shard of ``key`` among ``n_shards`` and among ``n_shards + 1``.

    A key jumps at most once per shard number, about ln(n) times on average; steps after the last
    jump only pass the state through.
    """
    k = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    zero = F.struct(F.shiftrightunsigned(k, 32).alias("high"), k.bitwiseAND(LOW32).alias("low"),
                    F.lit(-1).cast("long").alias("shard"), F.lit(0).cast("long").alias("next"))

    def step(s: Column, _: Column) -> Column:
        high, low = _next_state(s["high"], s["low"])
        # floor((b + 1) * 2^31 / ((key >> 33) + 1)) with b = the shard jumped to
        jump = F.floor((s["next"] + 1) * (F.lit(float(1 << 31)) / (F.shiftright(high, 1) + 1).cast("double")))
        moved = F.struct(high.alias("high"), low.alias("low"), s["next"].alias("shard"), jump.alias("next"))
        return F.when(s["next"] < n_shards, moved).otherwise(s)

    return F.aggregate(F.sequence(F.lit(1), F.lit(n_shards)), zero, step,
                       lambda s: F.struct(s["shard"].cast("int").alias("shard"),
                                          F.when(s["next"] == n_shards, F.lit(n_shards))
                                          .otherwise(s["shard"]).cast("int").alias("grown")))


def shard(df: DataFrame, key: str, n_shards: int, blocks: int = 256) -> DataFrame:
    """``df`` with ``shard``, ``grown_shard`` (with one shard more) and ``slot`` (0, 1, ... inside
    each shard). Columns of these names, and of the helper names that start with _, are replaced.

    Slots are numbered per (shard, block) with block = a hash of the row; the start of a block is
    the running sum over at most ``n_shards * blocks`` counts, which alone is broadcast. No task
    sorts a whole shard.
    """
    cols = [c for c in df.columns if c not in ("shard", "grown_shard", "slot", "_block", "_rank", "_start", "_n", "_j")]
    j = df.select(*cols).withColumn("_j", jump_shards(F.col(key), n_shards))
    j = j.select(*[j[c] for c in cols], F.col("_j.shard").alias("shard"), F.col("_j.grown").alias("grown_shard"),
                 F.pmod(F.xxhash64(*[j[c] for c in cols]), F.lit(blocks)).alias("_block"))
    counts = j.groupBy("shard", "_block").agg(F.count("*").alias("_n"))
    starts = counts.select("shard", "_block", F.coalesce(
        F.sum("_n").over(Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_start"))
    rank = F.row_number().over(Window.partitionBy("shard", "_block").orderBy(*cols))
    return (j.withColumn("_rank", rank).join(F.broadcast(starts), ["shard", "_block"])
            .select(*cols, "shard", "grown_shard", (F.col("_start") + F.col("_rank") - 1).alias("slot")))


@query("op7_jump_shards")
def op7_jump_shards(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"))
    return shard(docs, "doc_id", 40).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), "grown_shard")
