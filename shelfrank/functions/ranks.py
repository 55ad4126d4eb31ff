"""Ranks and top-k without a global single-task sort.

``top_k`` is ``row_number() <= k`` over a per-key window; Catalyst turns the
filter into a partial ``WindowGroupLimit`` below the shuffle, so each map task
forwards at most k rows per key - a hot user never reaches the exchange with
more than k rows per task.

``top_k_unseen_global`` answers "top k items of one global ranking that the
user has not seen" without a users x items product and without candidate rows:
before a user's i-th seen rank r_i lie r_i - i unseen ones, so its j-th unseen
rank is j + the number of seen ranks with r_i - i < j.  Those counts (at most k
per user) come from one window over the seen ranks, spilled to disk if long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from shelfrank.session import dealt


def top_k(df: DataFrame, k: int, partition_cols, order_exprs, rank_col: str = "rank") -> DataFrame:
    """First k rows per key by an explicit total order (ties broken by the caller)."""
    w = Window.partitionBy(*partition_cols).orderBy(*order_exprs)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def global_index(df: DataFrame, order_cols, name: str = "gidx", descending=None) -> DataFrame:
    """Dense 0-based position in a global order, computed distributedly, JVM-side.

    A range-partitioned sort, then ``monotonically_increasing_id`` (partition
    index in the high bits, position within the partition in the low bits);
    each partition's offset is the running total of the partition counts (one
    row per partition, broadcast).  No task ever holds the whole table, and no
    row goes through Python.  The sorted frame is cached so the counts and the
    numbering read the same partitions; the order is total, so a recomputation
    after a lost executor numbers the rows identically.
    """
    from pyspark.storagelevel import StorageLevel
    descending = descending or [False] * len(order_cols)
    exprs = [F.col(c).desc() if d else F.col(c).asc() for c, d in zip(order_cols, descending)]
    low = (1 << 33) - 1
    srt = (df.orderBy(*exprs).withColumn("_mid", F.monotonically_increasing_id())
           .persist(StorageLevel.MEMORY_AND_DISK))
    # fill the cache before the two readers below: both must see the same
    # partitions (a lazily cached frame could be recomputed per branch, and the
    # partition ids of two independent range shuffles need not agree)
    srt.count()
    part = F.shiftright(F.col("_mid"), 33)
    counts = srt.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_c"))
    offs = counts.select("_p", (F.sum("_c").over(Window.orderBy("_p")) - F.col("_c")).alias("_off"))
    out = (srt.withColumn("_p", part).join(F.broadcast(offs), "_p")
           .withColumn(name, (F.col("_off") + F.col("_mid").bitwiseAND(F.lit(low))).cast("long"))
           .drop("_p", "_off", "_mid"))
    # filled once and cached: every later reader sees these numbers; a block
    # lost with an executor is recomputed from the same sorted partitions
    # (total order, ids from partition index and position), so it is identical
    out = out.persist(StorageLevel.MEMORY_AND_DISK)
    out.count()
    srt.unpersist()
    return out


def rank_items(scored: DataFrame, score_col: str, keys=(), rank_col: str = "grank") -> DataFrame:
    """1-based dense rank by score desc, item_idx asc, within each key group.

    One distributed sort over (keys, score, item); the per-group offset is the
    group's smallest global index (a groupBy, not a window over everything).
    """
    keys = list(keys)
    g = global_index(scored, keys + [score_col, "item_idx"], "_gi",
                     [False] * len(keys) + [True, False])
    if not keys:
        return g.withColumn(rank_col, F.col("_gi") + 1).drop("_gi")
    off = g.groupBy(*keys).agg(F.min("_gi").alias("_off"))
    return (g.join(F.broadcast(off) if keys == ["iter"] else off, keys)   # one row per iteration
            .withColumn(rank_col, F.col("_gi") - F.col("_off") + 1).drop("_gi", "_off"))


GAPS = "array<struct<_d: bigint, _c: bigint>>"


def gap_lists(placed: DataFrame, k: int, keys) -> DataFrame:
    """(keys, _gaps): how often each _d < k occurs in ``placed`` (keys, _d = seen rank - its place among the seen)."""
    return (placed.where(F.col("_d") < k).groupBy(*keys, "_d").agg(F.count(F.lit(1)).alias("_c"))
            .groupBy(*keys).agg(F.collect_list(F.struct(F.col("_d").cast("long").alias("_d"), "_c")).alias("_gaps")))


def unseen_ranks(k: int):
    """The first k unseen ranks of a row's ``_gaps`` (null: nothing seen)."""
    known = F.coalesce("_gaps", F.array().cast(GAPS))
    return F.transform(F.sequence(F.lit(1).cast("long"), F.lit(k).cast("long")), lambda j: j + F.aggregate(
        F.filter(known, lambda g: g["_d"] < j), F.lit(0).cast("long"), lambda n, g: n + g["_c"]))


def top_k_unseen_global(ranked: DataFrame, users_df: DataFrame, seen: DataFrame | None,
                        k: int, keys=(), rank_col: str = "grank", copies: int = 64,
                        distinct: bool = False) -> DataFrame:
    """Top k of a user-independent ranking per (keys, user), seen items skipped.

    ``ranked``: (keys..., item_idx, <rank_col> 1-based dense, ...).
    ``users_df``: (keys..., user_idx) - who gets recommendations.
    ``seen``: (keys..., user_idx, item_idx) or None.
    ``distinct``: the caller's ``users_df`` and ``seen`` hold no row twice.
    Returns (keys..., user_idx, item_idx, rank, <ranked columns>).  Exact: the
    j-th unseen rank is at most j + |seen_u|, and ranks beyond the item count
    simply find no item.
    """
    keys = list(keys)
    once = (lambda df: df) if distinct else DataFrame.distinct
    u = once(users_df.select(*keys, "user_idx"))
    if keys:
        n = ranked.groupBy(*keys).agg(F.max(rank_col).alias("_n"))
        u = u.join(F.broadcast(n) if keys == ["iter"] else n, keys)   # one row per iteration
    else:
        # one scalar: the ranking's length (the ranked frame is cached)
        u = u.withColumn("_n", F.lit(ranked.count()).cast("long"))
    if seen is None:
        base = u.withColumn("_gaps", F.lit(None).cast(GAPS))
    else:
        user = Window.partitionBy(*keys, "user_idx").orderBy(rank_col)
        placed = (once(seen.select(*keys, "user_idx", "item_idx"))
                  .join(ranked.select(*keys, "item_idx", rank_col), keys + ["item_idx"])
                  .select(*keys, "user_idx", rank_col))
        gaps = gap_lists(dealt(placed, seen.count(), *keys, "user_idx")
                         .select(*keys, "user_idx", (F.col(rank_col) - F.row_number().over(user)).alias("_d")), k, keys + ["user_idx"])
        base = u.join(gaps, keys + ["user_idx"], "left")
    best = base.select(*keys, "user_idx", F.posexplode(F.filter(unseen_ranks(k), lambda r: r <= F.col("_n"))).alias("rank", rank_col)
                       ).withColumn("rank", F.col("rank") + 1)
    # nearly all users meet on the first ranks: spread those over ``copies`` copies of their few rows
    head = F.when(F.col(rank_col) <= 4 * k + 64, F.lit(copies)).otherwise(F.lit(1))
    spread = ranked.withColumn("_copy", F.explode(F.sequence(F.lit(0), head - 1)))
    met = best.withColumn("_copy", F.pmod(F.xxhash64("user_idx"), head).cast("int"))
    return met.join(spread, keys + [rank_col, "_copy"]).drop("_copy")
