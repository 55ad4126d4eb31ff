"""Map raw tables into the recommender roles.

Roles (frozen schemas):
  users  (user_idx long, segment string, user_attr_0 double, user_attr_1 double)
  items  (item_idx long, category string, price double, item_attr_0 double, brand string)
  log    (user_idx long, item_idx long, ts timestamp_ntz, relevance int,
          l_orderkey long, l_linenumber int)   -- the last two break ts ties
  events (user_idx long, item string, ts timestamp_ntz)

The log is a fact table; every later per-user operator orders it by
``ORDER_COLS`` so sequences are defined without a global sort.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.session import dealt

# Total order of a user's history: remaining ties share the item, so the
# item sequence is well defined.
ORDER_COLS = ["ts", "l_orderkey", "l_linenumber", "item_idx"]


def order_of(log_df: DataFrame) -> list[str]:
    """Total order of a history: the default columns as far as the log has them, then all others.

    A log without any time column (user, item, relevance) is ordered by its own values: a Spark
    table has no row index, so a caller with a meaningful order passes it as a column ``ts``.
    """
    first = [c for c in ORDER_COLS if c in log_df.columns]
    return first + [c for c in log_df.columns if c not in first and c != "user_idx"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_idx"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").cast("double").alias("user_attr_0"),
        F.col("c_nationkey").cast("double").alias("user_attr_1"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_idx"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("double").alias("price"),
        F.col("p_size").cast("double").alias("item_attr_0"),
        F.col("p_brand").alias("brand"),
    )


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interaction log = lineitem joined to its order (one shuffle on the order key, into as many
    partitions as the line items need)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    rows = li.count()         # from the files' footers
    large = od.count() > 1_000_000
    li, od = dealt(li, rows, "l_orderkey"), dealt(od, rows, "o_orderkey")
    od = od.hint("merge") if large else od      # in few bytes of file, but not in memory
    return li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("o_custkey").alias("user_idx"),
        F.col("l_partkey").alias("item_idx"),
        F.col("o_orderdate").alias("ts"),
        (F.col("l_returnflag") != F.lit("R")).cast("int").alias("relevance"),
        F.col("l_orderkey"),
        F.col("l_linenumber"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short-alphabet sequence log: event types play the item role."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("user_idx"),
        F.col("event_type").alias("item"),
        F.col("ts"),
        F.col("event_id"),
    )


@dataclass
class Roles:
    users: DataFrame
    items: DataFrame
    log: DataFrame


def load(spark: SparkSession, sf_dir: str) -> Roles:
    """The three role frames of one data directory."""
    return Roles(users(spark, sf_dir), items(spark, sf_dir), log(spark, sf_dir))


def with_position(log_df: DataFrame, order_cols=None) -> DataFrame:
    """1-based position of each interaction in its user's history."""
    from shelfrank.functions.histories import with_previous

    return with_previous(log_df, 0, order_cols or order_of(log_df)).withColumnRenamed("_rn", "pos")


def append_after(old: DataFrame, new: DataFrame, order_cols=None) -> DataFrame:
    """P10: give an appended log index-style timestamps after the old one.

    The old log keeps ``tindex`` 0..n-1 in its total order and the new rows
    continue at max+1.  Uses the distributed dense index of
    ``functions.ranks.global_index``, not a single-partition window.
    """
    from shelfrank.functions.ranks import global_index

    order_cols = order_cols or order_of(old)
    o = global_index(old, order_cols, "tindex")
    # one scalar: the old log's size (= max index + 1)
    base = o.count()
    n = global_index(new, order_cols, "tindex")
    n = n.withColumn("tindex", F.col("tindex") + F.lit(base))
    return o.unionByName(n)


def write_recs(recs: DataFrame, path: str, model: str, mode: str = "append") -> None:
    """Recommendation sink, one parquet folder partitioned by model."""
    (recs.withColumn("model", F.lit(model))
     .write.mode(mode).partitionBy("model").parquet(path))
