"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app_name: str = "shelfrank") -> SparkSession:
    """Session with AQE on, UI off and Arrow enabled.

    With a ``master`` (a local run) the shuffle partitions and the driver's memory are set here; on
    a cluster ``master`` stays None and whatever the cluster has configured is left as it is.
    """
    b = (SparkSession.builder.appName(app_name)
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    if master:
        b = (b.master(master).config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.driver.memory", os.environ.get("SHELFRANK_DRIVER_MEM", "16g")))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for ``checkpoint()`` and written intermediate tables.

    Read from ``spark.checkpoint.dir``. A session without it gets a scratch folder only if driver
    and executors are one process (a local master); elsewhere this raises, as executors could not
    see a folder of the driver's machine.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="shelfrank-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def data_partitions(n_rows: int, rows_per_partition: int) -> int:
    """Shuffle partitions for ``n_rows``: by the data alone, without a cap."""
    return max(1, -(-int(n_rows) // rows_per_partition))


ROWS_PER_TASK = 250_000     # rows that a task sorts, joins or groups, about
LIGHT = 4                   # tables of so many tasks' rows are left to the session's settings


def wide_enough(spark, rows: int) -> int | None:
    """The number of tasks that ``rows`` rows need, or None if they are few.

    Later shuffles of the session begin with as many partitions at least, joined by the adaptive planner
    up to 8 MB (if the session sets no size itself): with a fixed number a task grows with the input, and
    64 MB of compressed rows can be several GB in a window or a join.
    """
    if rows <= LIGHT * ROWS_PER_TASK:
        return None
    n = data_partitions(rows, ROWS_PER_TASK)
    first, size = (f"spark.sql.adaptive.{x}" for x in ("coalescePartitions.initialPartitionNum",
                                                       "advisoryPartitionSizeInBytes"))
    for name in ["spark.sql.shuffle.partitions"] + ([first] if spark.conf.get(first, None) else []):
        if n > int(spark.conf.get(name)):
            spark.conf.set(name, str(n))
    if not spark.conf.get(size, None):
        spark.conf.set(size, "8m")
    return n


def dealt(df, rows: int, *keys: str):
    """``df`` of about ``rows`` rows dealt by ``keys`` over as many tasks as they need, whatever the size
    in bytes of a row's compressed form; left as it is if the rows are few."""
    n = wide_enough(df.sparkSession, rows)
    return df.repartition(n, *keys) if n else df


def sized(df, rows: int = 100_000):
    """``df`` as the right side of a join: broadcast up to ``rows`` rows, else sorted and merged. Spark goes by
    the size of files, and rows in memory, let alone computed or exploded ones on either side, can be many
    times as large; a hint also keeps it from broadcasting the other side."""
    return df.hint("merge") if df.count() > rows else df.hint("broadcast")


def stored(df):
    """Cut lineage: ``df`` as Parquet in the shared checkpoint folder, written once and read from there."""
    path = f"{checkpoint_dir(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df):
    """Cut lineage: write ``df`` to the shared checkpoint folder and read it from there.

    The frame is persisted first so the checkpoint write does not recompute
    the whole lineage a second time; the cache is dropped afterwards.
    """
    from pyspark.storagelevel import StorageLevel
    checkpoint_dir(df.sparkSession)   # sessions created elsewhere may not have one yet
    df.persist(StorageLevel.MEMORY_AND_DISK)
    out = df.checkpoint(eager=True)
    df.unpersist()
    return out
