"""Data profiling as plain aggregations.

Each profile is one Spark job over the table (partial aggregation map-side);
small results stay DataFrames; global scalars (totals, min/max) are one-row
aggregates that enter the next expression as literals.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from shelfrank.functions.exprs import r6


def _count(df: DataFrame) -> int:
    """One scalar: the row count (global aggregate, partial per task)."""
    return df.count()


def table_counts(named: dict[str, DataFrame]) -> DataFrame:
    """A1: (table_name, n_rows) for each named frame."""
    out = None
    for name, df in named.items():
        part = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = part if out is None else out.unionByName(part)
    return out


def share(df: DataFrame, col: str) -> DataFrame:
    """A2: count and percentage of all rows per level (the total is one scalar, no
    single-partition window over the levels)."""
    from pyspark.storagelevel import StorageLevel
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).persist(StorageLevel.MEMORY_AND_DISK)
    total = g.agg(F.sum("n")).first()[0] or 0   # from the per-level table, not a rescan
    return g.select(col, "n", r6(F.col("n") * 100.0 / F.lit(total)).alias("pct"))


def density(log_df: DataFrame, users_df: DataFrame, items_df: DataFrame) -> DataFrame:
    """A3: interactions / (users x items) * 100."""
    n_users, n_items = _count(users_df), _count(items_df)
    a = log_df.agg(F.count(F.lit(1)).alias("n_interactions"))
    return a.select("n_interactions", F.lit(n_users).cast("long").alias("n_users"),
                    F.lit(n_items).cast("long").alias("n_items"),
                    r6(F.col("n_interactions") / F.lit(n_users * n_items).cast("double") * 100.0)
                    .alias("density_pct"))


def coverage(log_df: DataFrame, users_df: DataFrame, items_df: DataFrame) -> DataFrame:
    """A4: distinct users/items that interacted, and their share of all."""
    n_users, n_items = _count(users_df), _count(items_df)
    a = log_df.agg(F.countDistinct("user_idx").alias("active_users"),
                   F.countDistinct("item_idx").alias("active_items"))
    return a.select("active_users", "active_items",
                    r6(F.col("active_users") * 100.0 / F.lit(n_users)).alias("pct_users"),
                    r6(F.col("active_items") * 100.0 / F.lit(n_items)).alias("pct_items"))


def coverage_sketches(log_df: DataFrame, slice_col, lg_nom: int = 12) -> DataFrame:
    """A4, approximate: per slice (slice, users, items) one mergeable distinct-count sketch of either
    side (2^lg_nom registers, relative standard error about 1.04 / sqrt(2^lg_nom)). Kept sketches of
    old slices and those of a new one give any union without reading old rows again."""
    s = F.col(slice_col) if isinstance(slice_col, str) else slice_col
    return log_df.groupBy(s.alias("slice")).agg(F.hll_sketch_agg("user_idx", lg_nom).alias("users"),
                                                F.hll_sketch_agg("item_idx", lg_nom).alias("items"))


def coverage_until(sketches: DataFrame) -> DataFrame:
    """(slice, active_users, active_items): distinct counts over all slices up to each one, from the
    sketches alone (one row per slice; each is handed to the slices behind it)."""
    ends = sketches.select("slice").distinct().agg(F.sort_array(F.collect_set("slice")).alias("ends")).first()["ends"]
    later = F.filter(F.array(*[F.lit(e) for e in ends]), lambda e: e >= F.col("slice")) if ends else F.array()
    spread = sketches.select(F.explode(later).alias("until"), "users", "items") if ends else sketches.select(
        F.col("slice").alias("until"), "users", "items")
    return spread.groupBy(F.col("until").alias("slice")).agg(
        F.hll_sketch_estimate(F.hll_union_agg("users")).alias("active_users"),
        F.hll_sketch_estimate(F.hll_union_agg("items")).alias("active_items"))


def exact_coverage_until(log_df: DataFrame, slice_col) -> DataFrame:
    """A4 cumulatively and exactly: a user (item) counts from the first slice that holds it."""
    s = F.col(slice_col) if isinstance(slice_col, str) else slice_col
    rows = log_df.select("user_idx", "item_idx", s.alias("slice"))
    first = None
    for c in ("user_idx", "item_idx"):
        part = rows.where(F.col(c).isNotNull()).groupBy(c).agg(F.min("slice").alias("slice")).groupBy("slice").agg(
            F.count("*").alias("n")).select("slice", F.lit(c).alias("side"), "n")
        first = part if first is None else first.unionByName(part)
    per = rows.select("slice").distinct().join(
        first.groupBy("slice").agg(*[F.sum(F.when(F.col("side") == c, F.col("n"))).alias(c) for c in ("user_idx", "item_idx")]),
        "slice", "left")
    upto = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)    # one row per slice
    return per.select("slice", *[F.coalesce(F.sum(c).over(upto), F.lit(0)).cast("long").alias(n)
                                 for c, n in (("user_idx", "active_users"), ("item_idx", "active_items"))])


def counts_by(df: DataFrame, *cols: str) -> DataFrame:
    """Interactions per key."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def enrich_log(log_df: DataFrame, users_df: DataFrame, items_df: DataFrame) -> DataFrame:
    """Log with the user's segment and the item's category (pruned projections)."""
    return (log_df.join(users_df.select("user_idx", "segment"), "user_idx")
            .join(items_df.select("item_idx", "category"), "item_idx"))


def segment_category_pivot(enriched: DataFrame, categories) -> DataFrame:
    """Segment rows x category columns, missing combinations -> 0. The columns are the given
    ``categories``: the levels of the dimension, whether the log holds them or not."""
    return enriched.groupBy("segment").pivot("category", list(categories)).count().na.fill(0)


def _bins(x, lo, hi, n_bins: int):
    """Equal-width bin of x over [lo, hi], last bin closed; lo == hi uses [lo-0.5, hi+0.5]."""
    same = hi == lo
    lo2 = F.when(same, lo - 0.5).otherwise(lo)
    hi2 = F.when(same, hi + 0.5).otherwise(hi)
    b = F.floor((x - lo2) / (hi2 - lo2) * n_bins).cast("int")
    return F.least(b, F.lit(n_bins - 1)), lo2, hi2


def histogram(df: DataFrame, col: str, n_bins: int, group: str | None = None) -> DataFrame:
    """Equal-width histogram, every bin listed (empty bins n = 0).

    With ``group`` the range is each group's own min..max (per-group stats are
    one row per group and join back on the group key).
    """
    keys = [group] if group else []
    vals = df.select(*keys, F.col(col).cast("double").alias("x")).where(F.col("x").isNotNull())
    if group:
        stats = vals.groupBy(group).agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
        joined = vals.join(stats, group)
    else:
        # two scalars (min, max) from one aggregate, applied as literals
        st = vals.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).first()
        joined = vals.withColumn("lo", F.lit(st["lo"]).cast("double")).withColumn("hi", F.lit(st["hi"]).cast("double"))
        stats = vals.sparkSession.createDataFrame([(st["lo"], st["hi"])], "lo double, hi double")
    b, _, _ = _bins(F.col("x"), F.col("lo"), F.col("hi"), n_bins)
    cnt = joined.select(*keys, b.alias("bin")).groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"))
    _, lo2, hi2 = _bins(F.lit(0.0), F.col("lo"), F.col("hi"), n_bins)
    width = (hi2 - lo2) / n_bins
    grid = stats.select(*keys, lo2.alias("lo2"), width.alias("w"),
                        F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))).alias("bin"))
    return (grid.join(cnt, keys + ["bin"], "left")
            .select(*keys, "bin",
                    r6(F.col("lo2") + F.col("bin") * F.col("w")).alias("bin_lo"),
                    r6(F.col("lo2") + (F.col("bin") + 1) * F.col("w")).alias("bin_hi"),
                    F.coalesce(F.col("n"), F.lit(0)).alias("n")))


def correlation_long(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every pair, strict lower triangle, long form.

    All pairs are aggregates of one pass over the table.
    """
    pairs = [(b, a) for a, b in combinations(cols, 2)]  # (row, column) with row after column
    aggs = [F.corr(F.col(x).cast("double"), F.col(y).cast("double")).alias(f"c{i}")
            for i, (x, y) in enumerate(pairs)]
    wide = df.agg(*aggs)
    stack = F.explode(F.array(*[
        F.struct(F.lit(x).alias("attr_a"), F.lit(y).alias("attr_b"), r6(F.col(f"c{i}")).alias("corr"))
        for i, (x, y) in enumerate(pairs)]))
    return wide.select(stack.alias("s")).select("s.*")


def vector_correlation_long(df: DataFrame, array_col: str, prefix: str) -> DataFrame:
    """A11 for a vector column: MLlib's distributed Pearson matrix, strict lower triangle.

    ``Correlation.corr`` tree-aggregates the d x d moments over the partitions;
    only the d x d matrix (d = vector width) reaches the driver.
    """
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Correlation

    vec = df.select(array_to_vector(F.col(array_col).cast("array<double>")).alias("v"))
    m = Correlation.corr(vec, "v").head()[0].toArray()
    d = m.shape[0]
    rows = [(f"{prefix}{a}", f"{prefix}{b}", float(round(m[a, b], 6)))
            for b in range(d) for a in range(b + 1, d)]
    return df.sparkSession.createDataFrame(rows, "attr_a string, attr_b string, corr double")
