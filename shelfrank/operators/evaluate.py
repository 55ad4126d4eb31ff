"""ranking/revenue metrics and the walk-forward back-test.

Metric definitions (the reference names them; the formulas are ours):
  evaluated users = users with at least one interaction in the slice
  relevant pairs  = distinct (user, item) with relevance 1 in the slice
  precision_at_k  = mean over users of hits / k
  ndcg_at_k       = mean of DCG / IDCG, DCG = sum 1/log2(rank+1) over hits,
                    IDCG over min(k, #relevant) positions, 0 without relevant
  mrr             = mean of 1 / first hit rank (0 without hit)
  hit_rate        = share of users with a hit
  revenue         = sum of hit prices
  discounted_revenue = sum of price * 0.85^(rank-1) over hits
All are grouped aggregations (no collect); keys such as the iteration ride along.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrank.functions.exprs import DISCOUNT, position_discount, r6

HALF_UP = 1e-9
METRICS = ["precision_at_k", "ndcg_at_k", "mrr", "hit_rate", "revenue", "discounted_revenue"]


@dataclass(frozen=True)
class SlicePlan:
    """E9 walk-forward plan: iteration i scores slice [start + i*months, +months)."""
    start_year: int = 2000
    start_month: int = 1
    months: int = 2
    train_iterations: int = 5
    test_iterations: int = 5
    k: int = 5
    user_frac: float = 1.0
    seed: int = 42
    retrain: bool = True
    filter_seen: bool = True

    @staticmethod
    def ending_with(log: DataFrame, ts: str = "ts", **params) -> SlicePlan:
        """A plan whose last slice ends with the log's last month, whatever years the log covers."""
        last = log.agg(F.max(F.year(ts) * 12 + F.month(ts) - 1)).first()[0]
        plan = SlicePlan(**params)
        first = (plan.start_year * 12 + plan.start_month - 1) if last is None else last + 1 - plan.n_iter * plan.months
        return replace(plan, start_year=first // 12, start_month=first % 12 + 1)

    @property
    def n_iter(self) -> int:
        return self.train_iterations + self.test_iterations

    def slice_of(self, ts="ts") -> Column:
        """Slice index of a timestamp (negative = before the first slice)."""
        m = (F.year(ts) - self.start_year) * 12 + (F.month(ts) - self.start_month)
        return F.floor(m / self.months).cast("int")

    def phase_of(self, it="iter") -> Column:
        return F.when(F.col(it) < self.train_iterations, F.lit("train")).otherwise(F.lit("test"))

    def slice_sql(self, ts="ts") -> str:
        return (f"CAST(floor(((year({ts}) - {self.start_year}) * 12 + (month({ts}) - {self.start_month}))"
                f" / {float(self.months)}) AS INTEGER)")

    def sample_users(self, df: DataFrame) -> DataFrame:
        """Hash-based user sample per iteration (deterministic, partition-independent)."""
        if self.user_frac >= 1.0:
            return df
        h = F.pmod(F.xxhash64(F.lit(self.seed), F.col("iter"), F.col("user_idx")), F.lit(1_000_000))
        return df.where(h < int(self.user_frac * 1_000_000))


def idcg(n_rel: Column, k: int) -> Column:
    """Ideal DCG for min(k, n_rel) binary gains, as a sum of k guarded terms."""
    import math
    expr = F.lit(0.0)
    for i in range(1, k + 1):
        expr = expr + F.when(n_rel >= i, F.lit(1.0 / math.log2(i + 1))).otherwise(F.lit(0.0))
    return expr


def ranking_metrics(recs: DataFrame, truth: DataFrame, items_df: DataFrame, k: int,
                    keys=()) -> DataFrame:
    """E2-E7 per key group.

    recs:  (keys..., user_idx, item_idx, rank)
    truth: (keys..., user_idx, item_idx, relevance) - the slice's interactions
    """
    keys = list(keys)
    users = truth.select(*keys, "user_idx").distinct()
    rel = truth.where(F.col("relevance") > 0).select(*keys, "user_idx", "item_idx").distinct()
    n_rel = rel.groupBy(*keys, "user_idx").agg(F.count(F.lit(1)).alias("n_rel"))
    hits = (recs.where(F.col("rank") <= k).select(*keys, "user_idx", "item_idx", "rank")
            .join(rel, keys + ["user_idx", "item_idx"])
            .join(items_df.select("item_idx", "price"), "item_idx", "left")
            .withColumn("price", F.coalesce(F.col("price"), F.lit(1.0))))
    per_user = hits.groupBy(*keys, "user_idx").agg(
        F.count(F.lit(1)).alias("n_hits"),
        F.sum(1.0 / F.log2(F.col("rank") + 1)).alias("dcg"),
        F.min("rank").alias("first_hit"),
        F.sum("price").alias("rev"),
        F.sum(F.col("price") * position_discount("rank")).alias("drev"))
    u = (users.join(n_rel, keys + ["user_idx"], "left").join(per_user, keys + ["user_idx"], "left")
         .fillna(0, ["n_rel", "n_hits"]))
    nd = F.when(F.col("n_rel") > 0, F.coalesce(F.col("dcg"), F.lit(0.0)) / idcg(F.col("n_rel"), k)) \
        .otherwise(F.lit(0.0))
    agg = u.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_users"),
        F.avg(F.col("n_hits") / float(k)).alias("precision_at_k"),
        F.avg(nd).alias("ndcg_at_k"),
        F.avg(F.coalesce(1.0 / F.col("first_hit"), F.lit(0.0))).alias("mrr"),
        F.avg((F.col("n_hits") > 0).cast("double")).alias("hit_rate"),
        F.coalesce(F.sum("rev"), F.lit(0.0)).alias("revenue"),
        F.coalesce(F.sum("drev"), F.lit(0.0)).alias("discounted_revenue"))
    # prices have two decimals and discounts up to eight, so an exact half of the last reported digit
    # does occur; the tiny summand rounds it up whatever the order of summation was
    return agg.select(*keys, "n_users", *[
        r6(F.col(m) + HALF_UP if m == "discounted_revenue" else m).alias(m) for m in METRICS])


def discounted_gain(recs: DataFrame, k: int = 5, discount: float = DISCOUNT, keys=()) -> DataFrame:
    """Mean over users of sum_{rank<=k} relevance * discount^(rank-1); no users -> 0.0."""
    keys = list(keys)
    per_user = (recs.where(F.col("rank") <= k)
                .groupBy(*keys, "user_idx")
                .agg(F.sum(F.col("relevance").cast("double") * position_discount("rank", discount)).alias("g")))
    mean = F.sum("g") / F.count(F.lit(1))
    if keys:
        return per_user.groupBy(*keys).agg(mean.alias("mean_discounted_gain"))
    return per_user.agg(F.coalesce(mean, F.lit(0.0)).alias("mean_discounted_gain"))


def slice_truth(log_df: DataFrame, plan: SlicePlan) -> DataFrame:
    """Interactions of each evaluation slice, tagged with the iteration."""
    s = log_df.withColumn("iter", plan.slice_of("ts"))
    t = s.where((F.col("iter") >= 0) & (F.col("iter") < plan.n_iter))
    return plan.sample_users(t.select("iter", "user_idx", "item_idx", "relevance"))


def phase_means(metrics_long: DataFrame) -> DataFrame:
    """Mean of each metric over iterations per (model, phase), prefixed train_/test_.

    Input (model, phase, iter, metric, value); output one row per model.
    """
    return metrics_long.groupBy("model").agg(*[
        F.avg(F.when((F.col("phase") == p) & (F.col("metric") == m), F.col("value"))).alias(f"{p}_{m}")
        for p in ("train", "test") for m in METRICS])


def to_long(metrics: DataFrame, id_cols) -> DataFrame:
    """Wide metric columns -> (id..., metric, value)."""
    return metrics.unpivot(list(id_cols), METRICS, "metric", "value")


def revenue_summary(metrics: DataFrame) -> DataFrame:
    """Totals, averages per phase and the change test vs train, per model.

    Input (model, phase, iter, revenue, ...).  Sorted by test revenue (W9).
    """
    p = metrics.groupBy("model").agg(
        F.sum(F.when(F.col("phase") == "train", F.col("revenue"))).alias("train_total_revenue"),
        F.sum(F.when(F.col("phase") == "test", F.col("revenue"))).alias("test_total_revenue"),
        F.avg(F.when(F.col("phase") == "train", F.col("revenue"))).alias("train_avg_revenue"),
        F.avg(F.when(F.col("phase") == "test", F.col("revenue"))).alias("test_avg_revenue"))
    return p.select(
        "model",
        *[r6(c).alias(c) for c in ["train_total_revenue", "test_total_revenue",
                                   "train_avg_revenue", "test_avg_revenue"]],
        r6((F.col("test_avg_revenue") / F.col("train_avg_revenue") - 1) * 100).alias("performance_change_pct"))


def backtest(make_model, log: DataFrame, users: DataFrame, items: DataFrame, plan: SlicePlan,
             user_features: DataFrame | None = None, item_features: DataFrame | None = None) -> DataFrame:
    """E9 for any recommender with the fit/predict protocol: a driver loop of Spark jobs.

    Iteration i fits on everything before slice i (``retrain``) or on the
    history before slice 0; either way it recommends to the users active in
    slice i what they have not seen before slice i, and scores against that
    slice.  Returns (iter, phase, n_users, metrics...).
    """
    from pyspark.storagelevel import StorageLevel
    # every iteration refits on a prefix of the same log: read and tag it once
    sl = log.withColumn("_s", plan.slice_of("ts")).persist(StorageLevel.MEMORY_AND_DISK)
    truth = sl.where((F.col("_s") >= 0) & (F.col("_s") < plan.n_iter)) \
        .select(F.col("_s").alias("iter"), "user_idx", "item_idx", "relevance")
    truth = plan.sample_users(truth)
    rows = []
    model = None
    for i in range(plan.n_iter):
        past = sl.where(F.col("_s") < i).drop("_s")          # what users have seen by then
        if model is None or plan.retrain:
            fitted = past if plan.retrain else sl.where(F.col("_s") < 0).drop("_s")
            model = make_model().fit(fitted, user_features if user_features is not None else users,
                                     item_features if item_features is not None else items)
        t_i = truth.where(F.col("iter") == i)
        eval_users = t_i.select("user_idx").distinct()
        recs = model.predict(past, plan.k, eval_users, items, filter_seen_items=plan.filter_seen)
        m = ranking_metrics(recs.withColumn("iter", F.lit(i)), t_i, items, plan.k, keys=["iter"])
        rows += m.collect()          # one row per iteration
        if plan.retrain and hasattr(model, "release"):
            model.release()          # the next iteration refits: free this one's caches
    sl.unpersist()
    spark = log.sparkSession
    schema = "iter int, n_users long, " + ", ".join(f"{c} double" for c in METRICS)
    out = spark.createDataFrame([tuple(r) for r in rows], schema)
    return out.withColumn("phase", plan.phase_of("iter"))


def compare_models(factories: dict, log: DataFrame, users: DataFrame, items: DataFrame,
                   plan: SlicePlan) -> DataFrame:
    """Several recommenders on the same walk-forward slices -> long metrics
    (model, phase, iter, metric, value), ready for A16-A20 and S3."""
    out = None
    for name, make in factories.items():
        m = backtest(make, log, users, items, plan).withColumn("model", F.lit(name))
        lng = to_long(m, ["model", "phase", "iter"])
        out = lng if out is None else out.unionByName(lng)
    return out


def summary_table(metrics_long: DataFrame) -> DataFrame:
    """Revenue totals/averages/change plus the per-phase metric means, by test revenue."""
    rev = revenue_summary(metrics_long.where(F.col("metric") == "revenue")
                          .select("model", "phase", "iter", F.col("value").alias("revenue")))
    means = phase_means(metrics_long).drop("train_revenue", "test_revenue")
    return rev.join(means, "model").orderBy(F.col("test_total_revenue").desc())
