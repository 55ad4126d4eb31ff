"""M14 (and A13): popularity recommender, plus its walk-forward form.

score(i) = (cnt_i + alpha) / (total + alpha * n_items), cnt = relevant
interactions.  The score is user-independent, so top-k per user is the global
ranking minus the user's seen items (``top_k_unseen_global``): no users x items
product is ever built.

Ranking strategies (R1-R3) apply to the probability-like score:
  "prob"          R1: score
  "scaled_price"  R2: score * standardised price (population std over the
                       training interactions)
  "revenue"       R3: score * price (default)
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.functions.exprs import r6
from shelfrank.functions.ranks import rank_items, top_k_unseen_global
from shelfrank.operators.evaluate import SlicePlan
from shelfrank.session import stored


def _strategy(score, price, strategy: str, mean=None, std=None):
    if strategy == "prob":
        return score
    if strategy == "revenue":
        return score * price
    if strategy == "scaled_price":
        safe = F.when(std == 0, F.lit(1.0)).otherwise(std)
        return score * ((price - mean) / safe)
    raise ValueError(strategy)


class PopularityRecommender:
    def __init__(self, alpha: float = 1.0, strategy: str = "revenue", seed: int | None = None):
        self.alpha, self.strategy, self.seed = alpha, strategy, seed

    def fit(self, log: DataFrame, user_features=None, item_features=None):
        from pyspark.storagelevel import StorageLevel
        rel = log.where(F.col("relevance") > 0)
        self.counts = rel.groupBy("item_idx").agg(F.count(F.lit(1)).alias("cnt")) \
            .persist(StorageLevel.MEMORY_AND_DISK)
        # the total is summed from the cached per-item counts: one scan of the log
        self.total = self.counts.agg(F.sum("cnt").alias("total"))
        if item_features is not None:
            p = log.join(item_features.select("item_idx", "price"), "item_idx")
            self.price_stats = p.agg(F.avg("price").alias("pmean"), F.stddev_pop("price").alias("pstd"))
        else:
            self.price_stats = None
        return self

    def item_scores(self, items: DataFrame) -> DataFrame:
        # model scalars: the number of candidate items and the fitted totals
        n_items = items.count()
        total = self.total.first()["total"] or 0
        s = items.select("item_idx", "price").join(self.counts, "item_idx", "left")
        score = (F.coalesce(F.col("cnt"), F.lit(0)) + self.alpha) / \
                (F.lit(total).cast("long") + self.alpha * F.lit(n_items))
        mean = std = None
        if self.price_stats is not None:
            ps = self.price_stats.first()
            mean, std = F.lit(ps["pmean"]).cast("double"), F.lit(ps["pstd"]).cast("double")
        return s.select("item_idx", "price", score.alias("score"),
                        _strategy(score, F.col("price"), self.strategy, mean, std).alias("er"))

    def predict(self, log, k, users, items, user_features=None, item_features=None,
                filter_seen_items: bool = True) -> DataFrame:
        ranked = rank_items(self.item_scores(items), "er")
        seen = log if (filter_seen_items and log is not None) else None
        recs = top_k_unseen_global(ranked, users, seen, k)
        return recs.select("user_idx", "item_idx", r6("er").alias("relevance"), "rank")


def _cumulative(df: DataFrame, key_cols, aggs, n: int) -> DataFrame:
    per = df.groupBy(*key_cols, "s").agg(*aggs)
    return (per.withColumn("iter", F.explode(F.sequence(F.col("s") + 1, F.lit(n - 1))))
            .drop("s"))


@dataclass
class WalkHistory:
    """What every ranking strategy of one back-test reads: the rows fitted on, relevant counts per (iter,
    item), the users of each iteration and what they have seen by then."""

    hist: DataFrame
    counts: DataFrame
    eval_users: DataFrame
    seen: DataFrame

    @staticmethod
    def of(log: DataFrame, plan: SlicePlan, keep: bool = False) -> "WalkHistory":
        """With ``keep`` the parts are written once, for more than one reader; the seen items always are,
        as their number decides into how many tasks the next step deals them."""
        n = plan.n_iter
        kept = stored if keep else lambda df: df
        sl = log.withColumn("s", plan.slice_of("ts"))
        # without retraining every iteration uses the history before slice 0
        hist = sl.withColumn("s", F.greatest(F.col("s"), F.lit(-1))).where(F.col("s") <= (n - 2 if plan.retrain else -1))
        counts = _cumulative(hist.where(F.col("relevance") > 0), ["item_idx"], [F.count(F.lit(1)).alias("c")], n) \
            .groupBy("iter", "item_idx").agg(F.sum("c").alias("cnt"))
        truth = sl.where((F.col("s") >= 0) & (F.col("s") < n)).withColumnRenamed("s", "iter")
        eval_users = kept(plan.sample_users(truth.select("iter", "user_idx").distinct()))
        first = sl.groupBy("user_idx", "item_idx").agg(F.min("s").alias("s"))
        # only the iterations in which the user is evaluated, never all later ones
        seen = (first.where(F.col("s") <= n - 2).join(eval_users, "user_idx").where(F.col("s") < F.col("iter"))
                .select("iter", "user_idx", "item_idx"))
        return WalkHistory(hist, kept(counts), eval_users, stored(seen) if plan.filter_seen else None)


def walk_forward_recs(log: DataFrame, items: DataFrame, plan: SlicePlan, alpha: float = 1.0,
                      strategy: str = "revenue", history: WalkHistory | None = None) -> DataFrame:
    """All iterations of the back-test in one plan (refit every iteration).

    Counts up to iteration i are a cumulative sum over slices: each per-slice
    count row is expanded to the (at most n_iter) iterations it precedes, so
    the work is linear in items x iterations, not in iterations x log.
    ``history``: the log's parts, if several strategies share them.
    """
    n = plan.n_iter
    history = history or WalkHistory.of(log, plan)
    hist, icnt = history.hist, history.counts
    tot = icnt.groupBy("iter").agg(F.sum("cnt").alias("total"))
    its = items.select("item_idx", "price")
    n_items_value = its.count()   # one scalar
    grid = (its.withColumn("iter", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
            .withColumn("n_items", F.lit(n_items_value).cast("long")))
    s = (grid.join(icnt, ["iter", "item_idx"], "left").join(tot, "iter", "left"))
    score = (F.coalesce(F.col("cnt"), F.lit(0)) + alpha) / \
            (F.coalesce(F.col("total"), F.lit(0)) + alpha * F.col("n_items"))
    mean = std = None
    if strategy == "scaled_price":
        ph = hist.join(its, "item_idx")
        pst = _cumulative(ph, [], [F.count(F.lit(1)).alias("m"), F.sum("price").alias("sp"),
                                   F.sum(F.col("price") * F.col("price")).alias("sq")], n) \
            .groupBy("iter").agg(F.sum("m").alias("m"), F.sum("sp").alias("sp"), F.sum("sq").alias("sq"))
        pst = pst.select("iter", (F.col("sp") / F.col("m")).alias("pmean"),
                         F.sqrt(F.greatest(F.col("sq") / F.col("m") - F.pow(F.col("sp") / F.col("m"), 2),
                                           F.lit(0.0))).alias("pstd"))
        s = s.join(pst, "iter", "left")
        mean, std = F.col("pmean"), F.col("pstd")
    scored = s.select("iter", "item_idx", "price", score.alias("score"),
                      _strategy(score, F.col("price"), strategy, mean, std).alias("er"))
    ranked = rank_items(scored, "er", keys=["iter"])

    recs = top_k_unseen_global(ranked, history.eval_users, history.seen, plan.k, keys=["iter"], distinct=True)
    return recs.select("iter", "user_idx", "item_idx", "rank", r6("er").alias("relevance"))
