"""M1 (logistic regression x4) and M12 (linear SVM) recommenders on MLlib.

Training: MLlib on the J1 frame (pair vectors only for logged interactions).
sklearn minimises C * sum(loss) + penalty, MLlib mean(loss) + lambda * penalty,
hence ``regParam = 1 / (C * n)``; features are not re-standardised
(``standardization=False``), matching the reference's raw one-hot + scaled price.

Scoring never assembles pair vectors: w . [x_u, x_i] + b = a_u + b_i, with
a_u and b_i computed once per user / item.  LR ranks by the F1 shaping of
sigmoid(a_u + b_i) (R4) or by expected revenue (R3) in the blocked scorer, after
dropping the items that others precede for every user (``scoring.separable_topk``);
the SVM ranks by the raw margin (R1), which orders items the same way for
every user, so its top k is the global b_i ranking minus seen items.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.functions.exprs import r6
from shelfrank.functions.ranks import rank_items, top_k_unseen_global
from shelfrank.operators.features import FeatureSpace
from shelfrank.operators.scoring import block_topk, separable_topk

# Fixed values of the reference's four LR variants: (penalty, C, l1 ratio).
LR_VARIANTS = {
    "default": ("l2", 1.0, 0.0),      # sklearn default, named "No Penalty" there
    "l1": ("l1", 0.01, 1.0),
    "l2": ("l2", 0.01, 0.0),
    "elasticnet": ("elasticnet", 0.01, 0.5),
}


def _dot_lit(col: str, w) -> F.Column:
    return F.aggregate(F.zip_with(F.col(col), F.array(*[F.lit(float(x)) for x in w]), lambda a, b: a * b),
                       F.lit(0.0), lambda acc, v: acc + v)


def shaped_revenue(Q, T, price):
    """R4 (F1) on p = sigmoid(a_u + b_i), with the original price."""
    p = 1.0 / (1.0 + np.exp(-(Q[:, :1] + T[:, 0][None, :])))
    pr = price[None, :]
    return ((np.sin(p) + 1) * np.exp(p - 1) * np.log1p(pr) * np.cos(pr / 100)
            * (1 + np.tan(p * math.pi / 4)))


def expected_revenue(Q, T, price):
    """R3 on p = sigmoid(a_u + b_i)."""
    return (1.0 / (1.0 + np.exp(-(Q[:, :1] + T[:, 0][None, :])))) * price[None, :]


def shaped_factor(price):
    """The part of ``shaped_revenue`` that p leaves alone; the rest is positive and rises with p."""
    return F.log1p(price) * F.cos(price / 100)


UNDERFLOW = -700.0     # below this sum of both terms a probability may be 0 in double precision


class LinearRecommender:
    def __init__(self, kind: str = "lr", variant: str = "default", strategy: str | None = None,
                 max_iter: int = 1000, seed: int | None = None):
        self.kind, self.variant, self.max_iter, self.seed = kind, variant, max_iter, seed
        self.strategy = strategy or ("shaped" if kind == "lr" else "margin")

    def fit(self, log: DataFrame, user_features: DataFrame, item_features: DataFrame):
        self.fs = FeatureSpace.fit(user_features, item_features, log)
        train = self.fs.training_frame(log, user_features, item_features)
        if self.kind == "lr":
            _, C, l1 = LR_VARIANTS[self.variant]
            n = train.count()
            est = LogisticRegression(featuresCol="features", labelCol="label", standardization=False,
                                     regParam=1.0 / (C * max(n, 1)), elasticNetParam=l1,
                                     maxIter=self.max_iter)
        else:
            est = LinearSVC(featuresCol="features", labelCol="label", maxIter=self.max_iter,
                            standardization=False)
        self.model = est.fit(train)
        w = self.model.coefficients.toArray()
        self.du = len(self.fs.user_vectors(user_features).first()["uvec"])
        self.w_user, self.w_item, self.b = w[:self.du], w[self.du:], float(self.model.intercept)
        return self

    def user_terms(self, users: DataFrame) -> DataFrame:
        return self.fs.user_vectors(users).select("user_idx", F.array(_dot_lit("uvec", self.w_user)).alias("a"))

    def item_terms(self, items: DataFrame) -> DataFrame:
        iv = self.fs.item_vectors(items)
        return iv.select("item_idx", "price", (_dot_lit("ivec", self.w_item) + F.lit(self.b)).alias("bi"))

    def predict(self, log, k, users, items, user_features=None, item_features=None,
                filter_seen_items: bool = True) -> DataFrame:
        uf = user_features if user_features is not None else users
        itf = item_features if item_features is not None else items
        it = self.item_terms(itf.join(items.select("item_idx"), "item_idx", "left_semi"))
        seen = log.select("user_idx", "item_idx") if (filter_seen_items and log is not None) else None
        if self.strategy == "margin":
            ranked = rank_items(it, "bi")
            recs = top_k_unseen_global(ranked, users, seen, k)
            return recs.select("user_idx", "item_idx", r6("bi").alias("relevance"), "rank")
        ut = self.user_terms(uf.join(users.select("user_idx"), "user_idx", "left_semi")).select("user_idx", F.col("a")[0].alias("a"))
        if self.strategy == "shaped":
            top = separable_topk(ut, "user_idx", "a", it, "item_idx", "bi", "price", k, shaped_revenue, shaped_factor, seen)
        elif (ut.agg(F.min("a")).first()[0] or 0.0) + (it.agg(F.min("bi")).first()[0] or 0.0) > UNDERFLOW:
            top = separable_topk(ut, "user_idx", "a", it, "item_idx", "bi", "price", k, expected_revenue, lambda price: price, seen)
        else:     # probabilities of 0 tie whatever the price
            top = block_topk(ut.select("user_idx", F.array("a").alias("a")), "user_idx", "a", it.withColumn("t", F.array("bi")),
                             "item_idx", "t", k, expected_revenue, t_extra="price", exclude=seen)
        return top.select("user_idx", "item_idx", r6("score").alias("relevance"), "rank")
