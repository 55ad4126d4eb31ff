"""Registered model queries: M11 embedding scoring, M4 exact kNN (vectors test bed)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from shelfrank.functions.exprs import DEFAULT_PRICE, r6
from shelfrank.operators.sequences import training_windows
from shelfrank.operators.scoring import block_topk, neg_sq_l2, separable_topk, sigmoid_dot_price, softmax_topk
from shelfrank.plans.registry import query
from shelfrank.session import stored
from shelfrank.sources import roles

K = 5

_EMB = """e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"""


@query("m11_embedding_topk", f"""
WITH {_EMB},
it AS (SELECT e.vec_id AS item_idx, e.v, coalesce(CAST(p.p_retailprice AS DOUBLE), 1.0) AS price
       FROM e LEFT JOIN part p ON p.p_partkey = e.vec_id),
sc AS (SELECT u.vec_id AS user_idx, i.item_idx,
              (1.0 / (1.0 + exp(-list_dot_product(u.v, i.v)))) * i.price AS score
       FROM e u CROSS JOIN it i)
SELECT user_idx, item_idx, round(score, 6) AS relevance, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY score DESC, item_idx) AS rank FROM sc)
WHERE rank <= {K}""")
def m11_embedding_topk(spark, sf):
    """sigmoid(u . v) * price (default 1.0) for every node pair, top 5, blocked."""
    emb = roles.table(spark, sf, "embeddings")
    price = roles.items(spark, sf).select(F.col("item_idx").alias("vec_id"), "price")
    items = (emb.join(price, "vec_id", "left")
             .select(F.col("vec_id").alias("item_idx"), "embedding",
                     F.coalesce("price", F.lit(DEFAULT_PRICE)).alias("price")))
    users = emb.select(F.col("vec_id").alias("user_idx"), "embedding")
    top = block_topk(users, "user_idx", "embedding", items, "item_idx", "embedding", K,
                     sigmoid_dot_price, t_extra="price")
    return top.select("user_idx", "item_idx", r6("score").alias("relevance"), F.col("rank").cast("int"))


@query("f03_softmax_topk", f"""
WITH {_EMB},
it AS (SELECT e.vec_id AS item_idx, e.v, coalesce(CAST(p.p_retailprice AS DOUBLE), 1.0) AS price
       FROM e LEFT JOIN part p ON p.p_partkey = e.vec_id),
sc AS (SELECT u.vec_id AS user_idx, i.item_idx, i.price, list_dot_product(u.v, i.v) AS s FROM e u CROSS JOIN it i),
mx AS (SELECT user_idx, max(s) AS m FROM sc GROUP BY user_idx),
pr AS (SELECT user_idx, item_idx, price, exp(s - m) / sum(exp(s - m)) OVER (PARTITION BY user_idx) AS prob
       FROM sc JOIN mx USING (user_idx))
SELECT user_idx, item_idx, round(prob, 9) AS prob, round(prob * price, 6) AS relevance, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY prob * price DESC, item_idx) AS rank
  FROM pr WHERE user_idx <> item_idx) WHERE rank <= {K}""")
def f03_softmax(spark, sf):
    """softmax over all items' logits u . v, the own item dropped afterwards, times price, top 5."""
    emb = roles.table(spark, sf, "embeddings")
    price = roles.items(spark, sf).select(F.col("item_idx").alias("vec_id"), "price")
    items = emb.join(price, "vec_id", "left").select(
        F.col("vec_id").alias("item_idx"), "embedding", F.coalesce("price", F.lit(DEFAULT_PRICE)).alias("price"))
    users = emb.select(F.col("vec_id").alias("user_idx"), "embedding")
    own = emb.select(F.col("vec_id").alias("user_idx"), F.col("vec_id").alias("item_idx"))
    top = softmax_topk(users, "user_idx", "embedding", items, "item_idx", "embedding", K, "price", own)
    return top.select("user_idx", "item_idx", F.round("prob", 9).alias("prob"), r6("score").alias("relevance"),
                      F.col("rank").cast("int"))


@query("m04_knn_vectors", f"""
WITH {_EMB},
d AS (SELECT a.vec_id AS qid, b.vec_id AS tid, b.label AS tl, list_distance(a.v, b.v) AS dist
      FROM e a JOIN e b ON a.vec_id <> b.vec_id),
nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, tid) AS r FROM d) WHERE r <= 3),
votes AS (SELECT qid, tl, count(*) AS c FROM nn GROUP BY qid, tl),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY c DESC, tl) AS r FROM votes)
         WHERE r = 1)
SELECT e.vec_id, e.label, b.tl AS pred_label, round(b.c / 3.0, 6) AS prob_pred,
       round(coalesce(o.c, 0) / 3.0, 6) AS prob_own
FROM e JOIN best b ON b.qid = e.vec_id LEFT JOIN votes o ON o.qid = e.vec_id AND o.tl = e.label""")
def m04_knn_vectors(spark, sf):
    """M4: exact 3-NN classifier (Minkowski p=2, uniform vote), leave-one-out over all vectors."""
    emb = roles.table(spark, sf, "embeddings")
    self_pairs = emb.select(F.col("vec_id").alias("qid"), F.col("vec_id").alias("tid"))
    nn = block_topk(emb.withColumnRenamed("vec_id", "qid"), "qid", "embedding",
                    emb.withColumnRenamed("vec_id", "tid"), "tid", "embedding", 3, neg_sq_l2,
                    exclude=self_pairs)
    labels = emb.select(F.col("vec_id").alias("tid"), F.col("label").alias("tl"))
    votes = nn.join(labels, "tid").groupBy("qid", "tl").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy("qid").orderBy(F.col("c").desc(), F.col("tl").asc())
    best = votes.withColumn("r", F.row_number().over(w)).where("r = 1")
    own = votes.select("qid", F.col("tl").alias("label"), F.col("c").alias("oc"))
    return (emb.select("vec_id", "label")
            .join(best.select(F.col("qid").alias("vec_id"), F.col("tl").alias("pred_label"), "c"), "vec_id")
            .join(own.withColumnRenamed("qid", "vec_id"), ["vec_id", "label"], "left")
            .select("vec_id", "label", "pred_label", r6(F.col("c") / 3.0).alias("prob_pred"),
                    r6(F.coalesce("oc", F.lit(0)) / 3.0).alias("prob_own")))


# ---------------------------------------------------------------- content models on the log roles
from shelfrank.models.baselines import ContentBasedRecommender, RandomRecommender  # noqa: E402
from shelfrank.models.linear import LR_VARIANTS, LinearRecommender  # noqa: E402
from shelfrank.models.neighbors import KnnRecommender  # noqa: E402
from shelfrank.models.trees import TreeRecommender  # noqa: E402
from shelfrank.plans.registry import with_roles  # noqa: E402


def _lr_query(variant):
    def run(spark, sf):
        r = roles.load(spark, sf)
        m = LinearRecommender("lr", variant).fit(r.log, r.users, r.items)
        return m.predict(r.log, K, r.users, r.items)
    run.__doc__ = f"M1 ({variant}): logistic regression, R4 shaping, seen removed, top 5 (rows check)."
    return run


for _v in LR_VARIANTS:
    query(f"m01_logreg_{_v}_topk")(_lr_query(_v))


@query("m12_linear_svm_topk")
def m12_svm(spark, sf):
    """Linear SVM, raw margin (user-independent order) -> global ranking minus seen."""
    r = roles.load(spark, sf)
    m = LinearRecommender("svm").fit(r.log, r.users, r.items)
    return m.predict(r.log, K, r.users, r.items)


def _knn_sql(weight: str) -> str:
    """Brute force over all pairs, but for one proven bound: a pair's three nearest rows lie within the third
    nearest of the user's own rows, so only users that near are joined."""
    return with_roles(f"""
SELECT user_idx, item_idx, round(score, 6) AS relevance, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY score DESC, item_idx) AS rank FROM (
    SELECT user_idx, item_idx, sum(hit) / 3.0 * any_value(w) AS score FROM (
      SELECT *, row_number() OVER (PARTITION BY user_idx, item_idx ORDER BY d, tie) AS r FROM cand) WHERE r <= 3
    GROUP BY user_idx, item_idx)) WHERE rank <= {K}""", f"""
lg AS (SELECT l.*, i.category, i.brand, i.item_attr_0, i.price FROM log l JOIN items i USING (item_idx)),
st AS (SELECT avg(price) AS m, stddev_pop(price) AS s FROM lg),
pt AS (SELECT user_idx AS u2, category, brand, item_attr_0, (price - m) / s AS sp, CAST(relevance > 0 AS INTEGER) AS hit,
         row_number() OVER (ORDER BY ts, l_orderkey, l_linenumber) AS tie FROM lg, st),
it AS (SELECT i.*, (i.price - m) / s AS sp FROM items i, st),
q AS (SELECT u.user_idx, i.*, {weight} AS w FROM users u CROSS JOIN it i
      WHERE NOT EXISTS (SELECT 1 FROM log l WHERE l.user_idx = u.user_idx AND l.item_idx = i.item_idx)),
own AS (SELECT user_idx, item_idx, CASE WHEN count(*) >= 3 THEN list_sort(list(d))[3] ELSE 1e300 END AS r FROM (
          SELECT q.user_idx, q.item_idx, round(pow(q.item_attr_0 - p.item_attr_0, 2) + pow(q.sp - p.sp, 2)
            + CASE WHEN q.category = p.category THEN 0 ELSE 2 END + CASE WHEN q.brand = p.brand THEN 0 ELSE 2 END, 9) AS d
          FROM q JOIN pt p ON p.u2 = q.user_idx) GROUP BY user_idx, item_idx),
far AS (SELECT user_idx, max(coalesce(r, 1e300)) AS r FROM q LEFT JOIN own USING (user_idx, item_idx) GROUP BY user_idx),
near AS (SELECT a.user_idx, b.user_idx AS u2, pow(a.user_attr_0 - b.user_attr_0, 2) + pow(a.user_attr_1 - b.user_attr_1, 2) AS d0,
           CASE WHEN a.segment = b.segment THEN 0 ELSE 2 END AS d1
         FROM users a JOIN far USING (user_idx) JOIN users b
           ON pow(a.user_attr_0 - b.user_attr_0, 2) + pow(a.user_attr_1 - b.user_attr_1, 2) <= far.r + 1e-6),
cand AS (SELECT * FROM (
           SELECT q.user_idx, q.item_idx, q.w, p.tie, p.hit, coalesce(o.r, 1e300) AS lim,
             round(n.d0 + (q.item_attr_0 - p.item_attr_0) * (q.item_attr_0 - p.item_attr_0) + (q.sp - p.sp) * (q.sp - p.sp) + n.d1
               + CASE WHEN q.category = p.category THEN 0 ELSE 2 END + CASE WHEN q.brand = p.brand THEN 0 ELSE 2 END, 9) AS d
           FROM q JOIN near n USING (user_idx) JOIN pt p ON p.u2 = n.u2 LEFT JOIN own o ON o.user_idx = q.user_idx AND o.item_idx = q.item_idx)
         WHERE d <= lim)""")


@query("m04_knn_topk", _knn_sql("i.price"))
def m04_knn(spark, sf):
    """M4 on the log (k = 3, mixed features), R3: probability x price, seen removed, top 5."""
    r = roles.load(spark, sf)
    return KnnRecommender(3).fit(r.log, r.users, r.items).predict(r.log, K, r.users, r.items)


@query("m04_knn_scaled_price_topk", _knn_sql("i.sp"))
def m04_knn_scaled(spark, sf):
    """M4 under R2: probability x standardised price."""
    r = roles.load(spark, sf)
    return KnnRecommender(3, strategy="scaled_price").fit(r.log, r.users, r.items).predict(r.log, K, r.users, r.items)


@query("m02_random_forest_topk")
def m02_rf(spark, sf):
    """M2: random forest chosen by seeded randomized search (10 draws, 3 stratified folds, accuracy), R3."""
    r = roles.load(spark, sf)
    m = TreeRecommender("rf").fit(r.log, r.users, r.items)
    return m.predict(r.log, K, r.users, r.items)


@query("m03_gradient_boosting_topk")
def m03_gbt(spark, sf):
    """M3: second-order boosted trees (step 0.1, depth 10, 1000 rounds, alpha 0.1, lambda 5), R3."""
    r = roles.load(spark, sf)
    m = TreeRecommender("gbt").fit(r.log, r.users, r.items)
    return m.predict(r.log, K, r.users, r.items)


@query("m13_random_topk")
def m13_random(spark, sf):
    """Seeded random recommender (per-user cyclic offset into one hash order), seen removed."""
    r = roles.load(spark, sf)
    return RandomRecommender(seed=42).predict(r.log, K, r.users, r.items)


@query("m15_content_based_topk", with_roles(f"""
SELECT user_idx, item_idx, round(score, 6) AS relevance, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY score DESC, item_idx) AS rank FROM (
    SELECT q.user_idx, i.item_idx,
           (coalesce(c.s, 0.0) + coalesce(b.s, 0.0)) / (q.qn * sqrt(CAST(2.0 AS DOUBLE))) AS cos,
           (coalesce(c.s, 0.0) + coalesce(b.s, 0.0)) / (q.qn * sqrt(CAST(2.0 AS DOUBLE))) * i.price AS score
    FROM qn q CROSS JOIN items i
    LEFT JOIN sc c ON c.user_idx = q.user_idx AND c.category = i.category
    LEFT JOIN sb b ON b.user_idx = q.user_idx AND b.brand = i.brand
    WHERE NOT EXISTS (SELECT 1 FROM log l WHERE l.user_idx = q.user_idx AND l.item_idx = i.item_idx))
  WHERE cos > 0.0)
WHERE rank <= {K}""", """
rel AS (SELECT l.user_idx, i.category, i.brand FROM log l JOIN items i USING (item_idx) WHERE l.relevance > 0),
nr AS (SELECT user_idx, count(*) AS n FROM rel GROUP BY user_idx),
sc AS (SELECT user_idx, category, count(*) / any_value(n) AS s FROM rel JOIN nr USING (user_idx) GROUP BY ALL),
sb AS (SELECT user_idx, brand, count(*) / any_value(n) AS s FROM rel JOIN nr USING (user_idx) GROUP BY ALL),
qn AS (SELECT user_idx, sqrt(sum(s * s)) AS qn FROM (SELECT user_idx, s FROM sc UNION ALL SELECT user_idx, s FROM sb)
       GROUP BY user_idx)"""))
def m15_content(spark, sf):
    """Content-based, cosine(profile, one-hot content) > 0 times price, seen removed, top 5."""
    r = roles.load(spark, sf)
    m = ContentBasedRecommender(0.0).fit(r.log, r.users, r.items)
    return m.predict(r.log, K, r.users, r.items)


@query("u06_holdout_split")
def u06_split(spark, sf):
    """Seeded 90/10 hash split of the sequence windows (partition-independent)."""
    return training_windows(roles.log(spark, sf)).select("user_idx", "pos", "target", "is_val")


@query("u06_split_invariants", with_roles("""
SELECT CAST(sum(n - 1) AS BIGINT) AS windows, CAST(0 AS BIGINT) AS in_both, true AS share_ok
FROM (SELECT user_idx, count(*) AS n FROM log GROUP BY user_idx)"""))
def u06_invariants(spark, sf):
    """Every window is on one side, and the held-out share is 10 % within four standard errors."""
    w = u06_split(spark, sf).groupBy("user_idx", "pos").agg(F.count("*").alias("n"), F.countDistinct("is_val").alias("sides"),
                                                             F.max(F.col("is_val").cast("int")).alias("v"))
    n = F.sum("n")
    return w.agg(n.cast("long").alias("windows"), F.count(F.when(F.col("sides") > 1, 1)).alias("in_both"),
                 (F.abs(F.avg("v") - 0.1) <= 4 * F.sqrt(F.lit(0.09) / n)).alias("share_ok"))


@query("u07_fold_assignment")
def u07_folds(spark, sf):
    """Hash fold ids (3 folds) of the J1 training rows used by the random-forest search."""
    from shelfrank.models.trees import fold_column
    r = roles.load(spark, sf)
    j = r.log.select("user_idx", "item_idx", "relevance")
    return fold_column(j, 3, 42, ["user_idx", "item_idx"]).groupBy("relevance", "fold").count()


@query("u07_stratified_folds", with_roles("""
SELECT relevance, CAST(f AS INTEGER) AS fold, CAST(n // 3 + CASE WHEN n % 3 > f THEN 1 ELSE 0 END AS BIGINT) AS n
FROM (SELECT relevance, count(*) AS n FROM log GROUP BY relevance), (SELECT unnest([0, 1, 2]) AS f)"""))
def u07_stratified(spark, sf):
    """Three folds of the training rows, each with the same share of either label to one row."""
    from shelfrank.models.trees import stratified_folds
    rows = roles.log(spark, sf)
    return stratified_folds(rows, "relevance", 3, 42, ["user_idx", "item_idx", "l_orderkey", "l_linenumber"]).groupBy(
        "relevance", "fold").agg(F.count("*").alias("n"))


@query("u07_fold_invariants", with_roles("SELECT count(*) AS n, 3 AS folds, true AS balanced FROM log"))
def u07_invariants(spark, sf):
    """Every training row is in one of three folds, each with a third of either label within four
    standard errors."""
    c = u07_folds(spark, sf)
    size = c.groupBy("relevance").agg(F.sum("count").alias("t"))
    third = F.abs(F.col("count") / F.col("t") - 1 / 3) <= 4 * F.sqrt(F.lit(2 / 9) / F.col("t"))
    return c.join(F.broadcast(size), "relevance").agg(
        F.sum("count").alias("n"), F.countDistinct("fold").cast("int").alias("folds"), F.every(third).alias("balanced"))


@query("m13_random_invariants", with_roles(f"""
SELECT count(*) AS users, count(*) * {K} AS recs, CAST(0 AS BIGINT) AS seen, true AS spread FROM users"""))
def m13_invariants(spark, sf):
    """Every user gets k unseen items, and no item is recommended ten times as often as on average."""
    r = roles.load(spark, sf)
    recs = stored(RandomRecommender(seed=42).predict(r.log, K, r.users, r.items))      # read four times
    seen = recs.join(r.log.select("user_idx", "item_idx"), ["user_idx", "item_idx"], "left_semi").count()
    most = recs.groupBy("item_idx").count().agg(F.max("count")).first()[0]
    average = r.users.count() * K / r.items.count()
    return recs.agg(F.countDistinct("user_idx").alias("users"), F.count("*").alias("recs"),
                    F.lit(seen).cast("long").alias("seen"), F.lit(most <= max(10, 10 * average)).alias("spread"))


_FIXED = """
SELECT u.user_idx, i.item_idx, i.price,
       1.0 / (1.0 + exp(-((CASE WHEN u.segment = 'BUILDING' THEN 0.3::DOUBLE ELSE 0.1::DOUBLE END + 0.0001::DOUBLE * u.user_attr_0)
                          + (CASE WHEN i.brand < 'Brand#3' THEN -0.2::DOUBLE ELSE 0.4::DOUBLE END + 0.01::DOUBLE * i.item_attr_0)))) AS p
FROM users u, items i"""


@query("m01_fixed_weights_topk", with_roles(f"""
SELECT user_idx, item_idx, round(er, 6) AS relevance, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY er DESC, item_idx) AS rank FROM (
    SELECT user_idx, item_idx, (sin(p) + 1) * exp(p - 1) * ln(1 + price) * cos(price / 100.0::DOUBLE)
           * (1 + tan(p * {3.141592653589793 / 4}::DOUBLE)) AS er
    FROM ({_FIXED}) x WHERE NOT EXISTS (SELECT 1 FROM log l WHERE l.user_idx = x.user_idx AND l.item_idx = x.item_idx)))
WHERE rank <= {K}"""))
def m01_fixed(spark, sf):
    """M1/R4 scoring with given weights: user term plus item term, shaped revenue, seen removed, top 5."""
    from shelfrank.models.linear import shaped_factor, shaped_revenue
    r = roles.load(spark, sf)
    a = F.when(F.col("segment") == "BUILDING", F.lit(0.3)).otherwise(F.lit(0.1)) + F.lit(0.0001) * F.col("user_attr_0")
    b = F.when(F.col("brand") < "Brand#3", F.lit(-0.2)).otherwise(F.lit(0.4)) + F.lit(0.01) * F.col("item_attr_0")
    top = separable_topk(r.users.select("user_idx", a.alias("a")), "user_idx", "a", r.items.select("item_idx", "price", b.alias("b")),
                         "item_idx", "b", "price", K, shaped_revenue, shaped_factor, r.log.select("user_idx", "item_idx"))
    return top.select("user_idx", "item_idx", r6("score").alias("relevance"), F.col("rank").cast("int"))
