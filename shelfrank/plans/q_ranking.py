"""Registered ranking queries: M14 popularity, A13, J2/J4 candidate pools, R4 shaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfrank.functions.exprs import lr_shaping, r6
from shelfrank.functions.ranks import rank_items, top_k_unseen_global
from shelfrank.models.popularity import PopularityRecommender
from shelfrank.plans.registry import query, with_roles
from shelfrank.sources import roles

K = 5


@query("m14_popularity_topk", with_roles(f"""
SELECT user_idx, item_idx, round(er, 6) AS relevance, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY er DESC, item_idx) AS rank FROM (
    SELECT u.user_idx, p.item_idx, p.score * p.price AS er
    FROM users u CROSS JOIN pop p
    WHERE NOT EXISTS (SELECT 1 FROM log l WHERE l.user_idx = u.user_idx AND l.item_idx = p.item_idx)))
WHERE rank <= {K}""", """
pop AS (
  SELECT i.item_idx, i.price,
         (coalesce(c.cnt, 0) + CAST(1.0 AS DOUBLE)) / (t.total + CAST(1.0 AS DOUBLE) * n.n) AS score
  FROM items i LEFT JOIN (SELECT item_idx, count(*) AS cnt FROM log WHERE relevance > 0 GROUP BY item_idx) c
       USING (item_idx),
       (SELECT count(*) AS total FROM log WHERE relevance > 0) t, (SELECT count(*) AS n FROM items) n)"""))
def m14_popularity_topk(spark, sf):
    r = roles.load(spark, sf)
    model = PopularityRecommender(alpha=1.0).fit(r.log)
    return model.predict(r.log, K, r.users, r.items)


@query("a13_item_popularity", with_roles("""
SELECT item_idx, cnt, round(cnt / greatest(1, sum(cnt) OVER ()), 6) AS score
FROM (SELECT item_idx, count(*) AS cnt FROM log GROUP BY item_idx)"""))
def a13_item_popularity(spark, sf):
    from shelfrank.operators.sequences import item_popularity
    return item_popularity(roles.log(spark, sf))


@query("j04_unseen_candidate_pool", with_roles("""
SELECT u.user_idx, n.n - coalesce(s.c, 0) AS n_candidates
FROM users u
LEFT JOIN (SELECT l.user_idx, count(DISTINCT l.item_idx) AS c FROM log l
           WHERE l.item_idx IN (SELECT item_idx FROM items) GROUP BY l.user_idx) s USING (user_idx),
     (SELECT count(*) AS n FROM items) n"""))
def j04_unseen_pool(spark, sf):
    """J2+J4: size of each user's candidate set (users x items minus seen), without the product."""
    r = roles.load(spark, sf)
    seen = (r.log.select("user_idx", "item_idx").distinct()
            .join(r.items.select("item_idx"), "item_idx", "left_semi")
            .groupBy("user_idx").agg(F.count(F.lit(1)).alias("c")))
    n = r.items.count()   # one scalar
    return (r.users.select("user_idx").join(seen, "user_idx", "left")
            .select("user_idx", (F.lit(n).cast("long") - F.coalesce(F.col("c"), F.lit(0))).alias("n_candidates")))


@query("r04_shaped_popularity_topk", with_roles(f"""
SELECT user_idx, item_idx, round(er, 6) AS relevance, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY er DESC, item_idx) AS rank FROM (
    SELECT u.user_idx, p.item_idx,
           (sin(p.score) + 1) * exp(p.score - 1) * ln(1 + p.price) * cos(p.price / 100)
             * (1 + tan(p.score * {repr(3.141592653589793 / 4)})) AS er
    FROM users u CROSS JOIN pop p
    WHERE NOT EXISTS (SELECT 1 FROM log l WHERE l.user_idx = u.user_idx AND l.item_idx = p.item_idx)))
WHERE rank <= {K}""", """
pop AS (
  SELECT i.item_idx, i.price,
         (coalesce(c.cnt, 0) + CAST(1.0 AS DOUBLE)) / (t.total + CAST(1.0 AS DOUBLE) * n.n) AS score
  FROM items i LEFT JOIN (SELECT item_idx, count(*) AS cnt FROM log WHERE relevance > 0 GROUP BY item_idx) c
       USING (item_idx),
       (SELECT count(*) AS total FROM log WHERE relevance > 0) t, (SELECT count(*) AS n FROM items) n)"""))
def r04_shaped_topk(spark, sf):
    """The non-monotone shaping applied to the popularity probability."""
    r = roles.load(spark, sf)
    model = PopularityRecommender(alpha=1.0, strategy="prob").fit(r.log)
    scored = model.item_scores(r.items).withColumn("er", lr_shaping("score", "price"))
    ranked = rank_items(scored, "er")
    recs = top_k_unseen_global(ranked, r.users, r.log, K)
    return recs.select("user_idx", "item_idx", r6("er").alias("relevance"), "rank")


@query("s02_recs_sink", with_roles(f"""
SELECT user_idx, item_idx, round(er, 6) AS relevance, CAST(rank AS INTEGER) AS rank, 'popularity' AS model FROM (
  SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY er DESC, item_idx) AS rank FROM (
    SELECT u.user_idx, p.item_idx, p.score * p.price AS er
    FROM users u CROSS JOIN pop p
    WHERE NOT EXISTS (SELECT 1 FROM log l WHERE l.user_idx = u.user_idx AND l.item_idx = p.item_idx)))
WHERE rank <= {K}""", """
pop AS (
  SELECT i.item_idx, i.price,
         (coalesce(c.cnt, 0) + CAST(1.0 AS DOUBLE)) / (t.total + CAST(1.0 AS DOUBLE) * n.n) AS score
  FROM items i LEFT JOIN (SELECT item_idx, count(*) AS cnt FROM log WHERE relevance > 0 GROUP BY item_idx) c
       USING (item_idx),
       (SELECT count(*) AS total FROM log WHERE relevance > 0) t, (SELECT count(*) AS n FROM items) n)"""))
def s02_recs_sink(spark, sf):
    """Recommendations written as parquet partitioned by model (shared folder), read back."""
    import uuid
    from shelfrank.session import checkpoint_dir
    r = roles.load(spark, sf)
    recs = PopularityRecommender(alpha=1.0).fit(r.log).predict(r.log, K, r.users, r.items)
    path = f"{checkpoint_dir(spark)}/recs-{uuid.uuid4().hex[:8]}"
    roles.write_recs(recs, path, "popularity", mode="overwrite")
    return spark.read.parquet(path).select("user_idx", "item_idx", "relevance", "rank", "model")
