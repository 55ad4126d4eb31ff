"""Reusable DuckDB SQL fragments for the oracles (mirrors of the Spark operators).

Every double literal is cast to DOUBLE: DuckDB reads ``1.0`` as DECIMAL, which
would change the arithmetic.
"""

from __future__ import annotations

import math

from shelfrank.operators.evaluate import HALF_UP, SlicePlan

D = "CAST({} AS DOUBLE)".format


def disc_sql(rank: str) -> str:
    """Discount of a 1-based rank, the twin of ``exprs.position_discount``."""
    return f"pow({D('0.85')}, {rank} - 1)"


def idcg_sql(n_rel: str, k: int) -> str:
    terms = [f"CASE WHEN {n_rel} >= {i} THEN {D(repr(1.0 / math.log2(i + 1)))} ELSE {D('0.0')} END"
             for i in range(1, k + 1)]
    return "(" + D("0.0") + " + " + " + ".join(terms) + ")"


def popularity_walk_ctes(plan: SlicePlan, alpha: float = 1.0, strategy: str = "revenue",
                         tag: str = "") -> str:
    """CTEs sl, truth<tag>, eu<tag>, recs<tag> for the popularity back-test."""
    n = plan.n_iter
    until = n - 2 if plan.retrain else -1      # without retraining: the history before slice 0
    a = D(repr(alpha))
    unseen = """
  WHERE NOT EXISTS (SELECT 1 FROM seen x WHERE x.iter = e.iter AND x.user_idx = e.user_idx
                    AND x.item_idx = sc.item_idx)""" if plan.filter_seen else ""
    if strategy == "revenue":
        er = "sc.score * sc.price"
    elif strategy == "prob":
        er = "sc.score"
    else:
        er = ("sc.score * ((sc.price - ps.pmean) / CASE WHEN ps.pstd = 0 THEN 1.0 ELSE ps.pstd END)")
    pst = ""
    pjoin = ""
    if strategy == "scaled_price":
        pst = f"""
pstat{tag} AS (
  SELECT it.iter, CAST(sum(p.m) AS DOUBLE) AS m, sum(p.sp) AS sp, sum(p.sq) AS sq
  FROM (SELECT s, count(*) AS m, sum(i.price) AS sp, sum(i.price * i.price) AS sq
        FROM (SELECT item_idx, greatest(s, -1) AS s FROM sl) h JOIN items i USING (item_idx)
        WHERE s <= {until} GROUP BY s) p
  JOIN it ON p.s < it.iter GROUP BY it.iter),
ps{tag} AS (SELECT iter, sp / m AS pmean,
              sqrt(greatest(sq / m - pow(sp / m, 2), 0.0)) AS pstd FROM pstat{tag}),"""
        pjoin = f" LEFT JOIN ps{tag} ps ON ps.iter = sc.iter"
    return f"""
cnt{tag} AS (
  SELECT item_idx, s, count(*) AS c
  FROM (SELECT item_idx, greatest(s, -1) AS s FROM sl WHERE relevance > 0) WHERE s <= {until}
  GROUP BY item_idx, s),
icnt{tag} AS (SELECT it.iter, c.item_idx, CAST(sum(c.c) AS BIGINT) AS c
         FROM cnt{tag} c JOIN it ON c.s < it.iter GROUP BY it.iter, c.item_idx),
tot{tag} AS (SELECT iter, CAST(sum(c) AS BIGINT) AS t FROM icnt{tag} GROUP BY iter),{pst}
score{tag} AS (
  SELECT it.iter, i.item_idx, i.price,
         (coalesce(ic.c, 0) + {a}) / (coalesce(tot.t, 0) + {a} * ni.n) AS score
  FROM it CROSS JOIN items i CROSS JOIN (SELECT count(*) AS n FROM items) ni
  LEFT JOIN icnt{tag} ic ON ic.iter = it.iter AND ic.item_idx = i.item_idx
  LEFT JOIN tot{tag} tot ON tot.iter = it.iter),
cand{tag} AS (
  SELECT e.iter, e.user_idx, sc.item_idx, {er} AS er
  FROM eu e JOIN score{tag} sc ON sc.iter = e.iter{pjoin}{unseen}),
recs{tag} AS (
  SELECT iter, user_idx, item_idx, CAST(rank AS INTEGER) AS rank, round(er, 6) AS relevance FROM (
    SELECT *, row_number() OVER (PARTITION BY iter, user_idx ORDER BY er DESC, item_idx) AS rank
    FROM cand{tag}) WHERE rank <= {plan.k})"""


def walk_base_ctes(plan: SlicePlan, slice_sql: str | None = None) -> str:
    """sl (log with slice index), it (iterations), truth, eu (evaluated users), seen."""
    n = plan.n_iter
    return f"""
sl AS (SELECT *, {slice_sql or plan.slice_sql('ts')} AS s FROM log),
it AS (SELECT CAST(range AS INTEGER) AS iter FROM range(0, {n})),
truth AS (SELECT s AS iter, user_idx, item_idx, relevance FROM sl WHERE s >= 0 AND s < {n}),
eu AS (SELECT DISTINCT iter, user_idx FROM truth),
seen AS (SELECT DISTINCT e.iter, e.user_idx, l.item_idx
         FROM eu e JOIN sl l ON l.user_idx = e.user_idx AND l.s < e.iter)"""


def metrics_ctes(plan: SlicePlan, recs: str, tag: str = "") -> str:
    """m<tag>: per-iteration metrics of ``recs`` against ``truth``."""
    k = plan.k
    return f"""
rel{tag} AS (SELECT DISTINCT iter, user_idx, item_idx FROM truth WHERE relevance > 0),
nrel{tag} AS (SELECT iter, user_idx, count(*) AS n_rel FROM rel{tag} GROUP BY iter, user_idx),
hits{tag} AS (SELECT r.iter, r.user_idx, r.rank, coalesce(i.price, 1.0) AS price
         FROM {recs} r JOIN rel{tag} USING (iter, user_idx, item_idx) LEFT JOIN items i USING (item_idx)
         WHERE r.rank <= {k}),
pu{tag} AS (SELECT iter, user_idx, count(*) AS n_hits, sum(1.0 / log2(rank + 1)) AS dcg,
              min(rank) AS first_hit, sum(price) AS rev,
              sum(price * {disc_sql('rank')}) AS drev
       FROM hits{tag} GROUP BY iter, user_idx),
u{tag} AS (SELECT e.iter, e.user_idx, coalesce(n.n_rel, 0) AS n_rel, coalesce(p.n_hits, 0) AS n_hits,
             p.dcg, p.first_hit, p.rev, p.drev
      FROM eu e LEFT JOIN nrel{tag} n USING (iter, user_idx) LEFT JOIN pu{tag} p USING (iter, user_idx)),
m{tag} AS (
  SELECT iter, CASE WHEN iter < {plan.train_iterations} THEN 'train' ELSE 'test' END AS phase,
         count(*) AS n_users,
         round(avg(n_hits / {D(float(k))}), 6) AS precision_at_k,
         round(avg(CASE WHEN n_rel > 0 THEN coalesce(dcg, 0.0) / {idcg_sql('n_rel', k)} ELSE 0.0 END), 6)
           AS ndcg_at_k,
         round(avg(coalesce(1.0 / first_hit, 0.0)), 6) AS mrr,
         round(avg(CASE WHEN n_hits > 0 THEN 1.0 ELSE 0.0 END), 6) AS hit_rate,
         round(coalesce(sum(rev), 0.0), 6) AS revenue,
         round(coalesce(sum(drev), 0.0) + {D(HALF_UP)}, 6) AS discounted_revenue
  FROM u{tag} GROUP BY iter)"""
