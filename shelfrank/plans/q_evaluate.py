"""Registered evaluation queries: E1, E7/E9 back-test, E8 comparison, A12, A16-A20, S3."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfrank.functions.exprs import r6
from shelfrank.models.popularity import WalkHistory, walk_forward_recs
from shelfrank.operators import evaluate as ev
from shelfrank.operators.eda import correlation_long
from shelfrank.plans.registry import query, with_roles
from shelfrank.plans.sql_parts import disc_sql, metrics_ctes, popularity_walk_ctes, walk_base_ctes
from shelfrank.session import stored
from shelfrank.sources import roles

PLAN = ev.SlicePlan()
SINGLE = ev.SlicePlan(months=6, train_iterations=1, test_iterations=0)
STRATEGIES = {"pop_prob": "prob", "pop_scaled_price": "scaled_price", "pop_revenue": "revenue"}


def _walk_metrics(spark, sf, plan, strategy="revenue"):
    r = roles.load(spark, sf)
    recs = walk_forward_recs(r.log, r.items, plan, strategy=strategy)
    truth = ev.slice_truth(r.log, plan)
    m = ev.ranking_metrics(recs, truth, r.items, plan.k, keys=["iter"])
    return m.withColumn("phase", plan.phase_of("iter"))


def _walk_sql(plan, strategy="revenue", select="SELECT * FROM m"):
    ctes = (walk_base_ctes(plan) + "," + popularity_walk_ctes(plan, strategy=strategy) + ","
            + metrics_ctes(plan, "recs"))
    return with_roles(select, ctes)


@query("e09_walk_forward_popularity", _walk_sql(PLAN))
def e09_walk_forward(spark, sf):
    """E2-E7 per iteration of the walk-forward back-test (E9), popularity x price."""
    return _walk_metrics(spark, sf, PLAN)


FIXED_FIT = ev.SlicePlan(retrain=False)
SEEN_TOO = ev.SlicePlan(filter_seen=False)
LOG_END = dict(months=3, train_iterations=2, test_iterations=2)


@query("e09_walk_forward_without_retraining", _walk_sql(FIXED_FIT))
def e09_without_retraining(spark, sf):
    """E9 with retrain=False: fitted once on the history before the first slice."""
    return _walk_metrics(spark, sf, FIXED_FIT)


@query("e09_walk_forward_with_seen_items", _walk_sql(SEEN_TOO))
def e09_with_seen(spark, sf):
    """E9 with filter_seen=False: seen items may be recommended again."""
    return _walk_metrics(spark, sf, SEEN_TOO)


@query("e09_walk_forward_log_end", with_roles("SELECT * FROM m", walk_base_ctes(
    ev.SlicePlan(**LOG_END), "CAST(floor((year(ts) * 12 + month(ts) - 1 - (SELECT max(year(ts) * 12 + month(ts) - 1) - 11 FROM log))"
    " / 3.0) AS INTEGER)") + "," + popularity_walk_ctes(ev.SlicePlan(**LOG_END)) + "," + metrics_ctes(ev.SlicePlan(**LOG_END), "recs")))
def e09_log_end(spark, sf):
    """E9 over the log's last twelve months in four slices: the plan follows the log's own dates."""
    return _walk_metrics(spark, sf, ev.SlicePlan.ending_with(roles.log(spark, sf), **LOG_END))


@query("e07_metrics_single_cut", _walk_sql(SINGLE))
def e07_single_cut(spark, sf):
    """E2-E7 for one cut: fit before 2000-01-01, score the next six months."""
    return _walk_metrics(spark, sf, SINGLE)


@query("e01_discounted_gain", with_roles(f"""
SELECT iter, round(sum(g) / count(*), 6) AS mean_discounted_gain FROM (
  SELECT r.iter, r.user_idx,
         sum(CASE WHEN rel.item_idx IS NULL THEN 0 ELSE 1 END * {disc_sql('r.rank')}) AS g
  FROM recs r LEFT JOIN (SELECT DISTINCT iter, user_idx, item_idx FROM truth WHERE relevance > 0) rel
       USING (iter, user_idx, item_idx)
  WHERE r.rank <= {PLAN.k} GROUP BY r.iter, r.user_idx) GROUP BY iter""",
    walk_base_ctes(PLAN) + "," + popularity_walk_ctes(PLAN)))
def e01_discounted_gain(spark, sf):
    """Mean discounted gain (0.85^i) of the recs, relevance = hit, per iteration."""
    r = roles.load(spark, sf)
    recs = walk_forward_recs(r.log, r.items, PLAN)
    truth = ev.slice_truth(r.log, PLAN)
    rel = (truth.where(F.col("relevance") > 0).select("iter", "user_idx", "item_idx").distinct()
           .withColumn("hit", F.lit(1.0)))
    g = (recs.drop("relevance").join(rel, ["iter", "user_idx", "item_idx"], "left")
         .withColumn("relevance", F.coalesce(F.col("hit"), F.lit(0.0))))
    return ev.discounted_gain(g, PLAN.k, keys=["iter"]).select(
        "iter", r6("mean_discounted_gain").alias("mean_discounted_gain"))


_FRACTIONAL = ev.SlicePlan(k=10)


@query("e01_fractional_gain", with_roles(f"""
SELECT iter, round(sum(g) / count(*), 6) AS mean_discounted_gain FROM (
  SELECT iter, user_idx, sum(relevance * {disc_sql('rank')}) AS g FROM (
    SELECT iter, user_idx, rank, (item_idx % 7) / 3.0::DOUBLE + 0.00004::DOUBLE AS relevance FROM recs)
  GROUP BY iter, user_idx) GROUP BY iter""",
    walk_base_ctes(_FRACTIONAL) + "," + popularity_walk_ctes(_FRACTIONAL)))
def e01_fractional_gain(spark, sf):
    """E1 with fractional relevances down to 0.00004 at k = 10."""
    r = roles.load(spark, sf)
    recs = walk_forward_recs(r.log, r.items, _FRACTIONAL)
    g = recs.withColumn("relevance", (F.col("item_idx") % 7) / F.lit(3.0) + F.lit(0.00004))
    return ev.discounted_gain(g, _FRACTIONAL.k, keys=["iter"]).select(
        "iter", r6("mean_discounted_gain").alias("mean_discounted_gain"))


# ---------------------------------------------------------------- E8 and its summaries
def _compare_long(spark, sf):
    """The strategies differ in the ranking alone: the joined log, its counts, seen items and slices are
    written once and read by all; so is the result, a few rows that summaries read more than once."""
    r = roles.load(spark, sf)
    log = stored(r.log.select("user_idx", "item_idx", "ts", "relevance"))
    history = WalkHistory.of(log, PLAN, keep=True)
    truth = stored(ev.slice_truth(log, PLAN))
    out = None
    for name, strat in STRATEGIES.items():
        recs = walk_forward_recs(log, r.items, PLAN, strategy=strat, history=history)
        m = ev.ranking_metrics(recs, truth, r.items, PLAN.k, keys=["iter"]).withColumn("phase", PLAN.phase_of("iter"))
        m = m.withColumn("model", F.lit(name))
        out = m if out is None else out.unionByName(m)
    return stored(ev.to_long(out, ["model", "phase", "iter"]))


def _compare_sql_ctes():
    parts = [walk_base_ctes(PLAN)]
    unions = []
    for name, strat in STRATEGIES.items():
        t = "_" + name
        parts.append(popularity_walk_ctes(PLAN, strategy=strat, tag=t))
        parts.append(metrics_ctes(PLAN, "recs" + t, tag=t))
        unions.append(f"SELECT '{name}' AS model, * FROM m{t}")
    parts.append("wide AS (" + " UNION ALL ".join(unions) + ")")
    parts.append("""lng AS (SELECT model, phase, iter, metric, value FROM (UNPIVOT wide
        ON precision_at_k, ndcg_at_k, mrr, hit_rate, revenue, discounted_revenue
        INTO NAME metric VALUE value))""")
    return ",".join(parts)


@query("e08_model_comparison", with_roles("SELECT * FROM lng", _compare_sql_ctes()))
def e08_compare(spark, sf):
    """Three ranking strategies (R1/R2/R3) of one model on the same back-test, long form."""
    return _compare_long(spark, sf)


_PHASE_COLS = [f"{p}_{m}" for p in ("train", "test") for m in ev.METRICS]
# the summary prints the discounted revenue too; plain revenue stands there as totals and averages
_SUMMARY_COLS = [c for c in _PHASE_COLS if c not in ("train_revenue", "test_revenue")]


@query("a16_phase_means", with_roles(
    "SELECT model, " + ", ".join(
        f"round(avg(CASE WHEN phase = '{c.split('_', 1)[0]}' AND metric = '{c.split('_', 1)[1]}' "
        f"THEN value END), 6) AS {c}" for c in _PHASE_COLS) + " FROM lng GROUP BY model",
    _compare_sql_ctes()))
def a16_phase_means(spark, sf):
    """Mean of each metric per phase, columns train_<metric> / test_<metric>."""
    w = ev.phase_means(_compare_long(spark, sf))
    return w.select("model", *[r6(c).alias(c) for c in _PHASE_COLS])


_REV_SQL = """
SELECT model,
  round(sum(CASE WHEN phase = 'train' THEN value END), 6) AS train_total_revenue,
  round(sum(CASE WHEN phase = 'test' THEN value END), 6) AS test_total_revenue,
  round(avg(CASE WHEN phase = 'train' THEN value END), 6) AS train_avg_revenue,
  round(avg(CASE WHEN phase = 'test' THEN value END), 6) AS test_avg_revenue,
  round((avg(CASE WHEN phase = 'test' THEN value END) / avg(CASE WHEN phase = 'train' THEN value END) - 1)
        * 100, 6) AS performance_change_pct
FROM lng WHERE metric = 'revenue' GROUP BY model"""


def _revenue(spark, sf):
    lng = _compare_long(spark, sf).where(F.col("metric") == "revenue")
    return ev.revenue_summary(lng.select("model", "phase", "iter", F.col("value").alias("revenue")))


@query("a17_revenue_summary", with_roles(_REV_SQL, _compare_sql_ctes()))
def a17_revenue(spark, sf):
    """Revenue totals, averages per phase and performance change %."""
    return _revenue(spark, sf)


@query("s03_summary_table", with_roles(
    "SELECT s.*, " + ", ".join(f"p.{c}" for c in _SUMMARY_COLS)
    + " FROM (" + _REV_SQL + ") s JOIN (SELECT model, " + ", ".join(
        f"round(avg(CASE WHEN phase = '{c.split('_', 1)[0]}' AND metric = '{c.split('_', 1)[1]}' "
        f"THEN value END), 6) AS {c}" for c in _SUMMARY_COLS)
    + " FROM lng GROUP BY model) p USING (model) ORDER BY test_total_revenue DESC",
    _compare_sql_ctes()))
def s03_summary(spark, sf):
    """Summary table sorted by test revenue (fixed column set)."""
    lng = _compare_long(spark, sf)
    rev = ev.revenue_summary(lng.where(F.col("metric") == "revenue")
                             .select("model", "phase", "iter", F.col("value").alias("revenue")))
    w = ev.phase_means(lng).select("model", *[r6(c).alias(c) for c in _SUMMARY_COLS])
    return rev.join(w, "model").orderBy(F.col("test_total_revenue").desc())


@query("a19_best_model", with_roles(
    "SELECT arg_max(model, test_total_revenue) AS best_model, max(test_total_revenue) AS test_total_revenue"
    " FROM (" + _REV_SQL + ")", _compare_sql_ctes()))
def a19_best(spark, sf):
    """Model with the highest test revenue."""
    rev = _revenue(spark, sf)
    return rev.agg(F.max_by("model", "test_total_revenue").alias("best_model"),
                   F.max("test_total_revenue").alias("test_total_revenue"))


@query("a20_metric_trajectory", with_roles(
    f"SELECT model, metric, phase, iter AS step, CAST(CASE WHEN phase = 'test' THEN iter - "
    f"{PLAN.train_iterations} ELSE iter END AS INTEGER) AS phase_step, value FROM lng",
    _compare_sql_ctes()))
def a20_trajectory(spark, sf):
    """Metric trajectories; step continues into test, phase_step restarts there."""
    lng = _compare_long(spark, sf)
    return lng.select("model", "metric", "phase", F.col("iter").alias("step"),
                      F.when(F.col("phase") == "test", F.col("iter") - PLAN.train_iterations)
                      .otherwise(F.col("iter")).cast("int").alias("phase_step"), "value")


_CORR_COLS = [c for c in _PHASE_COLS if not c.endswith("revenue")]


@query("a12_metric_correlation", with_roles(
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{b}' AS attr_a, '{a}' AS attr_b, round(corr({b}, {a}), 6) AS corr FROM pm"
        for i, a in enumerate(_CORR_COLS) for b in _CORR_COLS[i + 1:]) + ")",
    _compare_sql_ctes() + ", pm AS (SELECT model, " + ", ".join(
        f"avg(CASE WHEN phase = '{c.split('_', 1)[0]}' AND metric = '{c.split('_', 1)[1]}' "
        f"THEN value END) AS {c}" for c in _CORR_COLS) + " FROM lng GROUP BY model)"))
def a12_metric_corr(spark, sf):
    """Correlation of the per-model metric means (revenue columns excluded)."""
    w = ev.phase_means(_compare_long(spark, sf))
    return correlation_long(w, _CORR_COLS)


@query("e09_walk_forward_ngram")
def e09_walk_forward_ngram(spark, sf):
    """E9 with the n-gram recommender refitted every iteration (generic driver-loop back-test)."""
    from shelfrank.models.ngram import NgramRecommender
    r = roles.load(spark, sf)
    return ev.backtest(lambda: NgramRecommender(order=3), r.log, r.users, r.items, PLAN)


@query("e08_compare_recommenders")
def e08_compare_recommenders(spark, sf):
    """E8/S3 with real models: popularity, n-gram, content-based and random, each refitted
    every iteration of the same walk-forward back-test; summary sorted by test revenue."""
    from shelfrank.models.baselines import ContentBasedRecommender, RandomRecommender
    from shelfrank.models.ngram import NgramRecommender
    from shelfrank.models.popularity import PopularityRecommender
    r = roles.load(spark, sf)
    factories = {
        "popularity": lambda: PopularityRecommender(alpha=1.0),
        "ngram": lambda: NgramRecommender(order=3),
        "content_based": lambda: ContentBasedRecommender(0.0),
        "random": lambda: RandomRecommender(seed=42),
    }
    return ev.summary_table(ev.compare_models(factories, r.log, r.users, r.items, PLAN))
