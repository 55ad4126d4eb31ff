"""The one-plan vectorised popularity back-test equals the generic driver-loop back-test."""
import pytest
from pyspark.sql import functions as F

from shelfrank.models.popularity import PopularityRecommender, walk_forward_recs
from shelfrank.operators import evaluate as ev
from shelfrank.sources import roles

from paths import SF_SMALL


@pytest.mark.parametrize("options", [{}, {"user_frac": 0.4, "retrain": False, "filter_seen": False}])
def test_vectorised_backtest_equals_loop(spark, options):
    r = roles.load(spark, SF_SMALL)
    plan = ev.SlicePlan(months=6, train_iterations=2, test_iterations=1, **options)
    recs = walk_forward_recs(r.log, r.items, plan)
    truth = ev.slice_truth(r.log, plan)
    assert truth.count() == plan.sample_users(truth).count()
    vec = ev.ranking_metrics(recs, truth, r.items, plan.k, keys=["iter"])
    loop = ev.backtest(lambda: PopularityRecommender(alpha=1.0), r.log, r.users, r.items, plan)
    cols = ["iter", "n_users"] + ev.METRICS
    a = sorted(tuple(x[c] for c in cols) for x in vec.collect())
    b = sorted(tuple(x[c] for c in cols) for x in loop.collect())
    assert a == b
    assert len(a) == 3


def test_plan_follows_the_log(spark):
    log = roles.log(spark, SF_SMALL)
    for years in (0, 23):
        moved = log.withColumn("ts", F.expr(f"ts + interval {years} years"))
        plan = ev.SlicePlan.ending_with(moved, months=3, train_iterations=2, test_iterations=2)
        slices = {x.s: x["count"] for x in moved.groupBy(plan.slice_of("ts").alias("s")).count().collect()}
        assert max(slices) == 3 and {0, 1, 2, 3} <= set(slices)
    assert ev.SlicePlan.ending_with(log.limit(0)) == ev.SlicePlan()


def test_strategies_share_the_joined_log(spark, monkeypatch):
    from shelfrank.plans import q_evaluate as q
    loads, load = [], q.roles.load
    monkeypatch.setattr(q.roles, "load", lambda *a: loads.append(a) or load(*a))
    got = {(r.model, r.iter, r.metric): r.value for r in q._compare_long(spark, SF_SMALL).collect()}
    assert len(loads) == 1
    for name, strategy in q.STRATEGIES.items():
        want = ev.to_long(q._walk_metrics(spark, SF_SMALL, q.PLAN, strategy), ["phase", "iter"]).collect()
        assert {(name, r.iter, r.metric): r.value for r in want}.items() <= got.items()
