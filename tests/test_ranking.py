"""Top-k operators against brute force and hand fixtures."""
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from shelfrank.functions.ranks import rank_items, top_k_unseen_global
from shelfrank.models.baselines import RandomRecommender
from shelfrank.models.popularity import PopularityRecommender
from shelfrank.sources import roles

from paths import SF_SMALL


def _brute_topk(scores: pd.DataFrame, users, seen: set, k: int):
    out = []
    for u in users:
        c = scores[[(u, i) not in seen for i in scores.item_idx]]
        c = c.sort_values(["er", "item_idx"], ascending=[False, True]).head(k)
        out += [(u, int(i), r + 1) for r, i in enumerate(c.item_idx)]
    return sorted(out)


def test_popularity_topk_equals_brute_force(spark):
    r = roles.load(spark, SF_SMALL)
    m = PopularityRecommender(alpha=1.0).fit(r.log)
    got = sorted((x.user_idx, x.item_idx, x.rank) for x in m.predict(r.log, 5, r.users, r.items).collect())
    scores = m.item_scores(r.items).toPandas()
    seen = {(x.user_idx, x.item_idx) for x in r.log.select("user_idx", "item_idx").collect()}
    users = [x.user_idx for x in r.users.collect()]
    assert got == _brute_topk(scores, users, seen, 5)


def test_ties_seen_all_and_k_larger_than_items(spark):
    items = spark.createDataFrame(pd.DataFrame({"item_idx": [0, 1, 2, 3], "er": [1.0, 2.0, 2.0, 2.0]}))
    ranked = rank_items(items, "er")
    users = spark.createDataFrame(pd.DataFrame({"user_idx": [10, 11, 12]}))
    seen = spark.createDataFrame(pd.DataFrame({"user_idx": [11, 11, 11, 11, 12], "item_idx": [0, 1, 2, 3, 2]}))
    got = sorted((x.user_idx, x.item_idx, x.rank)
                 for x in top_k_unseen_global(ranked, users, seen, 6).collect())
    # ties on the score break by item id; user 11 saw everything; k > items returns what exists
    assert got == [(10, 0, 4), (10, 1, 1), (10, 2, 2), (10, 3, 3), (12, 0, 3), (12, 1, 1), (12, 3, 2)]


def test_random_recommender_is_seeded_unseen_and_distinct(spark):
    r = roles.load(spark, SF_SMALL)
    a = RandomRecommender(seed=42).predict(r.log, 5, r.users, r.items).toPandas()
    b = RandomRecommender(seed=42).predict(r.log, 5, r.users, r.items).toPandas()
    key = ["user_idx", "rank"]
    assert a.sort_values(key).reset_index(drop=True).equals(b.sort_values(key).reset_index(drop=True))
    seen = {(x.user_idx, x.item_idx) for x in r.log.select("user_idx", "item_idx").collect()}
    assert not any((u, i) in seen for u, i in zip(a.user_idx, a.item_idx))
    assert (a.groupby("user_idx").item_idx.nunique() == 5).all()
    assert a.groupby("user_idx").item_idx.apply(tuple).nunique() > 1   # not the same list for everyone


def test_repartition_invariance(spark):
    r = roles.load(spark, SF_SMALL)
    m = PopularityRecommender().fit(r.log)
    one = m.predict(r.log.repartition(1), 5, r.users.repartition(1), r.items).toPandas()
    many = m.predict(r.log.repartition(13), 5, r.users.repartition(13), r.items).toPandas()
    key = ["user_idx", "rank"]
    assert one.sort_values(key).reset_index(drop=True).equals(many.sort_values(key).reset_index(drop=True))


def test_unseen_ranks_without_candidate_rows(spark):
    rng = np.random.default_rng(5)
    ranked = rank_items(spark.createDataFrame([(i, float(i % 13)) for i in range(90)], "item_idx long, er double"), "er")
    gone = {(int(u), int(i)) for u, i in zip(rng.integers(0, 12, 400), rng.integers(0, 95, 400))} | {(3, i) for i in range(88)}
    users = spark.createDataFrame([(u,) for u in range(14)] + [(2,), (None,)], "user_idx long")
    seen = spark.createDataFrame(sorted(gone) + [(3, 1), (None, 4)], "user_idx long, item_idx long")
    recs = top_k_unseen_global(ranked, users, seen, 6)
    plan = recs._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan
    order = [i for _, i in sorted((-(i % 13), i) for i in range(90))]
    want = {(u, i, n + 1) for u in [*range(14), None] for n, i in enumerate([i for i in order if (u, i) not in gone][:6])}
    got = [(r.user_idx, r.item_idx, r["rank"]) for r in recs.collect()]
    assert len(got) == len(want) and set(got) == want
