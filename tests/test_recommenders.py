"""Linear, tree and content models: k recommendations a user, seen items only if asked for."""
import pytest

from shelfrank.models.baselines import ContentBasedRecommender, RandomRecommender
from shelfrank.models.linear import LinearRecommender
from shelfrank.models.trees import TreeRecommender
from shelfrank.sources import roles

from paths import SF_SMALL

MODELS = {"lr": lambda: LinearRecommender("lr", "l2", max_iter=20), "svm": lambda: LinearRecommender("svm", max_iter=5),
          "trees": lambda: TreeRecommender("gbt", gbt_trees=2), "content": lambda: ContentBasedRecommender(0.0),
          "random": lambda: RandomRecommender(seed=1)}


@pytest.fixture(scope="module")
def loaded(spark):
    r = roles.load(spark, SF_SMALL)
    return roles.Roles(r.users.cache(), r.items.cache(), r.log.cache())


@pytest.mark.parametrize("name", MODELS)
def test_top_k_with_and_without_seen_items(loaded, name):
    model = MODELS[name]().fit(loaded.log, loaded.users, loaded.items)
    seen = {(r.user_idx, r.item_idx) for r in loaded.log.select("user_idx", "item_idx").collect()}
    for unseen in (True, False):
        recs = model.predict(loaded.log, 4, loaded.users, loaded.items, filter_seen_items=unseen).collect()
        by = {}
        for r in recs:
            by.setdefault(r.user_idx, []).append((r.rank, r.relevance, r.item_idx))
        assert len(by) >= (loaded.users.count() if name != "content" else 50)
        for u, rows in by.items():
            rows.sort()
            assert [x[0] for x in rows] == list(range(1, len(rows) + 1)) and len({x[2] for x in rows}) == len(rows)
            assert all(a[1] >= b[1] for a, b in zip(rows, rows[1:]))
        assert not unseen or not seen & {(r.user_idx, r.item_idx) for r in recs}


def test_registered_tree_queries_run_the_reference_search(spark, monkeypatch):
    from shelfrank.plans import q_models
    made = {}
    monkeypatch.setattr(TreeRecommender, "fit", lambda self, *a: made.setdefault(self.kind, self))
    monkeypatch.setattr(TreeRecommender, "predict", lambda self, *a: None)
    q_models.m02_rf(spark, SF_SMALL)
    q_models.m03_gbt(spark, SF_SMALL)
    rf = made["rf"]
    assert (rf.n_draws, rf.n_folds, made["gbt"].gbt_trees) == (10, 3, 1000)
    assert rf.space == {"num_trees": (100, 300), "max_depth": (5, 30), "min_split": (2, 20), "min_leaf": (1, 10),
                        "features": ["sqrt", "log2", "all"]}


def test_random_lists_skip_repeated_seen_rows_without_candidate_rows(spark):
    from shelfrank.models.baselines import RandomRecommender

    users = spark.range(30).withColumnRenamed("id", "user_idx")
    items = spark.range(25).withColumnRenamed("id", "item_idx")
    seen = users.crossJoin(items).where("(user_idx * 7 + item_idx) % 3 < 2 or user_idx = 4")
    log = seen.unionByName(seen.where("item_idx % 2 = 0"))
    whole = {}
    for r in RandomRecommender(3).predict(None, 25, users, items).collect():
        whole.setdefault(r.user_idx, []).append((r["rank"], r.item_idx))
    gone = {(r.user_idx, r.item_idx) for r in log.collect()}
    recs = RandomRecommender(3).predict(log, 4, users, items)
    got = {}
    for r in recs.collect():
        got.setdefault(r.user_idx, []).append((r["rank"], r.item_idx, r.relevance))
    for u, order in whole.items():
        left = [i for _, i in sorted(order) if (u, i) not in gone][:4]
        assert sorted(got.get(u, [])) == [(n, i, 1 / n) for n, i in enumerate(left, 1)]
    assert 4 not in got
    assert "LeftAnti" not in recs._jdf.queryExecution().executedPlan().toString()
