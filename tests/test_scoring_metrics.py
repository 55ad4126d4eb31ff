"""The blocked scorer agrees with brute force; E1-E7 on a hand-made hits fixture."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfrank.operators import evaluate as ev
from shelfrank.operators.scoring import block_topk, kind_topk, separable_topk, sigmoid_dot_price, softmax_topk, undominated
from shelfrank.sources import roles

from paths import SF_SMALL


def test_small_blocks_equal_large_ones_and_brute_force(spark):
    emb = roles.table(spark, SF_SMALL, "embeddings").withColumn("price", F.lit(1.0) + F.col("label"))
    q = emb.select(F.col("vec_id").alias("u"), "embedding")
    t = emb.select(F.col("vec_id").alias("i"), "embedding", "price")
    excl = emb.select(F.col("vec_id").alias("u"), F.col("vec_id").alias("i"))
    a = block_topk(q, "u", "embedding", t, "i", "embedding", 4, sigmoid_dot_price, t_extra="price", exclude=excl)
    b = block_topk(q, "u", "embedding", t, "i", "embedding", 4, sigmoid_dot_price, t_extra="price", exclude=excl,
                   query_rows=50, target_rows=37)
    ga = sorted((x.u, x.i, x.rank) for x in a.collect())
    gb = sorted((x.u, x.i, x.rank) for x in b.collect())
    assert ga == gb
    pdf = emb.toPandas()
    V = np.stack(pdf.embedding.to_numpy()).astype(np.float64)
    S = 1 / (1 + np.exp(-(V @ V.T))) * pdf.price.to_numpy()[None, :]
    np.fill_diagonal(S, -np.inf)
    ids = pdf.vec_id.to_numpy()
    want = []
    for r, u in enumerate(ids):
        order = np.lexsort((ids, -S[r]))[:4]
        want += [(int(u), int(ids[j]), n + 1) for n, j in enumerate(order)]
    assert ga == sorted(want)


def test_metrics_on_hand_fixture(spark):
    recs = spark.createDataFrame(pd.DataFrame({
        "user_idx": [1, 1, 1, 2, 2, 3], "item_idx": [10, 11, 12, 10, 13, 14], "rank": [1, 2, 3, 1, 2, 1]}))
    truth = spark.createDataFrame(pd.DataFrame({
        "user_idx": [1, 1, 2, 3, 4], "item_idx": [11, 12, 13, 99, 10], "relevance": [1, 1, 1, 0, 1]}))
    items = spark.createDataFrame(pd.DataFrame({"item_idx": [10, 11, 12, 13], "price": [5.0, 10.0, 20.0, 40.0]}))
    m = ev.ranking_metrics(recs, truth, items, k=3).first().asDict()
    # users 1..4 evaluated; hits: u1 ranks 2,3 (items 11, 12), u2 rank 2 (item 13)
    assert m["n_users"] == 4
    assert abs(m["precision_at_k"] - round((2 / 3 + 1 / 3) / 4, 6)) < 1e-9
    nd1 = (1 / np.log2(3) + 1 / np.log2(4)) / (1 + 1 / np.log2(3))
    nd2 = (1 / np.log2(3)) / 1.0
    assert abs(m["ndcg_at_k"] - round((nd1 + nd2) / 4, 6)) < 1e-9
    assert abs(m["mrr"] - round((1 / 2 + 1 / 2) / 4, 6)) < 1e-9
    assert m["hit_rate"] == 0.5
    assert m["revenue"] == 70.0
    assert abs(m["discounted_revenue"] - round(10 * 0.85 + 20 * 0.85 ** 2 + 40 * 0.85, 4)) < 1e-9
    g = ev.discounted_gain(recs.withColumn("relevance", F.lit(1.0)), k=2).first()[0]
    assert abs(g - ((1 + 0.85) + (1 + 0.85) + 1) / 3) < 1e-12
    assert abs(m["discounted_revenue"] - (10 * 0.85 + 20 * 0.85 ** 2 + 40 * 0.85)) < 1e-6


def test_discounted_gain_of_tiny_relevances_and_deep_ranks(spark):
    recs = spark.createDataFrame([(1, i, i + 1, 0.00004 if i == 0 else 0.00003) for i in range(12)],
                                 "user_idx long, item_idx long, rank int, relevance double")
    got = ev.discounted_gain(recs.where("rank <= 2"), k=10).first()[0]
    assert abs(got - (0.00004 + 0.00003 * 0.85)) < 1e-15
    got = ev.discounted_gain(recs, k=10).first()[0]
    assert abs(got - (0.00004 + sum(0.00003 * 0.85 ** r for r in range(1, 10)))) < 1e-15


def test_softmax_over_all_blocks_before_filtering(spark):
    rng = np.random.default_rng(4)
    u, v, w = rng.normal(size=(23, 5)) * 9, rng.normal(size=(57, 5)) * 9, rng.integers(-2, 9, 57).astype(float)
    gone = {(int(a), int(b)) for a, b in zip(rng.integers(0, 23, 80), rng.integers(0, 57, 80), strict=True)}
    q = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(u)], "u long, e array<double>")
    t = spark.createDataFrame([(i, x.tolist(), float(w[i])) for i, x in enumerate(v)], "i long, e array<double>, w double")
    ex = spark.createDataFrame(sorted(gone), "u long, i long")
    got = {}
    for r in softmax_topk(q, "u", "e", t, "i", "e", 4, "w", ex, query_rows=6, target_rows=10).collect():
        got.setdefault(r.u, []).append((r["rank"], r.i, r.prob, r.score))
    s = u @ v.T
    p = np.exp(s - s.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    for a in range(23):
        want = sorted((-p[a, i] * w[i], i) for i in range(57) if (a, i) not in gone)[:4]
        assert [x[1] for x in sorted(got[a])] == [i for _, i in want]
        assert [x[2] for x in sorted(got[a])] == pytest.approx([p[a, i] for _, i in want], rel=1e-9)


@pytest.mark.parametrize(("n_kinds", "target_rows"), [(3, 100), (9, 16), (40, 1000)])
def test_kinds_equal_scoring_every_item(spark, n_kinds, target_rows):
    rng = np.random.default_rng(n_kinds)
    kinds = rng.integers(0, 3, (n_kinds, 4)).astype(float)
    of, w = rng.integers(0, n_kinds, 90), rng.integers(-3, 12, 90).astype(float)
    u = rng.integers(-1, 3, (21, 4)).astype(float)
    gone = {(int(a), int(b)) for a, b in zip(rng.integers(0, 21, 150), rng.integers(0, 90, 150), strict=True)} | {(2, i) for i in range(88)}
    q = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(u)], "u long, e array<double>")
    t = spark.createDataFrame([(i, kinds[of[i]].tolist(), float(w[i])) for i in range(90)], "i long, e array<double>, w double")
    ex = spark.createDataFrame(sorted(gone), "u long, i long")
    got = {}
    for r in kind_topk(q, "u", "e", t, "i", "e", 4, "w", lambda a, b: np.maximum(0.0, a @ b.T), ex, query_rows=8,
                       target_rows=target_rows, batch_rows=5).collect():
        got.setdefault(r.u, []).append((r["rank"], r.i, r.score))
    for a in range(21):
        s = {i: max(0.0, float(u[a] @ kinds[of[i]])) for i in range(90)}
        want = sorted((-s[i] * w[i], i) for i in range(90) if s[i] > 0 and (a, i) not in gone)[:4]
        assert [(x[1], x[2]) for x in sorted(got.get(a, []))] == [(i, pytest.approx(-v)) for v, i in want]


def test_undominated_targets_hold_the_best_of_any_query():
    rng = np.random.default_rng(8)
    ids, x, w = rng.permutation(400), rng.integers(-9, 9, 400) / 4, rng.integers(-8, 8, 400).astype(float)
    x[3], w[4] = np.nan, np.nan
    for k in (1, 5, 150, 260):
        kept = undominated(ids, x, w, k)
        assert len(kept) < 400 and (k > 5 or len(kept) < 60)
        for a in (-3.0, 0.0, 2.5):
            s = w / (1 + np.exp(-(a + x)))
            order = np.lexsort((ids, -np.nan_to_num(s, nan=-np.inf)))[:k]
            assert set(order) <= set(kept.tolist())


@pytest.mark.parametrize("first", [1, 8, 256])
def test_separable_scores_equal_the_grid_and_travel_less(spark, monkeypatch, first):
    from shelfrank.models.linear import shaped_factor, shaped_revenue
    from shelfrank.operators import scoring
    monkeypatch.setattr(scoring, "PRUNE_ROWS", 100)
    rng = np.random.default_rng(9)
    gone = {(int(a), int(b)) for a, b in zip(rng.integers(0, 20, 150), rng.integers(0, 300, 150), strict=True)} | {(2, i) for i in range(297)}
    q = spark.createDataFrame([(i, float(v)) for i, v in enumerate(rng.normal(size=20))], "u long, a double")
    t = spark.createDataFrame([(i, float(b), float(p)) for i, (b, p) in enumerate(zip(rng.integers(-5, 5, 300) / 3, rng.integers(1, 900, 300)))],
                              "i long, b double, price double")
    ex = spark.createDataFrame(sorted(gone), "u long, i long")
    met, whole = [], scoring._grid
    monkeypatch.setattr(scoring, "_grid", lambda *a: met.append(a[3].count()) or whole(*a))
    got = separable_topk(q, "u", "a", t, "i", "b", "price", 4, shaped_revenue, shaped_factor, ex, first=first).collect()
    assert first == 256 or min(met) < 200
    want = block_topk(q.select("u", F.array("a").alias("a")), "u", "a", t.withColumn("b", F.array("b")), "i", "b", 4, shaped_revenue,
                      "price", ex, query_rows=7, target_rows=50).collect()
    assert sorted((r.u, r["rank"], r.i, r.score) for r in got) == sorted((r.u, r["rank"], r.i, r.score) for r in want)


def test_blocks_grow_with_the_table():
    from shelfrank.operators.scoring import TARGET_ROWS, _blocks
    assert [_blocks(n, TARGET_ROWS) for n in (0, 900, 5_000, 262_144, 720_000)] == [1, 1, 5, 8, 22]
