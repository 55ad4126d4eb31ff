import numpy as np
import pytest

from shelfrank.llm import embedding_dedup as E


def data(seed, n=300, d=12):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((40, d))
    x = base[rng.integers(0, 40, n)] + 0.18 * rng.standard_normal((n, d)) * rng.integers(0, 3, (n, 1))
    return [(i, x[i].astype(np.float32).tolist(), int(rng.integers(0, 3))) for i in range(n)]


def brute(rows, least):
    ids = [r[0] for r in rows]
    x = np.array([r[1] for r in rows], np.float32).astype(float)
    label = np.array([r[2] for r in rows])
    u = x / np.sqrt((x * x).sum(1))[:, None]
    hit = (u @ u.T >= least) & (label[:, None] == label)
    np.fill_diagonal(hit, False)
    low = np.array(ids)
    while True:
        new = np.minimum(low, np.where(hit, low[None, :], 10 ** 9).min(1))
        if (new == low).all():
            return {i: (int(h), int(c)) for i, h, c in zip(ids, hit.sum(1), low)}
        low = new


@pytest.mark.parametrize("block", [16, 1024])
def test_links_equal_brute_force(spark, block):
    rows = data(1)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in E.links(df, block=block).collect()}
    assert got == brute(rows, 0.93)


def test_dual_traversal_equals_all_pairs():
    rng = np.random.default_rng(3)
    x = E.unit(np.r_[rng.standard_normal((60, 5)), np.repeat(rng.standard_normal((1, 5)), 40, 0) + 1e-9 * rng.standard_normal((40, 5))])
    a, b = E.CoverTree(x[:70]), E.CoverTree(x[30:])
    i, j = E.dual_pairs(a, b, 0.6)
    d = np.sqrt(np.maximum(0, 2 - 2 * x[:70] @ x[30:].T))
    assert set(zip(*np.nonzero(d <= 0.6))) <= set(zip(i, j)) and len(set(zip(i, j))) == len(i)
    i, j = E.dual_pairs(a, a, 0.6)
    d = np.sqrt(np.maximum(0, 2 - 2 * x[:70] @ x[:70].T))
    pairs = {(min(p), max(p)) for p in zip(i, j)}
    assert {(p, q) for p, q in zip(*np.nonzero(d <= 0.6)) if p < q} <= pairs and len(pairs) == len(i)


def test_edges(spark):
    schema = "vec_id long, embedding array<float>, label int, id int, v int, cell int"
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None), (6, None, 1),
            (7, [0.0, 0.0], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [1.0, None], 1), (11, [], 1), (12, [1.0, 0.0, 0.0], 1),
            (3, [1.0, 0.0], 1)]
    df = spark.createDataFrame([(*r, None, None, None) for r in rows], schema)
    got = {}
    for r in E.links(df).collect():
        got.setdefault(r.vec_id, []).append((r.n_links, r.component_id, r.kept))
    assert got[1] == [(3, 1, True)] and got[2] == [(3, 1, False)] and got[3] == [(3, 1, False)] * 2
    assert all(got[k] == [(0, k, True)] for k in range(4, 13))
    assert E.links(df.limit(0)).count() == 0


def test_one_vec_id_on_two_vectors(spark):
    rows = [(3, [1.0, 0.0], 0), (3, [0.0, 1.0], 0), (4, [1.0, 0.01], 0), (5, [0.01, 1.0], 0), (6, [0.02, 1.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in E.links(df).collect())
    assert got == [(3, 1, 3, True), (3, 2, 3, True), (4, 1, 3, False), (5, 2, 3, False), (6, 2, 3, False)]
