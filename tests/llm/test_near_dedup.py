import random

import numpy as np
import pytest

from shelfrank.llm import near_dedup as N

from edge_data import documents


def shingles(text, size):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(rows, size, percent):
    """{doc_id: (set size, smallest id reachable)}"""
    sets = {d: shingles(t, size) for d, t in rows if d is not None}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def corpus(seed, n=120):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, base = [], []
    for i in range(n):
        if base and rnd.random() < 0.6:
            words = list(rnd.choice(base))
            for _ in range(rnd.randrange(0, 1 + len(words) // 8)):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        else:
            words = [rnd.choice(vocabulary) for _ in range(rnd.choice([1, 2, 3, 6, 12, 40, 90]))]
        base.append(words)
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("seed,size", [(1, 2), (2, 5)])
def test_components_equal_brute_force(spark, seed, size):
    rows = corpus(seed)
    got = N.near_duplicates(documents(spark, rows), words=size).toPandas()
    want = brute(rows, size, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.itertuples()} == want
    assert (got.kept == (got.doc_id == got.component_id)).all()


def test_cluster_larger_than_a_block(spark):
    """Variants around the threshold: many components inside one bucket, blocks of eight."""
    rnd = random.Random(3)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(90):
        words = list(base)
        for j in rnd.sample(range(60), rnd.randrange(0, 9)):
            words[j] = f"x{i}_{j}"
        rows.append((i, " ".join(words)))
    across = N._across

    def small(*a, **k):
        return across(*a, **{**k, "block": 8})

    N._across = small
    try:
        got = N.near_duplicates(documents(spark, rows), words=2).toPandas()
    finally:
        N._across = across
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.itertuples()} == brute(rows, 2, 80)


def test_estimate_follows_the_true_similarity():
    rng = np.random.default_rng(5)
    for j in (0.2, 0.5, 0.8, 0.95):
        est = []
        for _ in range(40):
            h = np.unique(rng.integers(0, 2 ** 64, 3000, dtype=np.uint64))
            k = int(len(h) * 2 * j / (1 + j))      # common part of two sets of equal size
            half = (len(h) - k) // 2
            a, b = np.sort(h[:k + half]), np.sort(np.r_[h[:k], h[k + half:k + 2 * half]])
            same = (N.registers(a) == N.registers(b)).mean()
            ec = N.expected_collisions(np.array([len(a)]), np.array([len(b)]))[0]
            est.append((same - ec) / (1 - ec) - k / (k + 2 * half))
        assert abs(np.mean(est)) < 0.03


def test_edges(edges, nothing):
    got = {}
    for r in N.near_duplicates(edges).collect():
        got.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert got[1] == [(8, 1, True)] * 2 and got[9] == [(8, 1, False)]
    assert got[2] == [(0, 2, True)] and got[3] == [(0, 3, True)] and got[4] == [(0, 4, True)]
    assert got[6][0][1] == 5 and got[8] == [(1, 7, False)]
    assert sorted(got[None], key=str) == [(0, None, True), (8, 1, False)]
    assert N.near_duplicates(nothing).count() == 0


def test_one_doc_id_on_several_texts(spark):
    """A doc_id joins the sets of all its texts."""
    a, b, c = ("one two three four five", "six seven eight nine ten", "other words that stand alone here")
    rows = [(1, a), (5, a), (5, b), (7, b), (8, c), (9, b), (9, c)]
    got = {(r.doc_id, r.component_id) for r in N.near_duplicates(documents(spark, rows), 2, 80).collect()}
    assert got == {(d, 1) for d in (1, 5, 7, 8, 9)}
    got = N.near_duplicates(documents(spark, [(5, a), (5, b), (7, c)]), 2, 80).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got) == [(5, 5, True), (5, 5, True), (7, 7, True)]
