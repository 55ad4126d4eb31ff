"""The recurrent network against scalar loops, numeric gradients and held-out labels."""

import math

import numpy as np
import pandas as pd
import pytest
from edge_data import EDGES, LONG, SF

from shelfrank.llm import toxicity as X

LABELS = "doc_id long, quality int, toxic int"


def small_model(seed=1):
    m = X.ToxicityModel(seed=seed)
    rng = np.random.default_rng(seed)
    m.tables = [rng.normal(size=t.shape).astype(np.float32) for t in m.tables]
    m.head = (np.zeros(4), np.ones(4), np.array([0.5, 0.3, 1.0, -0.1]), -0.2)
    return m


def window_logit(m, words):
    """One window, word by word and unit by unit."""
    p, h = {k: np.asarray(v, float) for k, v in m.p.items()}, X.HIDDEN
    x = np.asarray(m.inputs(X.Words(words)), float)
    sig = lambda v: 1 / (1 + np.exp(-v))
    states = []
    for d, steps in ((0, range(len(words))), (1, range(len(words) - 1, -1, -1))):
        state, found = np.zeros(h), {}
        for t in steps:
            into, back = x[t] @ p["W"][d] + p["b"][d, 0], state @ p["U"][d]
            r, z = sig(into[:h] + back[:h]), sig(into[h:2 * h] + back[h:2 * h])
            new = np.tanh(into[2 * h:] + r * back[2 * h:])
            state = z * state + (1 - z) * new
            found[t] = state
        states.append([found[t] for t in range(len(words))])
    both = np.concatenate(states, axis=1)
    e = np.tanh(both @ p["A"] + p["a"]) @ p["v"]
    w = np.exp(e - e.max())
    return float((w / w.sum()) @ both @ p["w"] + p["c"])


def test_windows_reach_every_word():
    for n in list(range(0, 200)) + [4000]:
        covered = set()
        for s in X.window_starts(n):
            covered |= set(range(s, min(n, s + X.WINDOW)))
        assert covered == set(range(n))
        assert n <= X.WINDOW or len(X.window_starts(n)) > 1


def test_word_inputs_one_by_one():
    words = ["Idiot,", "idiot", "été", "a", "--", "x" * 5000, "日本"]
    m = small_model()
    together = m.inputs(X.Words(words))
    assert np.allclose(together, np.vstack([m.inputs(X.Words([w])) for w in words]), atol=1e-5)
    assert np.allclose(together[0], together[1])
    raw = b"\x02idiot\x03"
    total, count = np.zeros(X.GRAM_DIM), 0
    for size in X.GRAMS:
        for i in range(len(raw) - size + 1):
            h = size
            for c in raw[i:i + size]:
                h = (h * 1_000_003 + c) % (1 << 64)
            total += m.tables[1][(h * int(X.MIX) % (1 << 64)) >> (64 - X.GRAM_BITS)]
            count += 1
    assert np.allclose(together[1][X.WORD_DIM:], total / count, atol=1e-4)


def test_scores_equal_scalar_loops():
    m = small_model()
    texts = ["one two three", LONG[:3000], "word " * 100, "", None, " \n", "a"]
    got = m.score(texts)
    for t, s in zip(texts, got, strict=True):
        words = (t or "").split()
        logits = sorted((window_logit(m, words[i:i + X.WINDOW]) for i in X.window_starts(len(words))), reverse=True)
        if not logits:
            assert s == m.share
            continue
        f = [logits[0], logits[min(1, len(logits) - 1)], np.mean([1 / (1 + math.exp(-x)) for x in logits]), math.log(len(logits))]
        assert s == pytest.approx(1 / (1 + math.exp(-(np.dot(f, m.head[2]) + m.head[3]))), abs=1e-4)


def test_gradients_equal_differences():
    m = small_model(3)
    rng = np.random.default_rng(0)
    mask = np.zeros((5, 7), np.float32)
    for i, n in enumerate([7, 3, 1, 5, 7]):
        mask[i, :n] = 1
    x = rng.normal(size=(5, 7, X.WORD_DIM + X.GRAM_DIM)).astype(np.float32)
    y = np.array([0.0, 1, 1, 0, 1])

    def run(x):
        both = np.stack([x, x[:, ::-1]])
        into = np.stack([both[i] @ m.p["W"][i] + m.p["b"][i] for i in (0, 1)])
        return both, m.forward(lambda t: into[:, :, t], mask, keep=True)

    def loss(x):
        logit = run(x)[1][0].astype(float)
        return float((np.logaddexp(0, logit) - y * logit).sum())

    both, (logit, kept) = run(x)
    g, d_x = m.backward((X.sigmoid(logit) - y).astype(np.float32), kept, both)
    d_x = d_x[0] + d_x[1][:, ::-1]
    assert not d_x[mask == 0].any()

    def difference(a, at, step=0.02):
        keep = a[at]
        a[at] = keep + step
        up = loss(x)
        a[at] = keep - step
        down = loss(x)
        a[at] = keep
        return (up - down) / (2 * step)

    for name, a in list(m.p.items()) + [("x", x)]:
        a = m.p[name] = np.array(a) if name != "x" else x
        want = g[name] if name != "x" else d_x
        for _ in range(12):
            at = tuple(int(rng.integers(n)) for n in a.shape)
            assert difference(a, at) == pytest.approx(float(np.asarray(want)[at]), abs=4e-3, rel=2e-2), name
    m.p.pop("x")


def test_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = X.train(docs, labels, steps=250)
    got = X.score(docs.select("doc_id", "text"), model).toPandas().merge(labels.toPandas(), on="doc_id")
    got = got[got.doc_id.map(lambda d: __import__("zlib").crc32(str(d).encode()) % 5 == 0)]
    assert len(got) > 500
    found = got.score >= X.TOXIC
    assert found[got.toxic == 1].mean() > 0.7
    assert found[got.toxic == 0].mean() < 0.04


def test_query(spark):
    got = X.op12_toxicity(spark, SF)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    pdf = got.toPandas()
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    assert sorted(pdf.doc_id) == sorted(docs.doc_id)
    assert pdf.score.between(0, 1).all()
    assert (pdf.predicted == (pdf.score >= 0.5)).all()


def test_edges(spark, edges, nothing):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(1, 60)] + [(5, None, None), (None, 1, 1), (7, 0, 0)], LABELS)
    m = X.train(edges, labels, steps=5)
    out = X.score(edges, m)
    assert out.columns == [c for c in edges.columns if c not in ("score", "text")] + ["score"]
    rows = out.collect()
    assert len(rows) == len(EDGES) and all(0 <= r.score <= 1 for r in rows)
    same = [r.score for r in rows if r.doc_id in (1, 9)]
    assert max(same) - min(same) < 1e-6
    assert [r.score for r in rows if r.doc_id in (2, 3, 4)] == [m.share] * 3
    again = X.train(edges, labels, steps=5)
    assert [r.score for r in X.score(edges, again).collect()] == [r.score for r in rows]
    assert X.score(nothing, m).count() == 0
    assert [r.score for r in X.score(edges, X.train(edges, spark.createDataFrame([], LABELS))).collect()] == [0.5] * len(EDGES)
    only = spark.createDataFrame([(i, 1, 0) for i in range(60)], LABELS)
    assert {r.score for r in X.score(edges, X.train(edges, only)).collect()} == {0.0}
    assert X.train(nothing, labels).head is None
