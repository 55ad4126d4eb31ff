import zlib

import numpy as np
import pandas as pd

from shelfrank.llm import quality as Q

SF_MID = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = Q.op10_quality_trees(spark, SF_MID).toPandas()
    docs = pd.read_parquet(f"{SF_MID}/documents.parquet")
    assert sorted(got.doc_id) == sorted(docs.doc_id)
    assert (got.held_out == [zlib.crc32(str(d).encode()) % 5 == 0 for d in got.doc_id]).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    m = got[got.held_out].merge(pd.read_parquet(f"{SF_MID}/labels.parquet"), on="doc_id")
    assert len(m) > 30 and (m.predicted == m.quality).mean() >= 0.95


def test_trees_separate_and_flatten():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((3000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    m = Q.BoostedTrees(rounds=40).fit(x[:2000], y[:2000])
    assert ((m.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95

    def walk(row):      # node by node, tree by tree
        s = m.base
        for t in range(len(m.feature)):
            at = 0
            while not m.leaf[t, at]:
                at = 2 * at + 1 + (row[m.feature[t, at]] > m.threshold[t, at])
            s += m.value[t, at]
        return 1 / (1 + np.exp(-s))

    np.testing.assert_allclose(m.score(x[:50]), [walk(r) for r in x[:50]], rtol=1e-12)


def test_edges(spark, edges, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (3, 0, 0), (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    model = Q.train(edges, labels)
    got = Q.score(edges, model, keep_text=True)
    assert got.count() == edges.count() and got.where("score is null").count() == 0
    assert Q.score(nothing, Q.train(nothing, labels)).count() == 0
    none = Q.train(edges, labels.limit(0))
    assert {r.score for r in Q.score(edges, none).select("score").collect()} == {0.5}


def test_bound_of_training_rows_does_not_depend_on_the_label(spark, monkeypatch):
    kept = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5]
    docs = spark.createDataFrame([(kept[0], "bad words " * (i + 1)) for i in range(60)]
                                 + [(i, "A good sentence. " * (k + 1)) for k, i in enumerate(kept[1:31])], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i != kept[0])) for i in kept[:31]], "doc_id long, quality int")
    seen = {}
    monkeypatch.setattr(Q.BoostedTrees, "fit", lambda self, x, y: seen.update(y=y) or self)
    Q.train(docs, labels, max_rows=40)
    assert len(seen["y"]) == 40 and 5 <= seen["y"].sum() <= 25
