import numpy as np
import pytest

from shelfrank.llm import decontaminate as D

from edge_data import SF, documents


def brute(docs, items, overlap=0.8):
    out = set()
    for d, text in docs:
        words = D.words_of(text)
        have = {n: {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} for n in range(1, 6)}
        for k, t in items:
            q, a = (D.shingles(x) for x in D.question_and_answer(t or ""))
            held = lambda s: 1.0 if not s else sum(x in have[len(x)] for x in s) / len(s)
            if (q or a) and held(q) >= overlap and held(a) >= overlap:
                out.add((d, k))
    return out


@pytest.mark.parametrize("per_block", [7, 5000])
def test_equals_brute_force(spark, per_block):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in D.contaminated(docs, items, items_per_block=per_block).collect()}
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert got == want and want


def test_planted_passages(spark):
    item = "What is the tallest tower of the old harbour town? It was built from grey stone in a hard winter. The lantern tower"
    long_item = " ".join(f"w{i}" for i in range(150)) + ". final answer here now please"
    filler = " ".join(f"filler{i}" for i in range(100))
    rows = [(1, f"{filler} {item} {filler}"), (2, item.upper().replace(".", " -")), (3, item.rsplit(".", 1)[0] + ". " + filler),
            (4, filler), (5, f"{filler} {long_item}"), (6, " ".join(f"w{i}" for i in range(60)))]
    items = spark.createDataFrame([(10, item), (11, long_item), (12, None), (13, ""), (11, long_item)], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in D.contaminated(documents(spark, rows), items).collect())
    assert got == [(1, 10), (2, 10), (5, 11), (5, 11)]


def test_wand_finds_every_entry_above_its_threshold():
    rng = np.random.default_rng(2)
    texts = [" ".join(f"t{x}" for x in rng.zipf(1.4, rng.integers(1, 60)) % 300) + ". t1" for _ in range(150)]
    df = {}
    for t in texts:
        for w in set(D.entry_of(t)):
            df[w] = df.get(w, 0) + 1
    index = D.Index([(i, t, 1) for i, t in enumerate(texts)], len(texts), 30.0, df)
    hits = 0
    for k in range(0, 150, 3):
        words = set(D.words_of(" ".join(texts[k:k + 1 + k % 4]))) - {f"t{k % 9}"}
        want = {}
        for e in range(150):
            score = sum(i[es.index(e)] for w, (es, i) in index.postings.items() if w in words and e in es)
            if score >= index.need[e]:
                want[e] = score
        assert index.candidates(words) == pytest.approx(want)
        hits += len(want)
    assert hits > 100


def test_words_lack_no_more_than_shingles():
    """However a set of shingles is taken away, at most as many words lose all their shingles."""
    rng = np.random.default_rng(0)
    for _ in range(3000):
        words = [f"w{x}" for x in rng.integers(0, rng.integers(2, 30), rng.integers(9, 30))]
        every = sorted(D.shingles(words))
        lacking = int(0.2 * len(every) + 1e-9)
        first = int(rng.integers(0, len(words)))
        near = sorted(every, key=lambda s: (words[first] not in s, words[-1] not in s, rng.random()))
        for gone in (set(near[:lacking]), set(map(tuple, rng.permutation(every)[:lacking]))):
            left = {w for s in every if s not in gone for w in s}
            assert len(set(words) - left) <= len(gone)


def test_question_and_answer_far_apart(spark):
    """Both parts at 82 to 85 % of their shingles, with 400 words between."""
    rng = np.random.default_rng(7)
    docs, items = [], []
    for i in range(60):
        q, a = ([f"x{v}" for v in rng.integers(0, 4000, 30)] for _ in range(2))
        items.append((i, " ".join(q) + ". " + " ".join(a) + "."))
        filler = [f"x{v}" for v in rng.integers(0, 4000, 400)]
        docs.append((i, " ".join(q[i % 5:i % 5 + 26] + filler + a[(i + 2) % 5:(i + 2) % 5 + 26])))
    found = D.contaminated(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == brute(docs, items) == {(i, i) for i in range(60)}


def test_edges(spark, edges, nothing):
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta")], "item_id long, text string")
    assert sorted(r.doc_id or 0 for r in D.contaminated(edges, items).collect()) == [0, 1, 1, 9]
    assert D.contaminated(nothing, items).count() == 0
    assert D.contaminated(edges, items.limit(0)).count() == 0
