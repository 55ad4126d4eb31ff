"""Filter audit against a walk through every order, document by document."""

import re
from collections import defaultdict
from itertools import permutations

from edge_data import EDGES, SF, documents

from shelfrank.llm import filter_audit as A

LABELS = "doc_id long, quality int, toxic int"


def by_hand(rows, labels):
    first, out = {}, defaultdict(lambda: [0] * 6)
    for key, text, _ in rows:
        if key is not None:
            first[text or ""] = min(key, first.get(text or "", key))
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    seen = []
    for key, text, part in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {f for f, bad in zip("ABCDE", [
            len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            bool(re.search("[#$%&*|]", t)), key is not None and first[t] < key], strict=True) if bad}
        seen.append((part or "", fails, key in good, key in toxic))
    for part in {s[0] for s in seen}:
        for order in permutations("ABCDE"):
            alive = [s for s in seen if s[0] == part]
            mine = list(alive)
            for step, f in enumerate(order, 1):
                gone = [s for s in mine if f in s[1]]
                mine = [s for s in mine if f not in s[1]]
                out[part, "".join(order), step] = [
                    len(mine), len(gone), sum(f in s[1] for s in alive) - len(gone), sum(s[1] == {f} for s in alive),
                    sum(s[2] for s in gone), sum(s[3] for s in gone)]
    shapley = defaultdict(int)
    for (part, order, step), v in out.items():
        shapley[part, order[step - 1]] += v[1]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def as_dict(df):
    rows = df.collect()
    out = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost,
                                              r.shapley) for r in rows}
    assert len(out) == len(rows)
    return out


def run(docs, labels):
    return as_dict(A.audit(A.document_masks(docs, labels), "ABCDE", ["good", "toxic"]))


def test_intervals_cover_every_order_once():
    for n in (1, 3, 5):
        orders = list(permutations(range(n)))
        found = defaultdict(set)
        for mask, step, lo, hi in A.removal_intervals(n):
            for rank in range(lo, hi):
                assert rank not in found[mask]
                found[mask].add(rank)
                hits = [i for i, f in enumerate(orders[rank], 1) if mask >> f & 1]
                assert hits[0] == step
        assert all(len(found[m]) == len(orders) for m in range(1, 1 << n))


def test_whole_table_equals_every_order_walked(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    want = by_hand([tuple(r) for r in docs.select("doc_id", "text", "lang").collect()],
                   [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])
    assert as_dict(A.op11_filter_audit(spark, SF)) == want


def test_edges(spark, edges):
    labels = [(1, 1, 0), (1, 0, 1), (5, 1, 1), (9, 1, None), (None, 1, 1), (6, None, 1)]
    rows = [(d, t, "en") for d, t in EDGES]
    got = run(edges, spark.createDataFrame(labels, LABELS))
    assert got == by_hand(rows, labels)
    assert len(got) == 600


def test_parts_without_language_and_copies(spark):
    text = "A b C " * 40
    rows = [(d, text if d % 3 else f"{text}{d} $", (None, "", "de")[d % 4 % 3]) for d in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = [(d, d % 2, d % 5 == 0) for d in range(0, 60, 2)]
    labels = [(a, b, int(c)) for a, b, c in labels]
    assert run(docs, spark.createDataFrame(labels, LABELS)) == by_hand(rows, labels)


def test_no_documents(spark, nothing):
    assert run(nothing, spark.createDataFrame([], LABELS)) == {}
    assert documents(spark, []).count() == 0
