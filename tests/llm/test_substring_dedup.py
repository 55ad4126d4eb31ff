import hashlib
import random

import pytest

from shelfrank.llm import substring_dedup as R

from edge_data import documents


def texts(seed, n=40):
    rnd = random.Random(seed)
    parts = ["".join(rnd.choices("abcdefgh é", k=rnd.randrange(60, 400))) for _ in range(12)]
    rows = []
    for d in range(n):
        t = "".join(rnd.choice(parts)[rnd.randrange(0, 40):] if rnd.random() < 0.6 else "".join(rnd.choices("abcdefghij", k=150))
                    for _ in range(rnd.randrange(0, 6)))
        rows.append((d * 2 + 1, t))
    return rows + [(200, "ab" * 300), (201, "b" * 250), (202, "b" * 99)]


def brute(rows, least):
    seen, out = set(), {}
    for d, t in sorted(rows):
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - least + 1):
            w = b[i:i + least]
            if w in seen:
                gone[i:i + least] = [True] * least
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot,chunk", [(100_000, 2_000_000), (100_000, 4_000), (2, 2_000_000)])
def test_removed_bytes_equal_brute_force(spark, hot, chunk):
    rows = texts(1)
    df = documents(spark, rows)
    got = R.without_repeats(df, R.repeats(df, hot=hot, chunk_bytes=chunk), digest=True).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute(rows, 100)


def test_groups_are_repeats_with_all_occurrences(spark):
    rows = texts(2)
    raw = {d: (t or "").encode() for d, t in rows}
    out = R.repeats(documents(spark, rows)).toPandas()
    places = {(r.chunk, r.low): (r.doc, r.start) for r in out[out.kind == "place"].itertuples()}
    groups = out[out.kind == "group"]
    assert len(groups)
    for g in groups.itertuples():
        at = [places[(g.chunk, k)] for k in range(int(g.low), int(g.high) + 1)]
        strings = {raw[d][int(s):int(s) + int(g.length)] for d, s in at}
        assert len(at) >= 2 and len(strings) == 1 and len(strings.pop()) == g.length >= 100
    for c in out[out.kind == "copy"].itertuples():
        assert raw[c.doc][int(c.start):int(c.start) + int(c.length)] == raw[c.low][int(c.high):int(c.high) + int(c.length)]


def test_interval_tree_of_one_chunk():
    blocks = [b"x" + b"the same words again" + b"1", b"y" + b"the same words again" + b"2", b"z" + b"same words again" + b"2"]
    import numpy as np
    t = R.IntervalTree(blocks, np.array([5, 6, 7]), np.zeros(3, int), 8)
    found = {(n, tuple(sorted((int(t.doc[k]), int(t.start[k])) for k in range(lo, hi + 1)))) for n, lo, hi in t.groups}
    assert (20, ((5, 1), (6, 1))) in found                       # 'the same words again'
    assert (16, ((5, 5), (6, 5), (7, 1))) in found               # all three occurrences, not just neighbours
    assert (17, ((6, 5), (7, 1))) in found                       # '...again2'
    assert not any(n == 19 for n, _ in found)                    # 'he same...' is the group one byte to the left


def test_edges(edges, nothing):
    got = {}
    for r in R.without_repeats(edges, R.repeats(edges, groups=False)).collect():
        got.setdefault(r.doc_id, []).append((r.n_bytes, r.n_removed))
    assert got[2] == [(0, 0)] and got[3] == [(0, 0)] and got[4] == [(4, 0)] and got[5][0][1] == 0
    assert got[6][0][0] - got[6][0][1] == 3                      # LONG + 'end': all but the end starts earlier
    assert len(got[1]) == 2 and len(got[None]) == 2
    assert R.without_repeats(nothing, R.repeats(nothing)).count() == 0


@pytest.mark.parametrize("hot", [2, 100_000])
def test_groups_completed_by_copies_hold_all_occurrences(spark, hot):
    """Of every repeated window, in split anchors and in exact copies of a document too."""
    rnd = random.Random(5)
    passage, whole = ("".join(rnd.choices("abcdefgh ", k=n)) for n in (130, 500))
    rows = texts(3, 20) + [(300 + i, f"{''.join(rnd.choices('xyz', k=40))}{passage}{''.join(rnd.choices('xyz', k=40))}")
                           for i in range(12)] + [(400 + i, whole) for i in range(3)]
    every = {}
    for d, t in rows:
        b = t.encode()
        for i in range(len(b) - 99):
            every.setdefault(b[i:i + 100], set()).add((d, i))
    every = {w: at for w, at in every.items() if len(at) > 1}
    raw = {d: t.encode() for d, t in rows}
    out = R.repeats(documents(spark, rows), hot=hot).toPandas()
    assert not out[out.kind == "place"].duplicated(["chunk", "low"]).any()
    copies, places, found = {}, {}, {}
    for c in out[out.kind == "copy"].itertuples():
        for o in range(int(c.length) - 99):
            copies.setdefault((c.low, c.high + o), set()).add((c.doc, c.start + o))
    for r in out[out.kind == "place"].itertuples():
        places[r.chunk, r.low] = r.doc, r.start

    def completed(at):
        at = new = set(at)
        while new:
            new = {y for x in new for y in copies.get(x, ())} - at
            at = at | new
        return at

    for g in out[out.kind == "group"].itertuples():
        at = [places[g.chunk, k] for k in range(int(g.low), int(g.high) + 1)]
        for o in range(int(g.length) - 99):
            d, i = at[0][0], int(at[0][1]) + o
            found.setdefault(raw[d][i:i + 100], []).append(completed((x, y + o) for x, y in at))
    in_passage = {passage.encode()[i:i + 100] for i in range(31)}
    assert in_passage <= every.keys()
    for w, at in every.items():
        if w in found:
            assert at in found[w] and all(f <= at for f in found[w])
        else:                                                    # only in copies of one cell
            assert completed([min(at)]) == at
    if hot > 2:
        assert in_passage <= found.keys()                        # in different cells or their common part
    assert found.keys() & every.keys()


def test_different_texts_of_one_doc_id(spark):
    rnd = random.Random(8)
    p, q, r = ("".join(rnd.choices("abcdefghij", k=300)) for _ in range(3))
    docs = documents(spark, [(1, p), (2, p + q[:100]), (2, r + q[100:200]), (None, q), (1, p)])
    got = [(x.doc_id, x.n_bytes, x.n_removed) for x in R.without_repeats(docs, R.repeats(docs, groups=False)).collect()]
    assert sorted(got, key=str) == [(1, 300, 0), (1, 300, 0), (2, 400, 0), (2, 400, 300), (None, 300, 200)]
    docs = documents(spark, [(1, p + q), (1, p + r)])
    got = [x.n_removed for x in R.without_repeats(docs, R.repeats(docs, groups=False)).collect()]
    assert sorted(got) == [0, 300]
