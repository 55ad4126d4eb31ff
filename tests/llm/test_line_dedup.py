import duckdb
import pytest

from shelfrank.llm import line_dedup as L

from edge_data import SF, documents


def brute(rows, percent):
    """{doc_id: line numbers that have an earlier line of Jaccard similarity percent / 100}"""
    lines = [((d is None, d or 0), i, d, frozenset(x.lower().split())) for d, t in sorted(set(rows), key=lambda r: (r[0] is None, r[0]))
             if t for i, x in enumerate(t.split("\n"))]
    gone, seen = {}, []
    for _, i, d, s in lines:
        if s:
            if any(100 * len(s & o) >= percent * len(s | o) for o in seen):
                gone.setdefault(d, []).append(i)
            seen.append(s)
    return gone


def near_lines():
    import random
    rnd = random.Random(7)
    vocabulary = [f"v{i}" for i in range(150)]
    pool = [[rnd.choice(vocabulary) for _ in range(rnd.choice([1, 2, 4, 5, 9, 20, 45]))] for _ in range(40)]
    rows = []
    for d in range(30):
        lines = []
        for _ in range(rnd.randrange(1, 9)):
            words = list(rnd.choice(pool))
            for _ in range(rnd.randrange(0, 1 + len(words) // 5)):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            lines.append(" ".join(words))
        rows.append((d * 3, "\n".join(lines)))
    return rows


def removed(df, **k):
    gone, places = L.removed_lines(df, **k)
    out = {}
    for r in gone.collect():
        out.setdefault(None if r.doc == places.none else r.doc, []).append(r.line)
    return {d: sorted(x) for d, x in out.items()}


@pytest.mark.parametrize("near", [1, 3, 64])
def test_equals_brute_force(spark, near):
    rows = near_lines()
    assert removed(documents(spark, rows), near=near) == brute(rows, 80)


def test_places_that_do_not_fit_a_long(spark):
    rows = [(d - 40 if d else -2 ** 62, t) for d, t in near_lines()]
    assert removed(documents(spark, rows)) == brute(rows, 80)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = {r[0]: r[1:] for r in con.execute(f"SELECT doc_id, n_lines, n_removed, removed FROM ({L.ORACLE})").fetchall()}
    got = {r.doc_id: (r.n_lines, r.n_removed, r.removed) for r in L.op9_line_dedup(spark, SF).collect()}
    assert got == want


def test_remaining_text_and_edges(spark, edges, nothing):
    rows = [(1, "a b c d\n\nkeep this line"), (2, "A B C D\nnew words here"), (3, "a b c d\nKEEP THIS line"), (4, None), (5, "")]
    got = {r.doc_id: r.text for r in L.without_repeated_lines(documents(spark, rows)).collect()}
    assert got == {1: "a b c d\n\nkeep this line", 2: "new words here", 4: None, 5: ""}
    out = L.without_repeated_lines(edges)
    assert out.columns == edges.columns
    left = [(r.doc_id, r.text) for r in out.collect()]
    assert len([d for d, _ in left if d == 1]) == 2 and 9 not in [d for d, _ in left]   # rows of one document are alike
    assert (2, None) in left and (3, "") in left and (None, None) in left
    assert L.without_repeated_lines(nothing).count() == 0
    rows = [(None, "a b c d"), (None, "a b c d\nother line"), (7, "x y z"), (7, "p q r\nx y z")]
    got = [r.text for r in L.without_repeated_lines(documents(spark, rows)).collect()]
    assert sum("a b c d" in t for t in got) == 1 and sum("x y z" in t for t in got) == 1
    assert sum("other line" in t for t in got) == 1 and sum("p q r" in t for t in got) == 1


@pytest.mark.parametrize("near", [64, 2])
def test_colliding_prefix_codes_change_nothing(spark, monkeypatch, near):
    """All prefix words cut to one code: no line matches itself, no similar pair is lost."""
    codes = L.codes
    monkeypatch.setattr(L, "codes", lambda line, classes: L.F.sort_array(L.F.transform(
        codes(line, classes), lambda c: L.F.shiftleft(L.F.shiftright(c, 31), 31))))
    rows = near_lines()
    assert removed(documents(spark, rows), near=near) == brute(rows, 80)


@pytest.mark.parametrize("percent", [60, 75])
def test_other_percentages(spark, percent):
    rows = near_lines()
    assert removed(documents(spark, rows), percent=percent, near=4) == brute(rows, percent)


def test_long_lines_of_one_vocabulary_are_not_all_verified(spark, monkeypatch):
    """Lines with half of their words in common meet under many words; few of their pairs are read again."""
    import random
    rnd, pairs, written = random.Random(3), [], L.written
    rows = [(d, " ".join(rnd.sample([f"v{i}" for i in range(170)], 120))) for d in range(60)]

    def counted(df, name):
        out = written(df, name)
        pairs.extend([out.count()] if name == "line-pairs" else [])
        return out

    monkeypatch.setattr(L, "written", counted)
    assert removed(documents(spark, rows)) == {}
    assert len(pairs) == 2 and sum(pairs) < 60
