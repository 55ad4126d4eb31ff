import pandas as pd
import pytest

import corpus_pipeline as P
from shelfrank.llm import decontaminate, line_dedup, near_dedup
from shelfrank.llm.common import table, written

from edge_data import SF, documents


@pytest.fixture(scope="module")
def stages(spark):
    """Output of each stage, by name, and the input under ''."""
    docs = table(spark, SF, "documents")
    out = {"": docs}
    for name, stage in P.STAGES:
        docs = written(stage(spark, docs, SF), "test-stage")
        out[name] = docs
    return out


def rows(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_quality_rejects_what_the_labels_reject(stages):
    kept = rows(stages["quality classifier"])
    labels = pd.read_parquet(f"{SF}/labels.parquet")
    assert len(kept) > 100
    assert sum(d in kept for d in labels[labels.quality == 1].doc_id) >= 0.95 * (labels.quality == 1).sum()
    assert sum(d in kept for d in labels[labels.quality == 0].doc_id) <= 0.2 * (labels.quality == 0).sum()


def test_lines_equal_brute_force(stages):
    from test_line_dedup import brute
    before, after = rows(stages["quality classifier"]), rows(stages["line dedup"])
    gone = brute(list(before.items()), 80)
    for d, t in before.items():
        left = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone.get(d, []))
        assert after.get(d) == (left if d not in gone or left.strip() else None)


def test_one_of_each_group_stays(stages):
    from test_near_dedup import brute
    before, after = rows(stages["line dedup"]), rows(stages["MinHash near-dedup"])
    assert set(after) == {d for d, (_, c) in brute(list(before.items()), 5, 80).items() if c == d}


def test_contaminated_documents_go(spark, stages):
    from test_decontaminate import brute
    before, after = rows(stages["MinHash near-dedup"]), rows(stages["benchmark decontamination"])
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    assert set(before) - set(after) == {d for d, _ in brute(list(before.items()), items)}


def test_pieces_decode_to_the_text(spark, stages):
    from shelfrank.llm.sentencepiece import UnigramModel, decode
    out = stages["SentencePiece encoding"]
    assert out.where("not round_trip").count() == 0
    assert rows(decode(out, UnigramModel.load(spark))) == rows(stages["benchmark decontamination"])


def test_columns_and_run(spark, stages):
    for name in list(stages)[:5]:
        assert stages[name].columns == stages[""].columns
    assert P.run(spark, SF).count() == stages["SentencePiece encoding"].count()


def test_edges(spark, edges, nothing):
    for name, stage in P.STAGES:
        out = stage(spark, edges, SF)
        assert out.count() <= edges.count()
        if name != "SentencePiece encoding":
            assert out.columns == edges.columns
        assert stage(spark, nothing, SF).count() == 0
    kept = P.near_duplicate(spark, edges, SF)
    assert sorted(r.doc_id or 0 for r in kept.select("doc_id").collect()) == [0, 1, 2, 3, 4, 5, 7, 10]


def test_rows_are_judged_by_their_texts(spark):
    """Rows without doc_id or with a repeated one: copies and benchmark items go, other texts stay."""
    item = table(spark, SF, "benchmark").first().text
    rows = [(1, "a b c d e f g h i j"), (None, "a b c d e f g h i j"), (2, "k l m n o p q r"), (2, "s t u v w x y z"),
            (None, item), (3, item), (3, "one two three four five six")]
    docs = documents(spark, rows)
    assert sorted(r.text for r in P.near_duplicate(spark, docs, SF).collect()) == sorted({t for _, t in rows})
    assert sorted(r.text for r in P.benchmark(spark, docs, SF).collect()) == sorted(t for _, t in rows if t != item)
