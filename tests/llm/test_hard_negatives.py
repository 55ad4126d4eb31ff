"""Hard negatives against sorting all rows by exact integer scores."""

import math

import numpy as np
import pytest
from edge_data import SF
from pyspark.sql import functions as F

from shelfrank.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int, id int, v int, dim int, own int, score int"


def by_hand(rows, anchor, k=5, low=80, high=100):
    good = sorted({(i, lab, tuple(math.floor(256 * x) for x in v)) for i, v, lab in rows
                   if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)})
    out = []
    for a in good:
        if not anchor(a[0]):
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[2], b[2], strict=True)), b[0], b[1]) for b in good if b != a and len(b[2]) == len(a[2]))
        for p, pid, _ in [s for s in scored if s[2] == a[1]][:k]:
            inside = [s for s in scored if s[2] != a[1] and low * -p <= 100 * -s[0] <= high * -p][:k]
            out += [(a[0], pid, r, s[1], -p, -s[0]) for r, s in enumerate(inside, 1)]
    return sorted(out)


def mined(spark, rows, anchor=lambda i: i % 3 == 0, **kw):
    df = spark.createDataFrame([(i, v, lab, *[None] * 5) for i, v, lab in rows], SCHEMA)
    got = H.hard_negatives(df, "vec_id", F.col("label"), "embedding", F.col("id") % 3 == 0, **kw)
    return sorted(tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def test_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    rows = [(i, v, (lab + 1) % 10 if i % 7 == 0 else lab) for i, v, lab in rows]
    got = H.op13_hard_negatives(spark, SF)
    assert dict(got.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint",
                                "positive_score": "bigint", "negative_score": "bigint"}
    got = sorted(tuple(r) for r in got.collect())
    assert got and got == by_hand(rows, lambda i: i % 100 == 0)


@pytest.mark.parametrize("sizes", [(64, 4, 2, 2, 1), (4096, 512, 16, 1, 3)])
def test_many_blocks_ties_and_repeats(spark, monkeypatch, sizes):
    block, group, tile, groups, step = sizes
    monkeypatch.setattr(H, "BLOCK_ROWS", block)
    monkeypatch.setattr(H, "GROUP_ROWS", group)
    monkeypatch.setattr(H, "TILE_BLOCKS", tile)
    monkeypatch.setattr(H, "TILE_GROUPS", groups)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(4, 6))
    rows = [(int(i), (centres[i % 4] + rng.normal(size=6) * 0.3).round(1).tolist(), int(i % 3)) for i in range(300)]
    rows += [(1000 + i, rows[3][1], i % 3) for i in range(40)] + rows[:20]       # equal vectors; whole rows again
    assert mined(spark, rows) == by_hand(rows, lambda i: i % 3 == 0)
    rows += [(3, [1.0] * 6, 0), (3, [2.0] * 6, 1)]                               # one id, other contents
    assert mined(spark, rows) == by_hand(rows, lambda i: i % 3 == 0)


def test_rows_that_take_no_part(spark):
    good = [(i, [0.5, i / 10, -0.25], i % 2) for i in range(12)]
    bad = [(20, None, 0), (21, [0.5, None, 1.0], 0), (24, [float("nan"), 0.1, 0.2], 1), (27, [float("inf"), 0.1, 0.2], 1),
           (30, [0.5, 0.6, 0.7], None), (None, [0.5, 0.6, 0.7], 1), (33, [], 1), (36, [0.5, 0.6], 1), (39, [0.0, 0.0, 0.0], 1),
           (42, [-9.0, 0.0, 0.0], 0)]
    assert mined(spark, good + bad) == by_hand(good + bad, lambda i: i % 3 == 0)
    assert mined(spark, []) == []
    assert mined(spark, [(None, None, None)]) == []


def test_too_large_components_are_refused(spark):
    with pytest.raises(ValueError, match="62 bits"):
        mined(spark, [(0, [-1e300, 1.0], 0), (1, [1.0, 1.0], 0)])


def test_bounds_leave_few_rows_to_read(spark):
    """Most rows leave the bitmap before all dimensions are read."""
    rng = np.random.default_rng(1)
    x = np.floor(256 * rng.normal(size=(64, 2000)) / np.arange(1, 65)[:, None]).astype(np.int64)
    block = H.Block(type("R", (), {"ids": np.arange(2000).tobytes(), "labels": (np.arange(2000) % 2).tobytes(),
                                   "columns": x.tobytes(), "dim": 64}))
    left = []
    rows, least, greatest = block.of_label(0)

    def keep(lo, hi):
        alive = hi >= H._kth(lo, 5)
        left.append(int(alive.sum()))
        return alive

    got, scores = H.scan(block, rows, least, greatest, x[:, 0], keep)
    want = x[:, 0] @ x[:, rows]
    assert sorted(scores)[-5:] == sorted(want)[-5:]
    assert left[3] < len(rows) / 2 and left[-1] <= left[3]
