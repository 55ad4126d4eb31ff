"""Equal-width histograms against numpy, including the const_col fixture (min == max)."""
import numpy as np
import pandas as pd

from shelfrank.operators import eda
from shelfrank.sources import roles

from paths import SF_SMALL


def test_constant_column_histogram_uses_unit_range(spark):
    df = spark.createDataFrame(pd.DataFrame({"price": [5.0, 5.0, 5.0]}))
    h = eda.histogram(df, "price", 4).orderBy("bin").toPandas()
    counts, edges = np.histogram([5.0, 5.0, 5.0], bins=4)
    assert h.n.tolist() == counts.tolist()
    assert np.allclose(h.bin_lo, edges[:-1]) and np.allclose(h.bin_hi, edges[1:])


def test_global_and_grouped_histograms_match_numpy(spark):
    items = roles.items(spark, SF_SMALL)
    pdf = items.toPandas()
    h = eda.histogram(items, "price", 30).orderBy("bin").toPandas()
    counts, _ = np.histogram(pdf.price, bins=30)
    assert h.n.tolist() == counts.tolist()          # last bin closed, as numpy
    g = eda.histogram(items, "item_attr_0", 20, group="category").toPandas()
    for cat, sub in pdf.groupby("category"):
        want, _ = np.histogram(sub.item_attr_0, bins=20)
        got = g[g.category == cat].sort_values("bin").n.tolist()
        assert got == want.tolist(), cat


def test_coverage_of_slices_from_kept_sketches(spark):
    log = spark.createDataFrame([(u, (u * 7 + s) % 900, s) for s in range(5) for u in range(s * 300, s * 300 + 1000)]
                                + [(None, 3, 2), (5, None, 9)], "user_idx long, item_idx long, s int")
    exact = {r["slice"]: (r.active_users, r.active_items) for r in eda.exact_coverage_until(log, "s").collect()}
    rows = log.collect()
    for s in (0, 1, 2, 3, 4, 9):
        old = [r for r in rows if r.s <= s]
        assert exact[s] == (len({r.user_idx for r in old} - {None}), len({r.item_idx for r in old} - {None}))
    kept = eda.coverage_sketches(log.where("s < 3"), "s").unionByName(eda.coverage_sketches(log.where("s >= 3"), "s"))
    for r in eda.coverage_until(kept).collect():
        for got, want in zip((r.active_users, r.active_items), exact[r["slice"]]):
            assert abs(got / want - 1) < 5 * 1.04 / 64
    assert eda.coverage_until(eda.coverage_sketches(log.limit(0), "s")).count() == 0


def test_density_of_more_than_two_to_the_31_pairs(spark):
    log = spark.createDataFrame([(1, 1), (2, 3)], "user_idx long, item_idx long")
    row = eda.density(log, spark.range(60_000), spark.range(50_000)).first()
    assert row.n_users * row.n_items == 3_000_000_000 and row.density_pct == round(2 / 3e9 * 100, 6)
