"""Registered profiling queries (A1-A11, J7, S1, P1) with their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfrank.operators import eda
from shelfrank.plans.registry import query, with_roles
from shelfrank.sources import roles

EMB_DIMS = 64


# ---------------------------------------------------------------- SQL helpers
def _hist_sql(src: str, col: str, n_bins: int, group: str | None = None) -> str:
    """Equal-width histogram twin of ``eda.histogram`` over ``src`` (a CTE name)."""
    g = f"{group} AS g, " if group else ""
    gk = "g, " if group else ""
    gjoin = "JOIN st2 USING (g)" if group else ", st2"
    gby = "GROUP BY g" if group else ""
    sel_g = f"grid.g AS {group}, " if group else ""
    using = "USING (g, bin)" if group else "USING (bin)"
    return f"""
vals AS (SELECT {g}CAST({col} AS DOUBLE) AS x FROM {src} WHERE {col} IS NOT NULL),
st AS (SELECT {gk}min(x) AS lo, max(x) AS hi FROM vals {gby}),
st2 AS (SELECT {gk}CASE WHEN hi = lo THEN lo - 0.5 ELSE lo END AS lo2,
               CASE WHEN hi = lo THEN hi + 0.5 ELSE hi END AS hi2 FROM st),
cnt AS (SELECT {gk}CAST(least(floor((x - lo2) / (hi2 - lo2) * {n_bins}), {n_bins - 1}) AS INTEGER) AS bin,
               count(*) AS n FROM vals {gjoin} GROUP BY ALL),
grid AS (SELECT {gk}CAST(range AS INTEGER) AS bin, lo2, (hi2 - lo2) / {n_bins} AS w FROM st2, range(0, {n_bins}))
SELECT {sel_g}grid.bin, round(lo2 + grid.bin * w, 6) AS bin_lo, round(lo2 + (grid.bin + 1) * w, 6) AS bin_hi,
       coalesce(cnt.n, 0) AS n
FROM grid LEFT JOIN cnt {using}"""


# ---------------------------------------------------------------- S1 / P1 / J1
@query("s01_load_log", with_roles("SELECT user_idx, item_idx, ts, relevance, l_orderkey, l_linenumber FROM log"))
def s01_load_log(spark, sf):
    return roles.log(spark, sf)


@query("s01_load_users", with_roles("SELECT * FROM users"))
def s01_load_users(spark, sf):
    return roles.users(spark, sf)


@query("s01_load_items", with_roles("SELECT * FROM items"))
def s01_load_items(spark, sf):
    return roles.items(spark, sf)


# ---------------------------------------------------------------- A1-A4
@query("a01_table_counts", with_roles("""
SELECT 'users' AS table_name, count(*) AS n_rows FROM users
UNION ALL SELECT 'items', count(*) FROM items
UNION ALL SELECT 'log', count(*) FROM log"""))
def a01_table_counts(spark, sf):
    r = roles.load(spark, sf)
    return eda.table_counts({"users": r.users, "items": r.items, "log": r.log})


@query("a02_segment_share", with_roles("""
SELECT segment, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct
FROM users GROUP BY segment"""))
def a02_segment_share(spark, sf):
    return eda.share(roles.users(spark, sf), "segment")


@query("a02_category_share", with_roles("""
SELECT category, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct
FROM items GROUP BY category"""))
def a02_category_share(spark, sf):
    return eda.share(roles.items(spark, sf), "category")


@query("a03_density", with_roles("""
SELECT a.n AS n_interactions, b.n AS n_users, c.n AS n_items,
       round(a.n / (b.n * c.n) * 100.0, 6) AS density_pct
FROM (SELECT count(*) AS n FROM log) a, (SELECT count(*) AS n FROM users) b,
     (SELECT count(*) AS n FROM items) c"""))
def a03_density(spark, sf):
    r = roles.load(spark, sf)
    return eda.density(r.log, r.users, r.items)


@query("a04_coverage", with_roles("""
SELECT a.u AS active_users, a.i AS active_items,
       round(a.u * 100.0 / b.n, 6) AS pct_users, round(a.i * 100.0 / c.n, 6) AS pct_items
FROM (SELECT count(DISTINCT user_idx) AS u, count(DISTINCT item_idx) AS i FROM log) a,
     (SELECT count(*) AS n FROM users) b, (SELECT count(*) AS n FROM items) c"""))
def a04_coverage(spark, sf):
    r = roles.load(spark, sf)
    return eda.coverage(r.log, r.users, r.items)


_UNTIL = """
y AS (SELECT DISTINCT year(ts) AS y FROM log),
c AS (SELECT y.y, count(DISTINCT l.user_idx) AS u, count(DISTINCT l.item_idx) AS i FROM y JOIN log l ON year(l.ts) <= y.y GROUP BY y.y)"""


@query("a04_coverage_by_year", with_roles("""
SELECT CAST(y AS INTEGER) AS slice, u AS active_users, i AS active_items FROM c""", _UNTIL))
def a04_by_year(spark, sf):
    """A4 cumulatively: users and items seen up to each year."""
    return eda.exact_coverage_until(roles.log(spark, sf), F.year("ts"))


@query("a04_approximate_coverage", with_roles("""
SELECT CAST(y AS INTEGER) AS slice, true AS users_close, true AS items_close FROM c""", _UNTIL))
def a04_approximate(spark, sf):
    """A4, approximate option: sketches per year merged up to each year; within five standard errors
    (8 %) of the exact counts."""
    log = roles.log(spark, sf)
    got = eda.coverage_until(eda.coverage_sketches(log, F.year("ts"))).toDF("slice", "au", "ai")
    both = got.join(eda.exact_coverage_until(log, F.year("ts")), "slice")
    return both.select("slice", (F.abs(F.col("au") / F.col("active_users") - 1) < 0.08).alias("users_close"),
                       (F.abs(F.col("ai") / F.col("active_items") - 1) < 0.08).alias("items_close"))


# ---------------------------------------------------------------- A5-A8, J7
@query("a05_interactions_per_user", with_roles("SELECT user_idx, count(*) AS n FROM log GROUP BY user_idx"))
def a05_per_user(spark, sf):
    return eda.counts_by(roles.log(spark, sf), "user_idx")


@query("a05_interactions_per_item", with_roles("SELECT item_idx, count(*) AS n FROM log GROUP BY item_idx"))
def a05_per_item(spark, sf):
    return eda.counts_by(roles.log(spark, sf), "item_idx")


@query("a06_relevance_distribution", with_roles("SELECT relevance, count(*) AS n FROM log GROUP BY relevance"))
def a06_relevance(spark, sf):
    return eda.counts_by(roles.log(spark, sf), "relevance")


@query("a07_segment_category_counts", with_roles("""
SELECT u.segment, i.category, count(*) AS n
FROM log JOIN users u USING (user_idx) JOIN items i USING (item_idx)
GROUP BY u.segment, i.category"""))
def a07_segment_category(spark, sf):
    r = roles.load(spark, sf)
    return eda.counts_by(eda.enrich_log(r.log, r.users, r.items), "segment", "category")


# fixed values: the levels of the category column
_CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
_PIVOT = ", ".join(f"count(*) FILTER (WHERE i.category = '{c}') AS {c}" for c in _CATEGORIES)


@query("a08_segment_category_pivot", with_roles(f"""
SELECT u.segment, {_PIVOT}
FROM log JOIN users u USING (user_idx) JOIN items i USING (item_idx) GROUP BY u.segment"""))
def a08_pivot(spark, sf):
    r = roles.load(spark, sf)
    return eda.segment_category_pivot(eda.enrich_log(r.log, r.users, r.items), _CATEGORIES)


# ---------------------------------------------------------------- A9-A10
def _hist_query(src_cte: str, col: str, bins: int, group: str | None = None,
                extra: str = "") -> str:
    body = _hist_sql(src_cte, col, bins, group)
    ctes, select = body.rsplit("\nSELECT ", 1)
    return with_roles("SELECT " + select, (extra + "," if extra else "") + ctes)


@query("a09_price_histogram", _hist_query("items", "price", 30))
def a09_price_hist(spark, sf):
    return eda.histogram(roles.items(spark, sf), "price", 30)


_PER_USER = "per_user AS (SELECT user_idx, count(*) AS n FROM log GROUP BY user_idx)"
_PER_ITEM = "per_item AS (SELECT item_idx, count(*) AS n FROM log GROUP BY item_idx)"


@query("a09_user_activity_histogram", _hist_query("per_user", "n", 20, extra=_PER_USER))
def a09_user_hist(spark, sf):
    return eda.histogram(eda.counts_by(roles.log(spark, sf), "user_idx"), "n", 20)


@query("a09_item_popularity_histogram", _hist_query("per_item", "n", 20, extra=_PER_ITEM))
def a09_item_hist(spark, sf):
    return eda.histogram(eda.counts_by(roles.log(spark, sf), "item_idx"), "n", 20)


@query("a10_attr_by_segment_histogram", _hist_query("users", "user_attr_0", 20, "segment"))
def a10_attr_by_segment(spark, sf):
    return eda.histogram(roles.users(spark, sf), "user_attr_0", 20, group="segment")


@query("a10_attr_by_category_histogram", _hist_query("items", "item_attr_0", 20, "category"))
def a10_attr_by_category(spark, sf):
    return eda.histogram(roles.items(spark, sf), "item_attr_0", 20, group="category")


@query("a10_price_by_category_histogram", _hist_query("items", "price", 20, "category"))
def a10_price_by_category(spark, sf):
    return eda.histogram(roles.items(spark, sf), "price", 20, group="category")


# ---------------------------------------------------------------- A11
@query("a11_user_attr_corr", with_roles("""
SELECT 'user_attr_1' AS attr_a, 'user_attr_0' AS attr_b, round(corr(user_attr_1, user_attr_0), 6) AS corr
FROM users"""))
def a11_user_corr(spark, sf):
    return eda.correlation_long(roles.users(spark, sf), ["user_attr_0", "user_attr_1"])


def _emb_corr_sql(d: int = EMB_DIMS) -> str:
    pairs = [(j, i) for i in range(d) for j in range(i + 1, d)]
    aggs = ",\n".join(
        f"corr(CAST(embedding[{a + 1}] AS DOUBLE), CAST(embedding[{b + 1}] AS DOUBLE)) AS c{n}"
        for n, (a, b) in enumerate(pairs))
    structs = ", ".join(
        f"{{'attr_a': 'e{a}', 'attr_b': 'e{b}', 'corr': round(c{n}, 6)}}" for n, (a, b) in enumerate(pairs))
    return f"WITH w AS (SELECT {aggs} FROM embeddings)\nSELECT unnest([{structs}], recursive := true) FROM w"


@query("a11_embedding_dim_corr", _emb_corr_sql())
def a11_emb_corr(spark, sf):
    return eda.vector_correlation_long(roles.table(spark, sf, "embeddings"), "embedding", "e")
