"""Registered feature queries: P1-P5, J1, J5/J6."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfrank.functions.exprs import r6
from shelfrank.operators import features as fe
from shelfrank.plans.registry import query, with_roles
from shelfrank.sources import roles

TRAIN_END = "1996-01-01"


@query("j01_training_frame", with_roles("""
SELECT l.user_idx, l.item_idx, l.relevance, u.segment, u.user_attr_0, u.user_attr_1,
       i.category, i.brand, i.price, i.item_attr_0
FROM log l JOIN users u USING (user_idx) JOIN items i USING (item_idx)"""))
def j01_training_frame(spark, sf):
    """Log x users x items with ids kept for the check, bookkeeping columns dropped."""
    r = roles.load(spark, sf)
    j = fe.training_frame_raw(r.log, r.users, r.items)
    return j.select("user_idx", "item_idx", "relevance", "segment", "user_attr_0", "user_attr_1",
                    "category", "brand", "price", "item_attr_0")


@query("p02_onehot_users", with_roles("""
SELECT user_idx, segment, CAST(dense_rank() OVER (ORDER BY segment) - 1 AS INTEGER) AS segment_slot,
       CAST((SELECT count(DISTINCT segment) FROM users) AS INTEGER) AS segment_width
FROM users"""))
def p02_onehot_users(spark, sf):
    """One-hot slot (alphabetical level order) and width of the user segment."""
    u = roles.users(spark, sf)
    m = fe.onehot_pipeline(["segment"]).fit(u)
    return fe.onehot_slots(m, u, ["segment"]).select("user_idx", "segment", "segment_slot", "segment_width")


@query("p02_onehot_items", with_roles("""
SELECT item_idx, category, brand,
       CAST(dense_rank() OVER (ORDER BY category) - 1 AS INTEGER) AS category_slot,
       CAST((SELECT count(DISTINCT category) FROM items) AS INTEGER) AS category_width,
       CAST(dense_rank() OVER (ORDER BY brand) - 1 AS INTEGER) AS brand_slot,
       CAST((SELECT count(DISTINCT brand) FROM items) AS INTEGER) AS brand_width
FROM items"""))
def p02_onehot_items(spark, sf):
    it = roles.items(spark, sf)
    m = fe.onehot_pipeline(["category", "brand"]).fit(it)
    return fe.onehot_slots(m, it, ["category", "brand"]).select(
        "item_idx", "category", "brand", "category_slot", "category_width", "brand_slot", "brand_width")


@query("p03_align_unseen_levels", with_roles(f"""
SELECT i.item_idx, i.brand, CAST(t.slot AS INTEGER) AS brand_slot,
       CAST((SELECT count(*) FROM tb) AS INTEGER) AS brand_width
FROM items i LEFT JOIN tb t USING (brand)""", f"""
tb AS (SELECT brand, dense_rank() OVER (ORDER BY brand) - 1 AS slot FROM (
  SELECT DISTINCT i.brand FROM log l JOIN items i USING (item_idx)
  WHERE l.ts < TIMESTAMP '{TRAIN_END}' AND i.category IN (SELECT min(category) FROM items)))"""))
def p03_align(spark, sf):
    """Encoder fitted on one training slice, applied to all items; unseen level -> no slot.

    The training slice is the first year of interactions with items of the first
    category, so some brands are genuinely absent at fit time.
    """
    r = roles.load(spark, sf)
    first_cat = r.items.agg(F.min("category").alias("c"))
    train_items = (r.log.where(F.col("ts") < F.lit(TRAIN_END).cast("timestamp_ntz"))
                   .join(r.items, "item_idx").join(first_cat, F.col("category") == F.col("c"), "left_semi"))
    m = fe.onehot_pipeline(["brand"]).fit(train_items.select("brand"))
    return fe.onehot_slots(m, r.items, ["brand"]).select("item_idx", "brand", "brand_slot", "brand_width")


@query("p04_scaled_price", with_roles("""
SELECT i.item_idx, i.price AS orig_price, round((i.price - s.m) / s.sd, 6) AS scaled_price
FROM items i, (SELECT avg(i2.price) AS m, stddev_pop(i2.price) AS sd
               FROM log JOIN items i2 USING (item_idx)) s"""))
def p04_scaled_price(spark, sf):
    """Price standardised over the training interactions (population std), original kept."""
    r = roles.load(spark, sf)
    fs = fe.FeatureSpace.fit(r.users, r.items, r.log)
    return r.items.select("item_idx", F.col("price").alias("orig_price"),
                          r6(fs.scaled_price()).alias("scaled_price"))


@query("j05_log_with_price", with_roles("""
SELECT l.user_idx, l.item_idx, l.ts, l.relevance, coalesce(i.price, 1.0) AS price
FROM log l LEFT JOIN items i USING (item_idx)"""))
def j05_log_price(spark, sf):
    """Prices left-joined onto the log, missing price -> 1.0."""
    r = roles.load(spark, sf)
    return fe.with_price(r.log, r.items, default=1.0).select("user_idx", "item_idx", "ts", "relevance", "price")
