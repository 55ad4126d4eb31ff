"""Embedding near-dedup: exact cosine-threshold links by dual traversal of cover trees.

For unit vectors cos >= c is a Euclidean distance of at most eps = sqrt(2 - 2c). Equal vectors of a
label are one point with a multiplicity. The points of a label are dealt into cells by their nearest
of a few pivots, and cells into blocks of about ``block`` points. A task builds a cover tree of its
block: the root covers all points; the next level covers a node's points by centres with half its
radius, the node's own centre first, and so on; every node keeps its true covering radius. Two
blocks are compared only if their root balls come within eps; then both trees are descended
together, and a pair of nodes is dropped as soon as the distance of the centres exceeds both radii
plus eps. Pairs of points that remain are checked by cosine in double precision.

A task returns, per point, the number of its links and one edge to the smallest point connected
with it inside the block pair; link lists are never written out.

Defined cases: a vector that is null, empty, all zero, or holds null or non-finite components, and
a vector without label, links with nothing; vectors of different length do not link; equal vectors
link with each other; rows that repeat a vec_id count as vectors, each with links of its own; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.llm.common import components, table, written
from shelfrank.llm.registry import query

LEAF = 24       # nodes of at most so many points are not split further
SLACK = 1e-9    # rounding of distances; every pair is checked by cosine afterwards


class CoverTree:
    """Cover tree of unit vectors. Nodes 0..n-1 are the points; the others have children."""

    def __init__(self, x: np.ndarray):
        self.x = x
        n = len(x)
        self.center, self.radius, self.children = list(range(n)), [0.0] * n, [None] * n
        middle = int(np.argmax(x @ x.mean(0)))
        self.root = self._node(np.arange(n), middle, None)
        self.center, self.radius = np.array(self.center), np.array(self.radius)

    def _distances(self, points: np.ndarray, c: int) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, 2 - 2 * (self.x[points] @ self.x[c])))

    def _node(self, points: np.ndarray, c: int, cover: float | None) -> int:
        if len(points) == 1:
            return int(points[0])
        d = self._distances(points, c)
        radius = float(d.max())
        cover = radius if cover is None else cover
        if len(points) <= LEAF or radius <= 1e-7:
            kids = [int(p) for p in points]
        else:
            half, kids, rest = min(cover, radius) / 2, [], points
            while len(rest):
                near = d <= half if not kids else self._distances(rest, c) <= half
                near |= rest == c
                kids.append(self._node(rest[near], c, half))
                rest = rest[~near]
                c = int(rest[0]) if len(rest) else c
        first = int(self.center[kids[0]])   # the node's centre is the centre of its first child
        self.center.append(first)
        self.radius.append(float(self._distances(points, first).max()))
        self.children.append(np.array(kids))
        return len(self.center) - 1

    def below(self, node: int) -> np.ndarray:
        kids = self.children[node]
        return np.array([node]) if kids is None else kids


def dual_pairs(a: CoverTree, b: CoverTree, eps: float):
    """Arrays (points of a, points of b) with every pair at distance <= eps (and a few just above);
    with ``a is b`` each unordered pair once."""
    found = []
    stack = [(a.root, b.root)]
    n, m = len(a.x), len(b.x)
    while stack:
        u, v = stack.pop()
        ku, kv = a.below(u), b.below(v)
        d = np.sqrt(np.maximum(0.0, 2 - 2 * (a.x[a.center[ku]] @ b.x[b.center[kv]].T)))
        near = d <= a.radius[ku][:, None] + b.radius[kv][None, :] + eps + SLACK
        if a is b and u == v:
            near = np.triu(near)
            near[np.diag_indices(len(ku))] &= ku >= n
        i, j = np.nonzero(near)
        points = (ku[i] < n) & (kv[j] < m)
        found.append((ku[i[points]], kv[j[points]]))
        stack += list(zip(ku[i[~points]].tolist(), kv[j[~points]].tolist(), strict=True))
    return (np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))


def cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1))[:, None]


def _smallest_connected(n: int, i: np.ndarray, j: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id connected with each point."""
    low = ids.copy()
    while True:
        before = low.copy()
        m = np.minimum(low[i], low[j])
        np.minimum.at(low, i, m)
        np.minimum.at(low, j, m)
        if (low == before).all():
            return low


def _block_tree(vectors: str):
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        raw = np.array(pdf[vectors].tolist())
        x = unit(raw.astype(np.float64))
        tree = CoverTree(x)
        body = pickle.dumps((pdf["id"].to_numpy(), pdf["copies"].to_numpy(), raw, tree.center, tree.radius,
                             tree.children, tree.root))
        return pd.DataFrame({"label": pdf["label"].iloc[:1].tolist(), "dim": pdf["dim"].iloc[:1].tolist(),
                             "block": [int(pdf["id"].min())],
                             "middle": [x[tree.center[tree.root]].tolist()], "radius": [float(tree.radius[tree.root])],
                             "body": [body]})
    return build


def _load(body: bytes):
    tree = CoverTree.__new__(CoverTree)
    ids, copies, raw, tree.center, tree.radius, tree.children, tree.root = pickle.loads(body)
    raw = raw.astype(np.float64)
    tree.x = unit(raw)
    return ids, copies, raw, tree


def compare(body_a: bytes, body_b: bytes | None, least: float) -> pd.DataFrame:
    """(id, links, low) of the points with a link between two blocks, or inside one."""
    ia, ca, xa, ta = _load(body_a)
    ib, cb, xb, tb = (ia, ca, xa, ta) if body_b is None else _load(body_b)
    i, j = dual_pairs(ta, tb, np.sqrt(2 - 2 * least))
    hit = np.concatenate([cosine(xa[i[k:k + 100_000]], xb[j[k:k + 100_000]]) >= least
                          for k in range(0, len(i), 100_000)]) if len(i) else np.zeros(0, bool)
    i, j = i[hit], j[hit]
    if body_b is None:
        links = np.bincount(i, ca[j], len(ia)) + np.bincount(j, ca[i], len(ia))
        low, ids = _smallest_connected(len(ia), i, j, ia), ia
    else:
        links = np.r_[np.bincount(i, cb[j], len(ia)), np.bincount(j, ca[i], len(ib))]
        ids = np.r_[ia, ib]
        low = _smallest_connected(len(ids), i, j + len(ia), ids)
    some = links > 0
    return pd.DataFrame({"id": ids[some], "links": links[some].astype(np.int64), "low": low[some]})


def links(vectors: DataFrame, least: float = 0.93, key: str = "vec_id", embedding: str = "embedding",
          label: str = "label", block: int = 1024, pivots: int = 8) -> DataFrame:
    """Per row of ``vectors``: key, n_links, component_id, kept."""
    spark = vectors.sparkSession
    v = F.col("v")
    usable = (v.isNotNull() & F.col("label").isNotNull() & F.col("id").isNotNull() & F.coalesce(
        F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(v, lambda x: x != 0), F.lit(False)))
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(embedding).alias("v"), F.col(label).alias("label"))
    good = rows.where(usable)
    # a point is a vector of a label, numbered when it is written; a vec_id may stand on several
    points = written(good.groupBy("label", "v").agg(F.min("id").alias("vec"), F.count("*").alias("copies"))
                     .withColumn("dim", F.size("v")).withColumn("id", F.monotonically_increasing_id()), "points")
    chosen = [np.array(r["v"], float) for r in
              points.orderBy(F.xxhash64("vec", "v"), "vec").limit(pivots).select("v").collect()]
    by_dim = {d: np.stack([unit(c[None])[0] for c in chosen if len(c) == d]) for d in {len(c) for c in chosen}}

    def nearest(batches):
        for pdf in batches:
            cell = np.full(len(pdf), -1, np.int32)
            for d, rows_of in pdf.groupby("dim").indices.items():
                if d in by_dim:
                    x = unit(np.array(pdf["v"].iloc[rows_of].tolist(), np.float64))
                    cell[rows_of] = (x @ by_dim[d].T).argmax(1)
            yield pdf.assign(cell=cell)

    placed = points.mapInPandas(nearest, T.StructType(points.schema.fields + [T.StructField("cell", T.IntegerType())]))
    placed = written(placed, "placed-points")
    where = ["label", "dim", "cell"]
    sizes = placed.groupBy(*where).agg(F.ceil(F.count("*") / block).alias("chunks"))
    dealt = placed.join(sizes, where).withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")))
    kind = points.schema["label"].dataType.simpleString()
    blocks = written(dealt.groupBy(*where, "chunk").applyInPandas(
        _block_tree("v"), f"label {kind}, dim int, block long, middle array<double>, radius double, body binary"), "blocks")

    eps = float(np.sqrt(2 - 2 * least))
    meta = blocks.select("label", "dim", "block", "middle", "radius")
    other = meta.toDF("label", "dim", "block2", "middle2", "radius2")
    apart = F.sqrt(F.aggregate(F.zip_with("middle", "middle2", lambda p, q: (p - q) * (p - q)),
                               F.lit(0.0), lambda s, x: s + x))
    pairs = meta.join(other, ["label", "dim"]).where(
        (F.col("block") <= F.col("block2")) & (apart <= F.col("radius") + F.col("radius2") + eps + SLACK))
    pairs = written(pairs.select("block", "block2"), "block-pairs")
    body = blocks.select("block", "body")
    work = (pairs.join(body, "block").join(body.toDF("block2", "body2"), "block2")
            .select("block", "block2", "body", "body2"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = [compare(r.body, None if r.block == r.block2 else r.body2, least) for r in pdf.itertuples()]
        return pd.concat(out)

    found = written(work.groupBy("block", "block2").applyInPandas(run, "id long, links long, low long"), "links")
    comp = components(found.select(F.col("id").alias("a"), F.col("low").alias("b")))
    total = found.groupBy("id").agg(F.sum("links").alias("links"))
    placed = points.join(comp.withColumnRenamed("node", "id"), "id", "left")
    names = placed.where("component is not null").groupBy("component").agg(F.min("vec").alias("name"))
    per_point = (placed.join(total, "id", "left").join(names, "component", "left")
                 .select("label", "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                         F.coalesce("name", "vec").alias("component_id")))
    linked = good.join(per_point, ["label", "v"]).select("id", "n_links", "component_id")
    alone = rows.where(~F.coalesce(usable, F.lit(False))).select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(key), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


@query("op8_cover_tree")
def op8_cover_tree(spark, sf_dir):
    return links(table(spark, sf_dir, "embeddings"))
