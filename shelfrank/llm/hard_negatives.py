"""Hard-negative mining by a vertical scan of column blocks (BOND).

Rows are packed into blocks that hold one array per dimension, with each dimension's least and greatest
value. An anchor reads a block's dimensions in the order of its own components' descending magnitude.
After every few of them a row's score lies between its partial sum plus the least and plus the greatest
that the unread dimensions can add; rows whose interval cannot matter any more leave the candidate
bitmap, until the scores of the rest are exact. The same scan serves both steps:

* positives: rows of the anchor's label; out goes whose greatest possible score is under the k-th best
  one known (of the least possible scores in the block, or of exact ones of earlier blocks);
* negatives: rows of other labels; every positive opens a window [low % of its score, high % of it], out
  goes whose interval misses every window or lies under a window's k-th best certain row.

Anchors are a stated query set: all anchors meet all rows, in tiles of a few row blocks and a few groups of
anchors, each one task's work of bounded memory; a tile returns at most k rows per anchor and window.

Defined cases: a row with a null id, a null label, a null vector, or a null or non-finite component takes
no part; vectors of different length do not meet; rows that repeat id, label and vector are one row, rows that
repeat only the id are rows of their own (and anchors of their own); an anchor is no partner of itself; ties go
to the smaller id; an empty table gives an empty result; other columns are not read. Components are whole
numbers floor(scale * x) and scores are exact 64-bit sums; a table whose scores could need more than 62 bits is refused.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from shelfrank.llm.common import table, written
from shelfrank.llm.registry import query

BLOCK_ROWS, BLOCK_BYTES = 4096, 1 << 21      # rows of a block, at most; bytes of its components
GROUP_ROWS = 512                             # anchors packed together
TILE_BLOCKS, TILE_GROUPS = 16, 16            # blocks and groups that one task holds at most
FIRST, STEP = 4, 8                           # dimensions read before the first and between later prunings


class Block:
    """Rows by column: ids, labels, columns[d] and the range of every column."""

    def __init__(self, row):
        self.ids = np.frombuffer(row.ids, np.int64)
        self.labels = np.frombuffer(row.labels, np.int64)
        self.columns = np.frombuffer(row.columns, np.int64).reshape(row.dim, len(self.ids))
        self._of_label: dict = {}
        self.all = self._ranges(np.arange(len(self.ids)))

    def _ranges(self, rows: np.ndarray):
        c = self.columns[:, rows]
        return (rows, c.min(1), c.max(1)) if len(rows) else (rows, None, None)

    def of_label(self, label: int):
        """(rows of the label, least, greatest value of every column among them)."""
        if label not in self._of_label:
            self._of_label[label] = self._ranges(np.flatnonzero(self.labels == label))
        return self._of_label[label]


def scan(block: Block, rows: np.ndarray, least: np.ndarray, greatest: np.ndarray, q: np.ndarray, keep):
    """(rows, exact scores) of the candidates that ``keep(lowest, highest possible score)`` leaves."""
    order = np.argsort(-np.abs(q), kind="stable")
    a, b = q * least, q * greatest
    down = np.append(np.cumsum(np.minimum(a, b)[order][::-1])[::-1], 0)     # of the dimensions from a place on
    up = np.append(np.cumsum(np.maximum(a, b)[order][::-1])[::-1], 0)
    bitmap = np.zeros(len(block.ids), bool)
    bitmap[rows] = True
    part = np.zeros(len(block.ids), np.int64)
    at, step = 0, FIRST
    while len(rows):
        dims = order[at:at + step]
        at, step = at + len(dims), STEP
        if len(dims):
            part[rows] += q[dims] @ block.columns[np.ix_(dims, rows)]
        alive = keep(part[rows] + down[at], part[rows] + up[at])
        bitmap[rows[~alive]] = False
        rows = np.flatnonzero(bitmap)
        if at >= len(q):
            break
    return rows, part[rows]


def _kth(values: np.ndarray, k: int):
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else None


def _merged(best, ids: np.ndarray, scores: np.ndarray, k: int):
    """The k best of (ids, scores) and ``best`` by descending score, then id."""
    ids, scores = np.append(best[0], ids), np.append(best[1], scores)
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


NONE = (np.zeros(0, np.int64), np.zeros(0, np.int64))


def best_of_label(blocks: list[Block], anchor: int, label: int, q: np.ndarray, k: int):
    """(ids, scores) of the k best rows of the label other than the anchor."""
    best = NONE
    for block in blocks:
        rows, least, greatest = block.of_label(label)
        same = rows[block.ids[rows] == anchor]
        if len(same):
            own = same[(block.columns[:, same] == q[:, None]).all(0)]
            rows = np.setdiff1d(rows, own, assume_unique=True)

        def keep(lo, hi, known=best):
            bars = [x for x in (_kth(lo, k), _kth(known[1], k)) if x is not None]
            return hi >= max(bars) if bars else np.ones(len(lo), bool)

        rows, scores = scan(block, rows, least, greatest, q, keep)
        best = _merged(best, block.ids[rows], scores, k)
    return best


def best_in_windows(blocks: list[Block], label: int, q: np.ndarray, windows: list[tuple[int, int]], k: int):
    """Per window (lowest, highest score): (ids, scores) of the k best rows of other labels inside."""
    best = [NONE] * len(windows)
    if not windows:
        return best
    for block in blocks:
        rows, least, greatest = block.all
        rows = rows[block.labels != label]

        def keep(lo, hi, known=tuple(best)):
            out = np.zeros(len(lo), bool)
            for (low, high), found in zip(windows, known, strict=True):
                bars = [x for x in (_kth(lo[(lo >= low) & (hi <= high)], k), _kth(found[1], k)) if x is not None]
                out |= (lo <= high) & (hi >= max([low, *bars]))
            return out

        rows, scores = scan(block, rows, least, greatest, q, keep)
        for w, (low, high) in enumerate(windows):
            inside = (scores >= low) & (scores <= high)
            best[w] = _merged(best[w], block.ids[rows[inside]], scores[inside], k)
    return best


def whole_numbers(vectors: DataFrame, id: str, label: Column, vector: str, scale: int) -> DataFrame:
    """(id, label, v array<long>, dim) of the rows that take part, each once."""
    x = F.col(vector).cast("array<double>")
    return (vectors.select(F.col(id).cast("long").alias("id"), label.cast("long").alias("label"), x.alias("x"))
            .where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull())
            .where(F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
            .select("id", "label", F.transform("x", lambda c: F.floor(c * scale).cast("long")).alias("v"))
            .distinct().withColumn("dim", F.size("v")).withColumn("own", F.xxhash64("label", "v")))


def _pack_rows(pdf: pd.DataFrame) -> pd.DataFrame:
    columns = np.stack([np.asarray(v, np.int64) for v in pdf["v"]], axis=1) if pdf["dim"].iloc[0] else np.zeros((0, len(pdf)), np.int64)
    return pd.DataFrame({"p": pdf["p"].iloc[:1].to_numpy(), "dim": pdf["dim"].iloc[:1].to_numpy(),
                         "ids": [pdf["id"].to_numpy(np.int64).tobytes()], "labels": [pdf["label"].to_numpy(np.int64).tobytes()],
                         "columns": [columns.tobytes()]})


def _pack_anchors(pdf: pd.DataFrame) -> pd.DataFrame:
    out = {c: [pdf[c].to_numpy(np.int64).tobytes()] for c in ("id", "label", "own")}
    matrix = np.concatenate([np.asarray(v, np.int64) for v in pdf["v"]])
    scores = np.full((len(pdf), max(1, max(len(s) for s in pdf["scores"]))), -1, np.int64)
    for i, s in enumerate(pdf["scores"]):
        scores[i, :len(s)] = s
    return pd.DataFrame({"g": pdf["g"].iloc[:1].to_numpy(), "dim": pdf["dim"].iloc[:1].to_numpy(), **out,
                         "vectors": [matrix.tobytes()], "scores": [scores.tobytes()]})


class Tiles:
    """The rows in blocks by column, met by any anchors."""

    def __init__(self, points: DataFrame):
        self.spark = points.sparkSession
        n, dim, top = points.agg(F.count("*"), F.max("dim"), F.max(F.array_max(F.transform("v", lambda c: F.abs(c.cast("double")))))).first()
        if top is not None and dim * top ** 2 >= 2.0 ** 62:
            raise ValueError("components too large: scores would not fit into 62 bits")
        per_block = max(64, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(1, dim or 1))))
        n_blocks = -(-max(1, n) // per_block)
        # tiles of up to TILE_BLOCKS blocks, of fewer if that would leave cores idle
        self.parts = max(-(-n_blocks // TILE_BLOCKS), min(n_blocks, self.spark.sparkContext.defaultParallelism))
        place = F.pmod(F.xxhash64("id", "own"), F.lit(n_blocks))
        dealt = points.withColumn("b", place).withColumn("p", (F.col("b") % self.parts).cast("int"))
        self.blocks = written(dealt.groupBy("dim", "b").applyInPandas(
            _pack_rows, "p int, dim int, ids binary, labels binary, columns binary"), "row-blocks")

    def meet(self, anchors: DataFrame, find, name: str) -> DataFrame:
        """Rows (id, own, w, other, score): what ``find(blocks, id, label, vector, scores)`` returns per
        window w for an anchor of ``anchors`` (id, label, own, v, dim, scores) in one tile."""
        groups = -(-max(1, anchors.count()) // GROUP_ROWS)
        packed = written(anchors.withColumn("g", F.pmod(F.xxhash64("id", "own"), F.lit(groups)).cast("int"))
                         .groupBy("dim", "g").applyInPandas(
                             _pack_anchors, "g int, dim int, id binary, label binary, own binary, vectors binary, scores binary"), name)
        many = -(-groups // TILE_GROUPS)
        left = self.blocks.withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(many - 1))))
        right = packed.withColumn("t", (F.col("g") % many).cast("int")).withColumn(
            "p", F.explode(F.sequence(F.lit(0), F.lit(self.parts - 1))))

        def run(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
            blocks = [Block(r) for r in rows.itertuples()] if len(asked) else []
            out = [(NONE[0],) * 5]
            for r in asked.itertuples() if blocks else ():
                ids, labels, own = (np.frombuffer(x, np.int64) for x in (r.id, r.label, r.own))
                vectors = np.frombuffer(r.vectors, np.int64).reshape(len(ids), r.dim)
                scores = np.frombuffer(r.scores, np.int64).reshape(len(ids), -1)
                for i, anchor in enumerate(ids):
                    for w, (others, found) in find(blocks, int(anchor), int(labels[i]), vectors[i], scores[i]):
                        out.append((np.full(len(others), anchor), np.full(len(others), own[i]), np.full(len(others), w), others, found))
            return pd.DataFrame(dict(zip(("id", "own", "w", "other", "score"), map(np.concatenate, zip(*out, strict=True)), strict=True)))

        return left.groupBy("p", "t", "dim").cogroup(right.groupBy("p", "t", "dim")).applyInPandas(
            run, "id long, own long, w long, other long, score long")


def hard_negatives(vectors: DataFrame, id: str, label: Column, vector: str, anchor: Column, scale: int = 256,
                   positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for every row for which
    ``anchor`` (over the columns id, label, v) holds and each of its ``positives`` best rows of the same
    label, the ``negatives`` best rows of other labels that score from ``low`` to ``high`` percent of the
    positive."""
    points = written(whole_numbers(vectors, id, label, vector, scale), "whole-numbers")
    tiles = Tiles(points)
    chosen = points.where(anchor)
    best = lambda df, k, keys: df.withColumn("r", F.row_number().over(
        Window.partitionBy(*keys).orderBy(F.col("score").desc(), "other"))).where(F.col("r") <= k)

    def same(blocks, a, lab, q, _):
        return [(0, best_of_label(blocks, a, lab, q, positives))]

    found = tiles.meet(chosen.withColumn("scores", F.array().cast("array<long>")), same, "anchors")
    pos = written(best(found, positives, ["id", "own"]).select("id", "own", (F.col("r") - 1).cast("long").alias("w"), F.col("other").alias("positive_id"),
                                                               F.col("score").alias("positive_score")), "positives")

    def windows(blocks, _, lab, q, scores):
        spans = {int(s): (-(-low * int(s) // 100), high * int(s) // 100) for s in scores if s >= 0}
        per = dict(zip(spans, best_in_windows(blocks, lab, q, list(spans.values()), negatives), strict=True))
        return [(w, per[int(s)]) for w, s in enumerate(scores) if s >= 0]

    # a negative score leaves an empty window: low % of it lies above high %
    scores = pos.groupBy("id", "own").agg(F.array_sort(F.collect_list(F.struct("w", "positive_score"))).alias("s")).select(
        "id", "own", F.transform("s", lambda x: F.greatest(x["positive_score"], F.lit(-1).cast("long"))).alias("scores"))
    found = tiles.meet(chosen.join(scores, ["id", "own"]), windows, "anchor-windows")
    return best(found, negatives, ["id", "own", "w"]).join(pos, ["id", "own", "w"]).select(
        F.col("id").alias("anchor_id"), "positive_id", F.col("r").cast("int").alias("rank"), F.col("other").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


ORACLE = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, e.vec_id, a.label = e.label AS same, CAST(list_dot_product(a.v, e.v) AS BIGINT) AS score
      FROM e a JOIN e ON a.vec_id <> e.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
        SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM s WHERE same) WHERE r <= 5),
n AS (SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
        AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


@query("op13_hard_negatives", ORACLE)
def op13_hard_negatives(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors, "vec_id", label, "embedding", F.col("id") % 100 == 0)
