"""Blocked exact top-k scorer for dense users x items scores.

The product is never materialised as rows, and one algorithm serves every size: queries and targets
are packed into blocks (one row each: ids and a matrix), every (query block, target block) is one
task's matrix product, and of it each query keeps only its best rows. A pair's task holds two
blocks and the excluded pairs between them, dealt to the grid of pairs by one cogroup; nothing is
broadcast and nothing goes through the driver but a few counts.

A table is cut into ``CUTS`` blocks as long as these stay below ``QUERY_ROWS`` / ``TARGET_ROWS`` rows, so
up to there each row is copied ``CUTS`` times whatever the tables' sizes; single-precision vectors travel
as such and are scored in double precision.

Where a score is g(query, x) * weight with g > 0 rising in one number x of the target, ``pruned`` drops
the targets that k others precede for every query, before any block is dealt: most of them, as a rule.

``softmax_topk`` (F3) adds each block's (maximum, sum of exponentials) per query; they merge into the
softmax denominator over all targets, so probabilities hold before any target is filtered.

Each query emits at most ``k`` candidates per target block: excluded targets are struck out inside the
block. The final top k is a windowed ``row_number`` with a partial limit before the shuffle.  Ties are
broken by the target id, also inside numpy (all rows tied with the cut-off score are kept before sorting).
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.functions.ranks import top_k
from shelfrank.session import stored

QUERY_ROWS, TARGET_ROWS = 32_768, 32_768   # rows of a block, at most
LEAST_ROWS, CUTS = 1_024, 8                # a smaller table makes CUTS blocks of at least LEAST_ROWS rows
PRUNE_ROWS = 65_536                        # targets of which one task drops the dominated ones
PAIRS_AT_ONCE = 4_000_000                  # (query, item) pairs that kind_topk scores together


def _select_top(S: np.ndarray, tids: np.ndarray, m: np.ndarray):
    """Per row, the m[row] best columns by (score desc, id asc); ties at the cut kept exact.

    Vectorised over the batch: one partition pass gives each row's cut-off
    score, every column at or above it is a candidate, and one lexsort orders
    all candidates by (row, score desc, id asc).
    """
    B, n = S.shape
    if B == 0 or n == 0:
        e = np.array([], dtype=np.int64)
        return e, e, np.array([], dtype=np.float64)
    S = np.where(np.isnan(S), -np.inf, S)
    mm = np.minimum(np.asarray(m, dtype=np.int64), n)
    top = int(mm.max())
    if top <= 0:
        e = np.array([], dtype=np.int64)
        return e, e, np.array([], dtype=np.float64)
    if top < n:
        part = np.partition(S, n - top, axis=1)[:, n - top:]
    else:
        part = S
    desc = -np.sort(-part, axis=1)
    thr = np.where(mm > 0, desc[np.arange(B), np.maximum(mm - 1, 0)], np.inf)
    # -inf marks "not a candidate" (below a similarity threshold, no price)
    r, c = np.nonzero((S >= thr[:, None]) & (S > -np.inf))
    v = S[r, c]
    order = np.lexsort((tids[c], -v, r))
    r, c, v = r[order], c[order], v[order]
    starts = np.searchsorted(r, np.arange(B))
    keep = (np.arange(len(r)) - starts[r]) < mm[r]
    return r[keep], c[keep], v[keep]


def _matches(ids: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``wanted``, place in the sorted ``ids``) of every match; ids may repeat."""
    low, high = np.searchsorted(ids, wanted), np.searchsorted(ids, wanted, side="right")
    n = high - low
    which = np.repeat(np.arange(len(wanted)), n)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + low[which]


class _Struck:
    """Places (row, column) of the excluded pairs of a block, by row."""

    def __init__(self, qids, tids, ex_q, ex_t):
        which, row = _matches(qids, ex_q)
        again, column = _matches(tids, ex_t[which])
        order = np.argsort(row[again], kind="stable")
        self.row, self.column = row[again][order], column[order]

    def out_of(self, S: np.ndarray, start: int) -> np.ndarray:
        """``S``, the scores of the rows from ``start`` on, with -inf at the excluded pairs."""
        a, b = np.searchsorted(self.row, [start, start + len(S)])
        if b > a:
            S[self.row[a:b] - start, self.column[a:b]] = -np.inf
        return S


def _score_batches(q_ids, Q, k, tids, T, extra, score_fn, batch_rows, struck):
    out = []
    for s in range(0, Q.shape[0], batch_rows):
        S = struck.out_of(score_fn(Q[s:s + batch_rows], T, extra), s)
        r, c, v = _select_top(S, tids, np.full(len(S), k))
        out.append(pd.DataFrame({"qid": q_ids[s:s + batch_rows][r], "tid": tids[c], "score": v}))
    return out


def _blocks(n_rows: int, most: int) -> int:
    return max(1, -(-n_rows // min(most, max(LEAST_ROWS, -(-n_rows // CUTS)))))


def _of(id_, blocks: int):
    return F.pmod(F.xxhash64(id_), F.lit(blocks)).cast("int")


def _vector(df: DataFrame, name: str):
    """The column as an array of floats if it is one, else of doubles, and its numpy type."""
    if df.schema[name].dataType == T.ArrayType(T.FloatType(), df.schema[name].dataType.containsNull):
        return F.col(name), np.float32
    return F.col(name).cast("array<double>"), np.float64


def _pack(rows: DataFrame, blocks: int, name: str, dtype, extra: str | None = None) -> DataFrame:
    """(name, ids, vecs[, extra]) with one row per block; ids are sorted."""
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        out = {name: pdf[name].iloc[:1].to_numpy(), f"{name}_ids": [pdf["id"].to_numpy(np.int64).tobytes()],
               f"{name}_vecs": [np.stack(pdf["vec"].to_numpy()).astype(dtype).tobytes()]}
        if extra:
            out[f"{name}_{extra}"] = [pdf[extra].to_numpy(np.float64).tobytes()]
        return pd.DataFrame(out)

    schema = f"{name} int, {name}_ids binary, {name}_vecs binary" + (f", {name}_{extra} binary" if extra else "")
    return rows.withColumn(name, _of("id", blocks)).groupBy(name).applyInPandas(pack, schema)


def _excluded(exclude: DataFrame, q_id: str, t_id: str) -> DataFrame:
    return exclude.select(F.col(q_id).cast("long").alias("qid"), F.col(t_id).cast("long").alias("tid")).dropna().distinct()


def _query_blocks(queries: DataFrame, q_id: str, q_vec: str, query_rows: int) -> tuple[DataFrame, int, type]:
    vec, dtype = _vector(queries, q_vec)
    n = _blocks(queries.count(), query_rows)
    return _pack(queries.select(F.col(q_id).cast("long").alias("id"), vec.alias("vec")), n, "qb", dtype), n, dtype


def _cogrid(qb: DataFrame, n_qb: int, tb: DataFrame, n_tb: int, ex: DataFrame | None, score_pair: Callable,
            schema: str) -> DataFrame:
    """``score_pair(query block, target block, excluded query ids, their target ids)`` of every pair of
    blocks. ``ex``: (qid, tid, tb), ``tb`` the block of the target."""
    left = qb.withColumn("tb", F.explode(F.sequence(F.lit(0), F.lit(n_tb - 1)))).select("qb", "tb", "qb_ids", "qb_vecs")
    if ex is not None:
        def lists(pdf: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"qb": pdf["qb"].iloc[:1].to_numpy(), "tb": pdf["tb"].iloc[:1].to_numpy(),
                                 "ex_q": [pdf["qid"].to_numpy(np.int64).tobytes()], "ex_t": [pdf["tid"].to_numpy(np.int64).tobytes()]})

        packed = ex.withColumn("qb", _of("qid", n_qb)).groupBy("qb", "tb").applyInPandas(
            lists, "qb int, tb int, ex_q binary, ex_t binary")
        left = left.unionByName(packed, allowMissingColumns=True)
    else:
        left = left.withColumns({c: F.lit(None).cast("binary") for c in ("ex_q", "ex_t")})
    right = tb.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_qb - 1))))
    names = [c.split()[0] for c in schema.split(",")]

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        block, gone = a[a["qb_ids"].notna()], a[a["ex_q"].notna()]
        if not len(block) or not len(b):
            return pd.DataFrame({c: [] for c in names})
        ex_q, ex_t = (np.frombuffer(b"".join(gone[c]), np.int64) for c in ("ex_q", "ex_t"))
        return score_pair(block.iloc[0], b.iloc[0], ex_q, ex_t)

    return left.groupBy("qb", "tb").cogroup(right.groupBy("qb", "tb")).applyInPandas(run, schema)


def _grid(queries: DataFrame, q_id: str, q_vec: str, targets: DataFrame, t_id: str, t_vec: str,
          t_extra: str | None, exclude: DataFrame | None, query_rows: int, target_rows: int, score_block: Callable,
          schema: str) -> DataFrame:
    """``score_block(query ids, Q, target ids, T, extra, struck)`` of every pair of blocks."""
    qb, n_qb, q_type = _query_blocks(queries, q_id, q_vec, query_rows)
    vec, t_type = _vector(targets, t_vec)
    n_tb = _blocks(targets.count(), target_rows)
    tb = _pack(targets.select(F.col(t_id).cast("long").alias("id"), vec.alias("vec"),
                              (F.col(t_extra).cast("double") if t_extra else F.lit(0.0)).alias("x")), n_tb, "tb", t_type, "x")
    ex = None if exclude is None else _excluded(exclude, q_id, t_id).withColumn("tb", _of("tid", n_tb))

    def score_pair(a, b, ex_q, ex_t):
        qids, tids = np.frombuffer(a.qb_ids, np.int64), np.frombuffer(b.tb_ids, np.int64)
        return score_block(qids, np.frombuffer(a.qb_vecs, q_type).reshape(len(qids), -1).astype(float), tids,
                           np.frombuffer(b.tb_vecs, t_type).reshape(len(tids), -1).astype(float), np.frombuffer(b.tb_x),
                           _Struck(qids, tids, ex_q, ex_t))

    return _cogrid(qb, n_qb, tb, n_tb, ex, score_pair, schema)


def undominated(ids: np.ndarray, x: np.ndarray, weight: np.ndarray, k: int) -> np.ndarray:
    """Places of the targets that fewer than ``k`` others precede for every query, if scores are
    g(query, x) * weight with g > 0 rising in x. A target precedes another if its weight is larger, or
    equal and its id smaller, and g brings it no less: x at least as large, or, where both weights are
    negative, as small. Targets of weight >= 0 precede all of negative weight."""
    keep = []
    order = np.lexsort((ids, -weight))
    order = order[~(np.isnan(weight[order]) | np.isnan(x[order]))]
    split = int((weight[order] >= 0).sum())
    for part, sign, places in ((order[:split], 1.0, k), (order[split:], -1.0, k - split)):
        best: list[float] = []                     # the largest x so far, as many as there are places
        for i, v in zip(part.tolist(), (sign * x[part]).tolist(), strict=True):
            if len(best) < places:
                heapq.heappush(best, v)
            elif best and v > best[0]:
                heapq.heapreplace(best, v)
            else:
                continue
            keep.append(i)
    return np.array(sorted(keep), np.int64)


def pruned(targets: DataFrame, t_id: str, x: str, weight, k: int) -> DataFrame:
    """``targets`` (one row per target of its columns) without those that ``k`` others precede for every query
    (``undominated``): in blocks, and again in blocks of what is left until that is one block or hardly less."""
    schema = targets.schema
    rows = targets.withColumn("_x", F.col(x).cast("double")).withColumn("_w", weight)
    n = rows.count()
    while True:
        blocks = max(1, -(-n // PRUNE_ROWS))

        def best(pdf: pd.DataFrame) -> pd.DataFrame:
            return pdf.iloc[undominated(pdf[t_id].to_numpy(), pdf["_x"].to_numpy(float), pdf["_w"].to_numpy(float), k)].drop(columns="_b")

        rows = stored(rows.withColumn("_b", _of(t_id, blocks)).groupBy("_b").applyInPandas(best, rows.schema))
        left = rows.count()
        if blocks == 1 or left > 0.7 * n:
            return rows.select(*schema.names)
        n = left


def separable_topk(queries: DataFrame, q_id: str, a: str, targets: DataFrame, t_id: str, x: str, weight: str, k: int,
                   score_fn: Callable, factor, exclude: DataFrame | None = None, query_rows: int = QUERY_ROWS,
                   target_rows: int = TARGET_ROWS, first: int = 256) -> DataFrame:
    """``block_topk`` for scores g(a + x) * ``factor(weight)`` with g > 0 rising: queries and targets are
    numbers. Queries are taken together by k + their number of excluded targets (``first`` at most, then 16
    times as many, and so on), and each class only meets the targets that can be among so many."""
    q = queries.select(F.col(q_id).cast("long").alias(q_id), F.array(F.col(a).cast("double")).alias("_a"))
    t = targets.select(F.col(t_id).cast("long").alias(t_id), F.col(x).cast("double").alias(x), F.col(weight).cast("double").alias(weight))
    classes = [(first, q, None)]
    if exclude is not None:
        ex = _excluded(exclude, q_id, t_id)
        copies = t.groupBy(t_id).count().agg(F.max("count")).first()[0] or 1      # a repeated id is excluded as often
        n = stored(ex.groupBy(F.col("qid").alias(q_id)).agg((F.count("*") * int(copies) + k).alias("_n")))
        top, most, low = max(first, k), (n.agg(F.max("_n")).first()[0] or k), 0
        counted = q.join(n, q_id, "left").withColumn("_n", F.coalesce("_n", F.lit(k)))
        classes = []
        while low < max(most, k):
            classes.append((top, counted.where((F.col("_n") > low) & (F.col("_n") <= top)).drop("_n"), ex))
            low, top = top, 16 * top
    else:
        classes = [(k, q, None)]
    out = None
    for most, some, ex in classes:
        left = pruned(t, t_id, x, factor(F.col(weight)), most)
        if ex is not None:
            ex = ex.join(left.select(F.col(t_id).alias("tid")).distinct(), "tid", "left_semi").withColumnsRenamed({"qid": q_id, "tid": t_id})
        part = block_topk(some, q_id, "_a", left.withColumn("_t", F.array(x)), t_id, "_t", k, score_fn, weight, ex, query_rows, target_rows)
        out = part if out is None else out.unionByName(part)
    return out


def block_topk(queries: DataFrame, q_id: str, q_vec: str, targets: DataFrame, t_id: str, t_vec: str,
               k: int, score_fn: Callable, t_extra: str | None = None,
               exclude: DataFrame | None = None, query_rows: int = QUERY_ROWS, target_rows: int = TARGET_ROWS,
               batch_rows: int = 128) -> DataFrame:
    """Top k targets per query by ``score_fn(Qbatch, T, extra) -> scores``.

    ``exclude`` (q_id, t_id) pairs are removed exactly.  Returns
    (q_id, t_id, score, rank).
    """
    def best(qids, Q, tids, T, extra, struck):
        return pd.concat(_score_batches(qids, Q, k, tids, T, extra, score_fn, batch_rows, struck))

    cand = _grid(queries, q_id, q_vec, targets, t_id, t_vec, t_extra, exclude, query_rows, target_rows, best,
                 "qid long, tid long, score double")
    best = top_k(cand, k, ["qid"], [F.col("score").desc(), F.col("tid").asc()])
    return best.select(F.col("qid").alias(q_id), F.col("tid").alias(t_id), "score", "rank")


def _best_of_kinds(c, m, price, tids, first):
    """(query, item, score): per query its m best items by c[query, kind] * price, best first. Items stand sorted by
    kind, price descending and id; kind j begins at ``first[j]``. A kind with c <= 0 has no candidates.

    The m-th best of the kinds' dearest items bounds the answer from below, so of each kind only the
    items that reach this bound are scored."""
    n, kinds = c.shape
    ok = c > 0
    top = np.where(ok, c * price[first[:-1]][None, :], -np.inf)
    place = np.minimum(m, kinds) - 1
    bound = np.where(m <= kinds, -np.sort(-top, axis=1)[np.arange(n), place], -np.inf)
    count = np.zeros((n, kinds), np.int64)
    for j in range(kinds):
        rows = np.flatnonzero(ok[:, j])
        least = bound[rows] / c[rows, j]
        own = price[first[j]:first[j + 1]]
        count[rows, j] = np.searchsorted(-own, -(least - np.abs(least) * 1e-12), side="right")
    count = np.minimum(count, np.asarray(m)[:, None])          # no more than m of one kind
    ends = np.cumsum(count.sum(1))
    cuts = np.unique(np.searchsorted(ends, np.arange(PAIRS_AT_ONCE, int(ends[-1]) if n else 0, PAIRS_AT_ONCE)))
    parts = [_dearest(c[a:b], m[a:b], count[a:b], price, tids, first) for a, b in zip([0, *cuts], [*cuts, n], strict=True) if b > a]
    shift = [a for a, b in zip([0, *cuts], [*cuts, n], strict=True) if b > a]
    return (np.concatenate([np.zeros(0, np.int64), *[p[0] + a for p, a in zip(parts, shift, strict=True)]]),
            np.concatenate([np.zeros(0, np.int64), *[p[1] for p in parts]]), np.concatenate([np.zeros(0), *[p[2] for p in parts]]))


def _dearest(c, m, count, price, tids, first):
    """(query, item, score) of the m best items per query, of the ``count[query, kind]`` dearest of each kind."""
    n, kinds = c.shape
    pair = np.repeat(np.arange(n * kinds), count.ravel())
    item = np.arange(len(pair)) - np.repeat(np.cumsum(count.ravel()) - count.ravel(), count.ravel()) + first[pair % kinds]
    score = c.ravel()[pair] * price[item]
    order = np.lexsort((tids[item], -score, pair // kinds))
    r, item, score = (pair // kinds)[order], item[order], score[order]
    keep = np.arange(len(r)) - np.searchsorted(r, np.arange(n))[r] < m[r]
    return r[keep], item[keep], score[keep]


def _kind_blocks(targets: DataFrame, t_id: str, t_vec: str, weight: str, target_rows: int) -> tuple[DataFrame, int, DataFrame]:
    """Targets packed by kind: one row per block (tb) with the kinds' vectors, where each kind's items begin, and
    the items' ids and weights; the number of blocks; and (tid, tb). A kind's items stand together, dearest first;
    a kind of many items is dealt to several blocks."""
    t = targets.select(F.col(t_id).cast("long").alias("tid"), F.col(t_vec).alias("kind"), F.col(weight).cast("double").alias("w"))
    part = max(1, target_rows // 4)
    sizes = t.groupBy("kind").agg(F.count("*").alias("n"))
    n_tb = max(1, -(-targets.count() // target_rows))
    t = stored(t.join(sizes, "kind").withColumn("tb", F.pmod(F.xxhash64(
        "kind", F.pmod(F.xxhash64("tid"), F.ceil(F.col("n") / part))), F.lit(n_tb)).cast("int")).drop("n"))
    dearest = F.sort_array(F.collect_list(F.struct((-F.col("w")).alias("w"), "tid")))
    kinds = t.groupBy("tb", "kind").agg(dearest.alias("own")).select("tb", "kind", F.col("own.tid").alias("ids"), F.col("own.w").alias("w"))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        vecs = [np.asarray(v, float) for v in pdf["kind"]]
        columns = {"tb_sizes": np.array([len(v) for v in vecs], np.int64), "tb_vecs": np.concatenate(vecs),
                   "tb_first": np.concatenate([[0], np.cumsum([len(v) for v in pdf["ids"]])]).astype(np.int64),
                   "tb_ids": np.concatenate(pdf["ids"].to_numpy()).astype(np.int64),
                   "tb_w": -np.concatenate(pdf["w"].to_numpy()).astype(float)}
        return pd.DataFrame({"tb": pdf["tb"].iloc[:1].to_numpy(), **{c: [v.tobytes()] for c, v in columns.items()}})

    packed = kinds.groupBy("tb").applyInPandas(
        pack, "tb int, tb_sizes binary, tb_vecs binary, tb_first binary, tb_ids binary, tb_w binary")
    return packed, n_tb, t.select("tid", "tb").distinct()


def kind_topk(queries: DataFrame, q_id: str, q_vec: str, targets: DataFrame, t_id: str, t_vec: str, k: int, weight: str,
              kind_score: Callable, exclude: DataFrame | None = None, query_rows: int = 8_192,
              target_rows: int = 1 << 20, batch_rows: int = 128, width: int | None = None) -> DataFrame:
    """Top k targets per query by ``kind_score(Q, kinds)`` x ``weight``, for targets of which many share a vector
    (a kind). With ``width``, ``t_vec`` lists the places of the ones in a vector of that many numbers. A kind's
    items are in one block as far as they fit, its vector is scored once there, and only the items of each kind
    that can be among the best are looked at. Targets of non-positive kind score are no candidates."""
    qb, n_qb, q_type = _query_blocks(queries, q_id, q_vec, query_rows)
    tb, n_tb, block_of = _kind_blocks(targets, t_id, t_vec, weight, target_rows)
    ex = None if exclude is None else _excluded(exclude, q_id, t_id).join(block_of, "tid")

    def best(a, b, ex_q, ex_t):
        qids, ids, price = np.frombuffer(a.qb_ids, np.int64), np.frombuffer(b.tb_ids, np.int64), np.frombuffer(b.tb_w)
        Q = np.frombuffer(a.qb_vecs, q_type).reshape(len(qids), -1)
        first, sizes, kinds = np.frombuffer(b.tb_first, np.int64), np.frombuffer(b.tb_sizes, np.int64), np.frombuffer(b.tb_vecs)
        if width is None:
            kinds = kinds.reshape(len(sizes), -1)
        else:
            ones, kinds = kinds.astype(np.int64), np.zeros((len(sizes), width))
            kinds[np.repeat(np.arange(len(sizes)), sizes), ones] = 1.0
        order = np.argsort(ids, kind="stable")
        struck = _Struck(qids, ids[order], ex_q, ex_t)
        m = k + np.bincount(struck.row, minlength=len(qids))
        gone = np.unique(struck.row * len(ids) + order[struck.column])
        out = []
        for s in range(0, len(qids), batch_rows):
            r, item, score = _best_of_kinds(kind_score(Q[s:s + batch_rows].astype(float), kinds), m[s:s + batch_rows], price, ids, first)
            left = ~np.isin((r + s) * len(ids) + item, gone)
            r, item, score = r[left], item[left], score[left]
            left = np.arange(len(r)) - np.searchsorted(r, r) < k
            out.append(pd.DataFrame({"qid": qids[s + r[left]], "tid": ids[item[left]], "score": score[left]}))
        return pd.concat(out)

    cand = _cogrid(qb, n_qb, tb, n_tb, ex, best, "qid long, tid long, score double")
    best_ = top_k(cand, k, ["qid"], [F.col("score").desc(), F.col("tid").asc()])
    return best_.select(F.col("qid").alias(q_id), F.col("tid").alias(t_id), "score", "rank")


def softmax_topk(queries: DataFrame, q_id: str, q_vec: str, targets: DataFrame, t_id: str, t_vec: str, k: int,
                 weight: str, exclude: DataFrame | None = None, query_rows: int = QUERY_ROWS,
                 target_rows: int = TARGET_ROWS, batch_rows: int = 128) -> DataFrame:
    """top k by softmax(u . v over all targets) x ``weight``: (q_id, t_id, prob, score, rank).

    ``exclude`` pairs are removed afterwards: they keep their share of the probability.
    """
    def best(qids, Q, tids, T, weights, struck):
        out = []
        for a in range(0, len(qids), batch_rows):
            s = Q[a:a + batch_rows] @ T.T
            top = s.max(1)
            e = np.exp(s - top[:, None])
            z = e.sum(1)
            r, c, _ = _select_top(struck.out_of(e * weights[None, :], a), tids, np.full(len(s), k))   # one query's scores share the denominator
            ids = qids[a:a + batch_rows]
            out.append(pd.DataFrame({"qid": ids[r], "tid": tids[c], "logit": s[r, c], "weight": weights[c]}))
            out.append(pd.DataFrame({"qid": ids, "tid": pd.NA, "logit": top, "weight": z}))
        return pd.concat(out)

    found = _grid(queries, q_id, q_vec, targets, t_id, t_vec, weight, exclude, query_rows, target_rows, best,
                  "qid long, tid long, logit double, weight double")
    found = stored(found)
    parts = found.where("tid is null").select("qid", F.col("logit").alias("m"), F.col("weight").alias("z"))
    whole = parts.join(parts.groupBy("qid").agg(F.max("m").alias("top")), "qid").groupBy("qid", "top").agg(
        F.sum(F.col("z") * F.exp(F.col("m") - F.col("top"))).alias("total"))
    cand = found.where("tid is not null")
    prob = F.exp(F.col("logit") - F.col("top")) / F.col("total")
    scored = cand.join(whole, "qid").select("qid", "tid", prob.alias("prob"), (prob * F.col("weight")).alias("score"))
    best = top_k(scored, k, ["qid"], [F.col("score").desc(), F.col("tid").asc()])
    return best.select(F.col("qid").alias(q_id), F.col("tid").alias(t_id), "prob", "score", "rank")


# ------------------------------------------------------------------ score functions
def sigmoid_dot_price(Q, T, extra):
    """sigmoid(u . v) * price."""
    return (1.0 / (1.0 + np.exp(-(Q @ T.T)))) * extra[None, :]


def neg_sq_l2(Q, T, extra, chunk: int = 32):
    """Nearest neighbours: larger is closer (exact differences, ``chunk`` targets at a time)."""
    out = np.empty((Q.shape[0], T.shape[0]))
    for i in range(0, T.shape[0], chunk):
        d = Q[:, None, :] - T[None, i:i + chunk, :]
        out[:, i:i + chunk] = -np.einsum("ijk,ijk->ij", d, d)
    return out
