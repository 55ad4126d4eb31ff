"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics are computed in the tasks, per whole text. Training takes a bounded sample of
labelled rows (``max_rows`` rows, the ones with the lowest key hashes), bins every feature into at
most 64 quantile bins and grows depth-limited trees level by level on gradient histograms. The
model is a handful of flat arrays (feature, threshold, left child, leaf value per node and tree);
scoring steps all rows of a batch down all trees at once.

Defined cases: a null or empty text has all-zero statistics and gets a score like any other; long
texts are read whole; a document with several labels counts as 1 if their mean is over 0.5; null
labels are ignored; without any usable label every score is the prior 0.5; repeated rows get
repeated results; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.llm.common import table, text_slices
from shelfrank.llm.registry import query

FEATURES = ["log_bytes", "log_words", "mean_word", "upper", "digit", "punct", "space", "wide", "line_len",
            "short_line", "distinct_words", "distinct_lines", "top_word", "bang", "pipe", "symbol", "long_word",
            "title_words", "stop_dot", "word_entropy"]

# class of every byte: 0 other, 1 lower, 2 upper, 3 digit, 4 white space, 5 sentence marks, 6 symbols, 7 beyond ASCII
_CLASS = np.zeros(256, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 1, 2, 3
_CLASS[[9, 10, 11, 12, 13, 32]] = 4
_CLASS[[ord(c) for c in ".,;:'\"?!()-"]] = 5
_CLASS[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = 6
_CLASS[128:] = 7


def statistics(text: str | None) -> np.ndarray:
    """The features of one whole text."""
    out = np.zeros(len(FEATURES))
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return out
    b = np.frombuffer(raw, np.uint8)
    counts = np.bincount(b, minlength=256)
    kind = np.bincount(_CLASS, weights=counts, minlength=8)
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    n, nb, nl = max(1, len(words)), len(raw), max(1, len(lines))
    freq: dict[bytes, int] = {}
    for w in words:
        freq[w] = freq.get(w, 0) + 1
    f = np.fromiter(freq.values(), float, len(freq)) / n
    lengths = np.fromiter(map(len, words), float, len(words)) if words else np.zeros(1)
    out[:] = (np.log1p(nb), np.log1p(len(words)), lengths.mean(), kind[2] / nb, kind[3] / nb, kind[5] / nb,
              kind[4] / nb, kind[7] / nb, np.log1p(nb / nl), sum(len(x) < 30 for x in lines) / nl,
              len(freq) / n, len(set(lines)) / nl, f.max(initial=0.0), counts[33] / n, counts[124] / n,
              kind[6] / nb, (lengths > 20).mean(), sum(w[:1].isupper() for w in words) / n,
              counts[46] / n, -(f * np.log(f)).sum() / np.log(n + 1))
    return out


def with_statistics(docs: DataFrame, text: str = "text", name: str = "features") -> DataFrame:
    """``docs`` without its text, with the array column ``name`` (a column of that name is replaced)."""
    keep = [c for c in docs.columns if c not in (text, name)]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(name, T.ArrayType(T.DoubleType()))])

    def run(batches):
        for batch in batches:
            for at, texts in text_slices(batch, text):
                feats = [statistics(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(at, len(texts)) for c in keep] + [pa.array(feats, pa.list_(pa.float64()))],
                    names=keep + [name])

    return docs.select(*keep, text).mapInArrow(run, schema)


class BoostedTrees:
    """Histogram gradient boosting for a 0/1 label, logistic loss."""

    def __init__(self, rounds: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64,
                 l2: float = 2.0, least: int | None = None):
        self.rounds, self.depth, self.rate, self.bins, self.l2, self.least = rounds, depth, rate, bins, l2, least
        self.base = 0.0
        nodes = (1 << (depth + 1)) - 1
        self.feature = np.zeros((0, nodes), np.int32)
        self.threshold = np.zeros((0, nodes))
        self.value = np.zeros((0, nodes))
        self.leaf = np.ones((0, nodes), bool)

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        if not len(y) or y.min() == y.max():
            self.base = 0.0 if not len(y) else float(np.clip(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)), -8, 8))
            return self
        n, d = x.shape
        least = self.least or min(20, max(2, n // 50))      # rows on either side of a split
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(d)]
        binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
        self.base = float(np.log(y.mean() / (1 - y.mean())))
        raw = np.full(n, self.base)
        nodes = (1 << (self.depth + 1)) - 1
        trees = []
        width = self.bins + 1
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-raw))
            g, h = p - y, p * (1 - p)
            feature, threshold = np.zeros(nodes, np.int32), np.zeros(nodes)
            value, leaf = np.zeros(nodes), np.ones(nodes, bool)
            at = np.zeros(n, np.int64)
            for level in range(self.depth + 1):
                first, size = (1 << level) - 1, 1 << level
                rows = np.flatnonzero(at >= first)
                local = at[rows] - first
                gs, hs = np.bincount(local, g[rows], size), np.bincount(local, h[rows], size)
                value[first:first + size] = -self.rate * gs / (hs + self.l2)
                if level == self.depth or not len(rows):
                    break
                best, best_f, best_b = np.full(size, 1e-6), np.zeros(size, int), np.full(size, -1)
                for j in range(d):
                    key = local * width + binned[rows, j]
                    gl = np.bincount(key, g[rows], size * width).reshape(size, width).cumsum(1)
                    hl = np.bincount(key, h[rows], size * width).reshape(size, width).cumsum(1)
                    cl = np.bincount(key, minlength=size * width).reshape(size, width).cumsum(1)
                    gr, hr, cr = gl[:, -1:] - gl, hl[:, -1:] - hl, cl[:, -1:] - cl
                    gain = (gl ** 2 / (hl + self.l2) + gr ** 2 / (hr + self.l2)
                            - gl[:, -1:] ** 2 / (hl[:, -1:] + self.l2))
                    gain[(cl < least) | (cr < least)] = -1
                    gain[:, len(cuts[j]):] = -1
                    b = gain.argmax(1)
                    top = gain[np.arange(size), b]
                    won = top > best
                    best[won], best_f[won], best_b[won] = top[won], j, b[won]
                split = np.flatnonzero(best_b >= 0)
                for s in split:
                    feature[first + s], threshold[first + s] = best_f[s], cuts[best_f[s]][best_b[s]]
                    leaf[first + s] = False
                moves = rows[best_b[local] >= 0]
                node = at[moves]
                at[moves] = 2 * node + 1 + (x[moves, feature[node]] > threshold[node])
            raw += value[at]
            trees.append((feature, threshold, value, leaf))
        self.feature, self.threshold, self.value, self.leaf = (np.stack(a) for a in zip(*trees, strict=True))
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1; all rows walk down all trees together, one level a step."""
        raw = np.full(len(x), self.base)
        if len(self.feature) and len(x):
            tree = np.arange(len(self.feature))[None, :]
            at = np.zeros((len(x), len(self.feature)), np.int64)
            row = np.arange(len(x))[:, None]
            for _ in range(self.depth):
                f = self.feature[tree, at]
                down = 2 * at + 1 + (x[row, f] > self.threshold[tree, at])
                at = np.where(self.leaf[tree, at], at, down)
            raw += self.value[tree, at].sum(1)
        return 1 / (1 + np.exp(-np.clip(raw, -40, 40)))


def labelled(labels: DataFrame, label: str, max_rows: int, key: str = "doc_id"):
    """At most ``max_rows`` labelled keys outside the held-out fifth, lowest key hashes first."""
    return (labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()
                         & (F.crc32(F.col(key).cast("string")) % 5 != 0))
            .groupBy(key).agg((F.avg(label) > 0.5).cast("int").alias("_y"))
            .orderBy(F.xxhash64(key), key).limit(max_rows))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = 20_000,
          text: str = "text", key: str = "doc_id", **params) -> BoostedTrees:
    """Fit on at most ``max_rows`` labelled documents (a documented bound: that many rows of
    statistics come to the driver, about 3 MB)."""
    sample = labelled(labels, label, max_rows, key)
    rows = with_statistics(docs.select(key, text).join(F.broadcast(sample), key), text).drop(key)
    # the bound does not depend on the label: rows with the lowest hashes stay
    got = rows.groupBy("_y", "features").agg(F.count("*").alias("n")).orderBy(
        F.xxhash64("features"), "features", "_y").limit(max_rows).collect()
    got.sort(key=lambda r: (r["_y"], r["features"]))
    x = np.array([r["features"] for r in got], float).reshape(len(got), len(FEATURES))
    y = np.array([r["_y"] for r in got], float)
    return BoostedTrees(**params).fit(x, y)


def score(docs: DataFrame, model: BoostedTrees, text: str = "text", name: str = "score",
          keep_text: bool = False) -> DataFrame:
    """``docs`` (with its text only if ``keep_text``) with the column ``name`` (a column of that name
    is replaced)."""
    keep = [c for c in docs.columns if c != name and (keep_text or c != text)]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(name, T.DoubleType())])

    def run(batches):
        for batch in batches:
            for at, texts in text_slices(batch, text):
                s = model.score(np.stack([statistics(t) for t in texts]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(at, len(texts)) for c in keep] + [pa.array(s)], names=keep + [name])

    return docs.select(*keep, *([] if keep_text else [text])).mapInArrow(run, schema)


ACCEPT = 0.3   # a score from here on counts as label 1


@query("op10_quality_trees")
def op10_quality_trees(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return score(docs, model).select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score",
                                     (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
