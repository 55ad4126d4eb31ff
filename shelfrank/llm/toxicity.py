"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A text is read in overlapping windows of ``WINDOW`` words, one every ``STRIDE`` words, to its end. A
word enters as its word vector (a hash bucket of the word without case and outer punctuation) beside
the mean vector of its character n-grams (hash buckets of ``GRAMS`` bytes, with marks at both ends), so
that unknown words built on known stems are recognised. Two gated recurrent units read the window in
either direction, attention weighs their states into one vector, and a logit follows. The document's
score is a logistic function of its windows: the highest and second highest logit, the mean
probability, and the number of windows.

Training takes a bounded sample: of either label at most ``max_rows`` labelled documents (those with
the lowest key hashes), of each at most ``SAMPLE_WINDOWS`` windows spread evenly over the text, windows
of over ``SAMPLE_BYTES`` bytes left out. Three quarters train the network, on batches with as many windows of toxic
as of clean documents, by back-propagation through time; the rest fits the document function, weighted
back to the labels' shares. Scoring reads every window of every text.

Defined cases: a null or empty text, or one of white space only, has no window and gets the share of
toxic labels; a word of any length is one word; a document with several labels counts as toxic if their
mean is over 0.5; null labels are ignored; with labels of one kind only every score is that share (0.5
without any); repeated rows get repeated results; an empty table gives an empty result; other columns
pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.llm.common import table, text_slices
from shelfrank.llm.registry import query

WINDOW, STRIDE = 48, 32
GRAMS = (3, 5)                             # bytes of a character n-gram
WORD_BITS, GRAM_BITS = 14, 16              # hash buckets of words and n-grams
WORD_DIM, GRAM_DIM, HIDDEN, ATTEND = 16, 16, 16, 16
SAMPLE_WINDOWS, SAMPLE_BYTES = 16, 2048
OUTER = ".,;:!?\"'()[]{}<>#$%&*|-_"        # marks taken off a word's ends
BATCH = 1024                               # windows scored together
MIX = np.uint64(0x9E3779B97F4A7C15)


def window_starts(n: int) -> range:
    """First words of the windows of a text of n words; the last window reaches its end."""
    return range(0, max(1, n - WINDOW + STRIDE), STRIDE) if n else range(0)


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


class Words:
    """Hash buckets of distinct words: one per word, and one per character n-gram."""

    def __init__(self, words: list[str]):
        plain = [w.lower().strip(OUTER) or w for w in words]
        raw = [b"\x02" + w.encode("utf-8", "surrogatepass") + b"\x03" for w in plain]
        self.n = len(raw)
        self.word = np.fromiter((xxhash.xxh3_64_intdigest(r) >> (64 - WORD_BITS) for r in raw), np.int64, self.n)
        data = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
        of = np.repeat(np.arange(self.n), np.fromiter(map(len, raw), np.int64, self.n))
        grams, owners = [], []
        for size in GRAMS:
            many = len(data) - size + 1
            if many <= 0:
                continue
            h = np.full(many, size, np.uint64)
            for j in range(size):
                h = h * np.uint64(1_000_003) + data[j:j + many]
            inside = of[:many] == of[size - 1:]
            grams.append(((h[inside] * MIX) >> np.uint64(64 - GRAM_BITS)).astype(np.int64))
            owners.append(of[:many][inside])
        self.grams, self.owners = grams, owners
        self.counts = np.maximum(1, np.sum([np.bincount(o, minlength=self.n) for o in owners], axis=0)) if owners else np.ones(self.n)


def _sums(rows: np.ndarray, keys: np.ndarray):
    """(distinct ascending keys, sum of their rows); ``keys`` ascend."""
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(rows, first, axis=0) if len(first) else rows[:0]


class ToxicityModel:
    """The network and the document function. ``train`` fits both; ``score`` takes texts."""

    def __init__(self, seed: int = 7, steps: int = 400, batch: int = 192, rate: float = 0.006,
                 table_rate: float = 0.15, blank: float = 0.15, least: int = 4):
        self.seed, self.steps, self.batch, self.rate, self.table_rate, self.blank = seed, steps, batch, rate, table_rate, blank
        self.least = least
        rng = np.random.default_rng(seed)
        d, h, k = WORD_DIM + GRAM_DIM, HIDDEN, ATTEND
        near = lambda *shape, by: (rng.normal(size=shape) / np.sqrt(by)).astype(np.float32)
        self.tables = [near(1 << WORD_BITS, WORD_DIM, by=400), near(1 << GRAM_BITS, GRAM_DIM, by=40)]
        self.p = {"W": near(2, d, 3 * h, by=d), "b": np.zeros((2, 1, 3 * h), np.float32), "U": near(2, h, 3 * h, by=h),
                  "A": near(2 * h, k, by=2 * h), "a": np.zeros(k, np.float32), "v": near(k, by=k),
                  "w": near(2 * h, by=2 * h), "c": np.zeros((), np.float32)}
        self.share, self.head = 0.5, None      # share of label 1; (mean, scale, weights, constant) of the document function

    # ------------------------------------------------------------------ network
    def inputs(self, words: Words) -> np.ndarray:
        x = np.zeros((words.n, WORD_DIM + GRAM_DIM), np.float32)
        x[:, :WORD_DIM] = self.tables[0][words.word]
        for grams, owners in zip(words.grams, words.owners, strict=True):
            which, total = _sums(self.tables[1][grams], owners)
            x[which, WORD_DIM:] += total
        x[:, WORD_DIM:] /= words.counts[:, None]
        return x

    def forward(self, g, mask: np.ndarray, keep: bool = False):
        """Logits of windows. ``g(t)`` gives the inputs times W of step t for both directions (2, B, 3H),
        ``mask`` (B, T) marks the words. With ``keep``, also what ``backward`` needs."""
        p, h = self.p, HIDDEN
        many, steps = mask.shape
        state = np.zeros((2, many, h), np.float32)
        hidden = np.empty((steps, 2, many, h), np.float32)
        told = []
        for t in range(steps):
            into, back = g(t), state @ p["U"]
            gates = sigmoid(into[..., :2 * h] + back[..., :2 * h])
            r, z = gates[..., :h], gates[..., h:]
            new = np.tanh(into[..., 2 * h:] + r * back[..., 2 * h:])
            on = np.stack([mask[:, t], mask[:, steps - 1 - t]])[..., None]
            if keep:
                told.append((state, r, z, new, back[..., 2 * h:], on))
            state = state + on * (1 - z) * (new - state)
            hidden[t] = state
        both = np.concatenate([hidden[:, 0], hidden[::-1, 1]], axis=2)          # (T, B, 2H)
        s = np.tanh(both @ p["A"] + p["a"])
        e = np.where(mask.T > 0, s @ p["v"], -np.inf)
        weight = np.exp(e - e.max(0))
        weight /= weight.sum(0)
        pooled = (weight[..., None] * both).sum(0)
        logit = pooled @ p["w"] + p["c"]
        return (logit, (told, both, s, weight, pooled)) if keep else logit

    def backward(self, d_logit: np.ndarray, kept, x: np.ndarray):
        """Gradients of the parameters and of the inputs x (2, B, T, D)."""
        p, h = self.p, HIDDEN
        told, both, s, weight, pooled = kept
        g = {"c": d_logit.sum(), "w": pooled.T @ d_logit}
        d_pooled = d_logit[:, None] * p["w"]
        d_weight = (both * d_pooled).sum(2)
        d_e = weight * (d_weight - (weight * d_weight).sum(0))
        d_s = d_e[..., None] * p["v"] * (1 - s ** 2)
        g["v"] = (s * d_e[..., None]).sum((0, 1))
        g["a"] = d_s.sum((0, 1))
        g["A"] = both.reshape(-1, 2 * h).T @ d_s.reshape(-1, ATTEND)
        d_both = weight[..., None] * d_pooled + d_s @ p["A"].T
        d_hidden = np.stack([d_both[..., :h], d_both[::-1, :, h:]], axis=1)     # (T, 2, B, H)
        steps = len(told)
        d_into = np.empty((steps, 2, d_logit.shape[0], 3 * h), np.float32)
        g["U"], d_state = np.zeros_like(p["U"]), np.zeros_like(d_hidden[0])
        for t in range(steps - 1, -1, -1):
            state, r, z, new, back, on = told[t]
            d = d_state + d_hidden[t]
            d_new = d * on * (1 - z) * (1 - new ** 2)
            d_z = d * on * (state - new) * z * (1 - z)
            d_r = d_new * back * r * (1 - r)
            d_into[t] = np.concatenate([d_r, d_z, d_new], axis=2)
            d_back = np.concatenate([d_r, d_z, d_new * r], axis=2)
            g["U"] += state.transpose(0, 2, 1) @ d_back
            d_state = d * (1 - on * (1 - z)) + d_back @ p["U"].transpose(0, 2, 1)
        flow = d_into.transpose(1, 2, 0, 3)                                     # (2, B, T, 3H)
        g["b"] = flow.sum((1, 2))[:, None, :]
        g["W"] = np.stack([x[i].reshape(-1, x.shape[3]).T @ flow[i].reshape(-1, 3 * h) for i in (0, 1)])
        return g, np.stack([flow[i] @ p["W"][i].T for i in (0, 1)])

    # ------------------------------------------------------------------ training
    def _forget_rare(self, rows):
        """Buckets that fewer than ``least`` training documents touch stay zero: they would only name
        single documents."""
        held = [np.zeros(len(t), np.int32) for t in self.tables]
        for _, _, windows in rows:
            words = Words(list({w for t in windows for w in t.split()}))
            held[0][np.unique(words.word)] += 1
            held[1][np.unique(np.concatenate(words.grams or [words.word[:0]]))] += 1
        self.known = [(h >= self.least)[:, None].astype(np.float32) for h in held]
        self.tables = [t * k for t, k in zip(self.tables, self.known, strict=True)]

    def _step(self, windows: list[list[str]], y: np.ndarray, rng, moments, number: int):
        names: dict[str, int] = {}
        at = np.zeros((len(windows), WINDOW), np.int64)
        mask = np.zeros((len(windows), WINDOW), np.float32)
        for i, words in enumerate(windows):
            at[i, :len(words)] = [names.setdefault(w, len(names)) for w in words]
            mask[i, :len(words)] = 1
        words = Words(list(names))
        seen = (mask * (rng.random(mask.shape) >= self.blank)).astype(np.float32)     # some words are blanked
        x = self.inputs(words)[at] * seen[..., None]
        x = np.stack([x, x[:, ::-1]])
        into = np.stack([x[i] @ self.p["W"][i] + self.p["b"][i] for i in (0, 1)])
        logit, kept = self.forward(lambda t: into[:, :, t], mask, keep=True)
        g, d_x = self.backward(((sigmoid(logit) - y) / len(y)).astype(np.float32), kept, x)
        d_words = (d_x[0] + d_x[1][:, ::-1]) * seen[..., None]
        order = np.argsort(at, axis=None, kind="stable")
        which, total = _sums(d_words.reshape(-1, d_words.shape[2])[order], at.ravel()[order])
        d_word = np.zeros((words.n, d_words.shape[2]), np.float32)
        d_word[which] = total
        d_gram = d_word[:, WORD_DIM:] / words.counts[:, None].astype(np.float32)
        grams, owners = np.concatenate(words.grams), np.concatenate(words.owners)
        for i, (keys, rows) in enumerate([(words.word, d_word[:, :WORD_DIM]), (grams, d_gram[owners])]):
            order = np.argsort(keys, kind="stable")
            which, total = _sums(rows[order], keys[order])
            squares = moments["tables"][i]                                  # a step per row by its own history
            squares[which] += total ** 2
            self.tables[i][which] -= self.known[i][which] * (self.table_rate * total / (np.sqrt(squares[which]) + 1e-6))
        size = np.sqrt(sum(float((v ** 2).sum()) for v in g.values()))
        rate = self.rate * min(1.0, 2 * (1 - number / (self.steps + 1)))    # steady, then down to zero
        for name, d in g.items():
            d = d * min(1.0, 1.0 / (size + 1e-9))
            m, v = moments[name]
            m += 0.1 * (d - m)
            v += 0.01 * (d ** 2 - v)
            self.p[name] = (self.p[name] - rate * (m / (1 - 0.9 ** number)) / (np.sqrt(v / (1 - 0.99 ** number)) + 1e-8)).astype(np.float32)
        return logit

    def train(self, rows: list[tuple[int, bool, list[str]]], shares: tuple[float, float]) -> ToxicityModel:
        """``rows``: (label, whether the row fits the document function, window texts); ``shares``: what
        one row of label 0 and one of label 1 stand for."""
        whole = sum(shares[y] for y, _, _ in rows)
        self.share = sum(shares[y] for y, _, _ in rows if y) / whole if rows else 0.5
        pools = [[w.split() for y, late, windows in rows if y == label and not late for w in windows] for label in (0, 1)]
        if not all(pools):
            return self
        self._forget_rare([r for r in rows if not r[1]])
        rng = np.random.default_rng(self.seed)
        moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in self.p.items()}
        moments["tables"] = [np.zeros_like(t) for t in self.tables]
        half = self.batch // 2
        y = np.repeat([0.0, 1.0], half)
        for number in range(1, self.steps + 1):
            chosen = [pool[i] for pool in pools for i in rng.integers(len(pool), size=half)]
            self._step(chosen, y, rng, moments, number)
        late = [r for r in rows if r[1] and r[2]] or [r for r in rows if r[2]]
        if len({y for y, _, _ in late}) < 2:
            late = [r for r in rows if r[2]]
        cut = [w.split() for _, _, windows in late for w in windows]
        lengths = np.array([len(w) for w in cut])
        logits = self.logits(cut, np.cumsum(lengths) - lengths, lengths)
        self._fit_head(self.document_features(logits, np.array([len(r[2]) for r in late])),
                       np.array([float(r[0]) for r in late]), np.array([shares[r[0]] for r in late]))
        return self

    def _fit_head(self, f: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.5):
        """Weighted logistic regression by Newton steps."""
        weight = weight * len(y) / weight.sum()
        mean, scale = f.mean(0), f.std(0) + 1e-6
        x = np.column_stack([(f - mean) / scale, np.ones(len(y))])
        b = np.zeros(x.shape[1])
        pull = np.diag([ridge] * f.shape[1] + [1e-3])
        for _ in range(40):
            q = sigmoid(np.clip(x @ b, -30, 30))
            b -= np.linalg.solve((x * (weight * q * (1 - q))[:, None]).T @ x + pull, x.T @ (weight * (q - y)) + pull @ b)
        self.head = (mean, scale, b[:-1], b[-1])

    # ------------------------------------------------------------------ scoring
    @staticmethod
    def document_features(logits: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Of documents with ``counts`` (at least one) windows each: highest and second highest logit,
        mean probability, log of the number of windows."""
        doc = np.repeat(np.arange(len(counts)), counts)
        order = np.lexsort((-logits, doc))
        first = np.append(0, np.cumsum(counts)[:-1])
        ranked = logits[order]
        second = np.where(counts > 1, ranked[np.minimum(first + 1, len(ranked) - 1)], ranked[first])
        mean = np.add.reduceat(sigmoid(logits), first) / counts
        return np.column_stack([ranked[first], second, mean, np.log(counts)])

    def logits(self, texts: list[list[str]], begin: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Logits of the windows that begin at the words ``begin`` of all texts' words in a row."""
        names: dict[str, int] = {}
        flat = np.array([names.setdefault(w, len(names)) for words in texts for w in words] + [0] * WINDOW, np.int32)
        x = self.inputs(Words(list(names)))
        known = [x @ self.p["W"][i] + self.p["b"][i] for i in (0, 1)]       # each distinct word's share of the gates
        out = np.zeros(len(begin))
        for s in range(0, len(begin), BATCH):
            n = lengths[s:s + BATCH]
            steps = int(n.max())
            at = flat[begin[s:s + BATCH, None] + np.arange(steps)]
            out[s:s + BATCH] = self.forward(
                lambda t: np.stack([known[0][at[:, t]], known[1][at[:, steps - 1 - t]]]),  # noqa: B023
                (np.arange(steps) < n[:, None]).astype(np.float32))
        return out

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Probability of label 1 of every text."""
        out = np.full(len(texts), self.share)
        if self.head is None:
            return out
        words = [(t or "").split() for t in texts]
        counts = np.array([len(window_starts(len(w))) for w in words], np.int64)
        some = np.flatnonzero(counts)
        if not len(some):
            return out
        base = np.cumsum([0, *map(len, words)])
        begin = np.array([base[i] + s for i, w in enumerate(words) for s in window_starts(len(w))])
        ends = np.repeat(base[1:], counts)
        logits = self.logits(words, begin, np.minimum(WINDOW, ends - begin))
        mean, scale, weights, constant = self.head
        f = (self.document_features(logits, counts[some]) - mean) / scale
        out[some] = sigmoid(np.clip(f @ weights + constant, -30, 30))
        return out


def sample_windows(docs: DataFrame, keep: list[str], text: str) -> DataFrame:
    """The columns ``keep`` and up to ``SAMPLE_WINDOWS`` windows, spread evenly over the text."""
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("windows", T.ArrayType(T.StringType()))])

    def run(batches):
        for batch in batches:
            for at, texts in text_slices(batch, text):
                found = []
                for t in texts:
                    words = (t or "").split()
                    starts = window_starts(len(words))
                    take = np.unique(np.linspace(0, len(starts) - 1, min(len(starts), SAMPLE_WINDOWS)).astype(int)) if starts else []
                    cut = [" ".join(words[starts[i]:starts[i] + WINDOW]) for i in take]
                    found.append([w for w in cut if len(w.encode("utf-8", "surrogatepass")) <= SAMPLE_BYTES])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(at, len(texts)) for c in keep] + [pa.array(found, pa.list_(pa.string()))], names=schema.names)

    return docs.select(*keep, text).mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = 2_500, text: str = "text",
          key: str = "doc_id", **params) -> ToxicityModel:
    """Fit on at most ``max_rows`` documents of either label outside the held-out fifth (the documented
    bound: at most 2 * max_rows * SAMPLE_WINDOWS * SAMPLE_BYTES bytes come to the driver, 160 MB; about a
    tenth of that in ordinary texts)."""
    h = F.crc32(F.col(key).cast("string"))
    known = (labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & (h % 5 != 0))
             .groupBy(key).agg((F.avg(label) > 0.5).cast("int").alias("_y")))
    counts = {r["_y"]: r["count"] for r in known.groupBy("_y").count().collect()}
    lowest = lambda y: known.where(F.col("_y") == y).orderBy(F.xxhash64(key), key).limit(max_rows)
    chosen = lowest(0).unionByName(lowest(1)).withColumn("_late", h % 5 == 1)
    rows = sample_windows(docs.select(key, text).join(F.broadcast(chosen), key), ["_y", "_late"], text)
    # copies count once; a repeated doc_id with ever other texts does not widen the bound
    got = rows.distinct().orderBy(F.xxhash64("windows"), "windows", "_y", "_late").limit(2 * max_rows).collect()
    shares = tuple(counts.get(y, 0) / max(1, sum(r["_y"] == y for r in got)) for y in (0, 1))
    return ToxicityModel(**params).train([(r["_y"], r["_late"], r["windows"]) for r in got], shares)


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", name: str = "score", keep_text: bool = False) -> DataFrame:
    """``docs`` (with its text only if ``keep_text``) with the column ``name`` (a column of that name is replaced)."""
    keep = [c for c in docs.columns if c != name and (keep_text or c != text)]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(name, T.DoubleType())])

    def run(batches):
        for batch in batches:
            for at, texts in text_slices(batch, text, 1_000_000):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(at, len(texts)) for c in keep] + [pa.array(model.score(texts), pa.float64())],
                    names=keep + [name])

    return docs.select(*keep, *([] if keep_text else [text])).mapInArrow(run, schema)


TOXIC = 0.5   # a score from here on counts as label 1


@query("op12_toxicity")
def op12_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return score(docs, model).select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score",
                                     (F.col("score") >= TOXIC).cast("int").alias("predicted"))
