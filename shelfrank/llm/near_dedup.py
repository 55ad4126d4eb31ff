"""MinHash near-duplicate detection with HyperMinHash registers.

A document's set holds its distinct word shingles as 64-bit hashes. One hash per shingle fills 128
buckets; a bucket keeps only its smallest hash, compressed to a leading-zero count and 10 mantissa
bits. Empty buckets of small sets take the register of a bucket picked by a fixed permutation, so
that registers of two sets still agree with about the probability of their Jaccard similarity.
Bands of four registers propose candidates (a pair at similarity 0.8 is missed with probability
(1 - 0.8^4)^32, about 5e-8); registers give a collision-corrected estimate that drops clear
non-pairs (0.55 against 0.8, six standard errors and more); the full sets confirm every link.

Equal sets are one class from the start. Inside a band's bucket the classes are compared with the
bucket's smallest class first; once those links are joined to components, only members of different
components of a bucket are compared with each other, block against block inside tasks that return
connecting edges, not pairs. A group of copies so costs one comparison a member, and no link between
components is lost.

Defined cases: words are runs without ASCII white space, A-Z in lower case; a null or empty text
has an empty set and is linked with nothing; a text with fewer words than a shingle is one shingle;
long texts are read whole; rows that repeat a doc_id are one node of the graph; rows without doc_id
join a class like others but never name a component; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.common import (U64, TokenHashes, components, mix64, small_side, table, text_slices,
                                  written)
from shelfrank.llm.registry import query

BUCKETS, BANDS, MANTISSA = 128, 32, 10
LOW_BITS = 64 - 7                       # bits of a hash beneath its bucket number
FEW_IDS = 500_000                       # ids broadcast at most: 4 MB

_rng = np.random.default_rng(20240607)
PERMUTATIONS = np.argsort(_rng.random((BUCKETS, BUCKETS)), axis=1)
BAND_MULTIPLIERS = _rng.integers(1, 2 ** 63, (BANDS, BUCKETS // BANDS), dtype=np.uint64) | U64(1)


def shingle_hashes(text: str | None, size: int, hashes: TokenHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``size`` words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, U64)
    t = np.array([hashes[w] for w in words], U64)
    k = min(size, len(t))
    h = np.full(len(t) - k + 1, k, U64)
    for j in range(k):
        h = mix64(h * U64(0x9E3779B97F4A7C15) + t[j:len(t) - k + 1 + j])
    return np.unique(h)


def registers(hashes: np.ndarray) -> np.ndarray:
    """HyperMinHash registers (uint16) of a sorted, non-empty set of hashes."""
    bucket = (hashes >> U64(LOW_BITS)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])   # smallest hash of each bucket
    v = ((hashes[first] & U64((1 << LOW_BITS) - 1)) >> U64(LOW_BITS - 53)).astype(np.int64)
    length = np.frexp(v.astype(float))[1]                            # bit length; 53 bits are exact
    zeros = 53 - length
    mantissa = np.where(length > 0, (v << zeros) & ((1 << 52) - 1), 0) >> (52 - MANTISSA)
    out = np.zeros(BUCKETS, np.uint16)
    full = np.zeros(BUCKETS, bool)
    out[bucket[first]] = (zeros << MANTISSA) | mantissa
    full[bucket[first]] = True
    empty = np.flatnonzero(~full)
    if len(empty):
        order = PERMUTATIONS[empty]
        out[empty] = out[order[np.arange(len(empty)), full[order].argmax(1)]]
    return out


def band_keys(reg: np.ndarray) -> np.ndarray:
    r = reg.astype(U64).reshape(BANDS, -1) + U64(1)
    return mix64((mix64(r * BAND_MULTIPLIERS)).sum(1, dtype=U64) + np.arange(BANDS, dtype=U64)).view(np.int64)


def sketches(docs: DataFrame, words: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key, n_shingles, set_a and set_b (a 128-bit digest of the set; null if empty),
    bands and registers."""
    schema = f"{key} long, n_shingles long, set_a long, set_b long, bands array<long>, registers binary"

    def run(batches):
        hashes = TokenHashes()
        for batch in batches:
            for at, texts in text_slices(batch, text):
                n, a, b, bands, regs = [], [], [], [], []
                for t in texts:
                    s = shingle_hashes(t, words, hashes)
                    n.append(len(s))
                    if not len(s):
                        a.append(None), b.append(None), bands.append(None), regs.append(None)
                        continue
                    a.append(int(s.sum(dtype=U64).view(np.int64)))
                    b.append(int(np.bitwise_xor.reduce(mix64(s + U64(len(s)))).view(np.int64)))
                    r = registers(s)
                    bands.append(band_keys(r))
                    regs.append(r.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key).slice(at, len(texts)).cast(pa.int64()), pa.array(n, pa.int64()),
                     pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(bands, pa.list_(pa.int64())),
                     pa.array(regs, pa.binary())],
                    names=[key, "n_shingles", "set_a", "set_b", "bands", "registers"])

    return docs.select(F.col(key).cast("long").alias(key), F.col(text).alias(text)).mapInArrow(run, schema)


def _zeros_distribution(n: np.ndarray) -> np.ndarray:
    """Per set size: probability of each leading-zero count of a bucket's register."""
    lam = np.maximum(n / BUCKETS, 1.0)[:, None]
    at_least = 1 - (1 - np.exp2(-np.arange(54.0)))[None, :] ** lam     # P(zeros >= z)
    return at_least[:, :-1] - at_least[:, 1:]


def expected_collisions(na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Probability that the registers of two unrelated buckets agree, by set sizes."""
    return (_zeros_distribution(na) * _zeros_distribution(nb)).sum(1) / (1 << MANTISSA)


def _likely(pairs: DataFrame, threshold: float, margin: float = 0.25) -> DataFrame:
    """Pairs (a, b) whose sizes allow the threshold and whose estimated similarity, corrected for
    chance agreement of registers, is not clearly below it."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ra, rb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, BUCKETS)
                      for c in ("ra", "rb"))
            na, nb = (batch.column(c).to_numpy().astype(float) for c in ("na", "nb"))
            ec = expected_collisions(na, nb)
            est = ((ra == rb).mean(1) - ec) / (1 - ec)
            ok = (est >= threshold - margin) & (np.minimum(na, nb) >= threshold * np.maximum(na, nb) - 1e-9)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(ok)), batch.column("b").filter(pa.array(ok))],
                                             names=["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def _registers_near(a: pd.DataFrame, b: pd.DataFrame, threshold: float, margin: float = 0.16) -> np.ndarray:
    """Matrix: estimated similarity not clearly below the threshold (4.5 standard errors)."""
    ra, rb = (np.frombuffer(b"".join(x["body"]), np.uint16).reshape(-1, BUCKETS) for x in (a, b))
    na, nb = a["n_shingles"].to_numpy(float), b["n_shingles"].to_numpy(float)
    same = np.zeros((len(a), len(b)), np.float32)
    for k in range(BUCKETS):
        same += ra[:, k][:, None] == rb[:, k][None, :]
    ec = _zeros_distribution(na) @ _zeros_distribution(nb).T / (1 << MANTISSA)
    size_ok = np.minimum(na[:, None], nb) >= threshold * np.maximum(na[:, None], nb) - 1e-9
    return ((same / BUCKETS - ec) / (1 - ec) >= threshold - margin) & size_ok


def _sets_linked(a: pd.DataFrame, b: pd.DataFrame, percent: int) -> np.ndarray:
    """Matrix: full sets reach the threshold. Sets are sorted; only members of other components of
    fitting size are looked up."""
    out = np.zeros((len(a), len(b)), bool)
    flat = np.concatenate(b["body"].to_list()).view(U64)      # sorted as unsigned numbers
    size = b["n_shingles"].to_numpy()
    row = np.repeat(np.arange(len(b)), size)
    ca, cb = a["comp"].to_numpy(), b["comp"].to_numpy()
    for i, x in enumerate(a["body"]):
        n = len(x)
        ok = (cb != ca[i]) & (100 * np.minimum(n, size) >= percent * np.maximum(n, size))
        if not ok.any():
            continue
        pick = ok[row]
        f = flat[pick]
        x = x.view(U64)
        at = np.minimum(np.searchsorted(x, f), n - 1)
        common = np.bincount(row[pick], x[at] == f, len(b))
        out[i] = ok & (100 * common >= percent * (n + size - common))
    return out


def _across(rows: DataFrame, bodies: DataFrame, similar, threshold, block: int = 512) -> DataFrame:
    """Edges (a, b) that connect the ids of a key that are ``similar`` over different components.

    ``rows`` holds (key, id, comp). Each key's ids are dealt into blocks: a component of more than
    ``block`` ids into blocks of its own, the rest together. Every pair of blocks is one task's
    matrix, except pairs inside one component. A task returns one edge per id, to the smallest id
    it is connected with there, never the pairs.
    """
    per = rows.groupBy("key", "comp").agg(F.count("*").alias("n"))
    per = per.withColumn("big", F.col("n") > block)
    small = per.where("not big").groupBy("key").agg(F.ceil(F.sum("n") / block).alias("parts"))
    named = (per.join(small, "key", "left").select(
        "key", "comp", "big", F.when(F.col("big"), F.ceil(F.col("n") / block)).otherwise(F.col("parts")).alias("parts")))
    dealt = written(rows.join(named, ["key", "comp"]).select(
        "key", "id", "comp", F.when(F.col("big"), F.col("comp")).alias("own"),
        F.pmod(F.xxhash64(F.when(F.col("big"), F.col("id")).otherwise(F.col("comp"))), F.col("parts")).alias("part")), "dealt")
    blocks = dealt.select("key", "own", "part").distinct().withColumn("block", F.xxhash64("own", "part"))
    other = blocks.select("key", F.col("own").alias("own2"), F.col("block").alias("block2"))
    tiles = written(blocks.join(other, "key").where("block <= block2 and (own is null or own2 is null or own <> own2)")
                    .select("key", "block", "block2"), "tiles")
    full = dealt.withColumn("block", F.xxhash64("own", "part")).select("key", "block", "id", "comp").join(bodies, "id")
    left = full.join(tiles, ["key", "block"]).withColumn("side", F.lit(0))
    right = (full.withColumnRenamed("block", "block2").join(tiles.where("block < block2"), ["key", "block2"])
             .withColumn("side", F.lit(1)))
    at = ["key", "block", "block2"]
    work = left.unionByName(right).repartition(*at).sortWithinPartitions(*at, "side", "id")

    def run(batches):
        for pdf in _whole_groups(batches, at):
            b = pdf[pdf["side"] == 1]
            a = pdf[pdf["side"] == 0] if len(b) else pdf
            b = b if len(b) else a
            hit = similar(a, b, threshold) & (a["comp"].to_numpy()[:, None] != b["comp"].to_numpy()[None, :])
            i, j = np.nonzero(hit)
            if len(i):
                ids = np.unique(np.r_[a["id"].to_numpy()[i], b["id"].to_numpy()[j]])
                x, y = (np.searchsorted(ids, t["id"].to_numpy()[k]) for t, k in ((a, i), (b, j)))
                low = np.arange(len(ids))
                while True:
                    before = low.copy()
                    m = np.minimum(low[x], low[y])
                    np.minimum.at(low, x, m)
                    np.minimum.at(low, y, m)
                    if (low == before).all():
                        break
                some = low < np.arange(len(ids))
                yield pd.DataFrame({"a": ids[some], "b": ids[low[some]]})

    return work.mapInPandas(run, "a long, b long")


def _whole_groups(batches, keys: list[str]):
    """The groups of a sorted partition, one pandas frame each; a group may span batches."""
    rest = None
    for pdf in batches:
        rest = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
        k = rest[keys].to_numpy()
        cuts = np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1
        starts = np.r_[0, cuts]
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            yield rest.iloc[a:b]
        rest = rest.iloc[starts[-1]:].reset_index(drop=True) if len(rest) else None
    if rest is not None and len(rest):
        yield rest


def _sets_of(docs: DataFrame, ids: DataFrame, words: int, text: str, key: str) -> DataFrame:
    """(id, hashes) of the documents in ``ids``; one row per id."""

    def run(batches):
        hashes = TokenHashes()
        for batch in batches:
            for at, texts in text_slices(batch, text, 1_000_000):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key).slice(at, len(texts)),
                     pa.array([shingle_hashes(t, words, hashes).view(np.int64) for t in texts], pa.list_(pa.int64()))],
                    names=["id", "hashes"])

    rows = docs.select(F.col(key).cast("long").alias(key), F.col(text).alias(text))
    chosen = rows.join(small_side(ids.withColumnRenamed("id", key), FEW_IDS), key, "left_semi")
    return chosen.mapInArrow(run, "id long, hashes array<long>")


def _confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int, text: str,
               key: str) -> DataFrame:
    """The pairs (a, b) of class ids whose full sets reach the threshold."""
    side = lambda x: classes.select(F.col("id").alias(x), F.col("n_shingles").alias("n" + x),
                                    F.col("registers").alias("r" + x))
    maybe = written(_likely(pairs.join(side("a"), "a").join(side("b"), "b"), percent / 100), "likely")
    ids = maybe.select(F.col("a").alias("id")).union(maybe.select("b")).distinct()
    sets = written(_sets_of(docs, ids, words, text, key).dropDuplicates(["id", "hashes"]), "sets")
    both = (maybe.join(sets.select(F.col("id").alias("a"), F.col("hashes").alias("ha")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("hashes").alias("hb")), "b"))
    common = F.size(F.array_intersect("ha", "hb"))
    return both.where(100 * common >= percent * (F.size("ha") + F.size("hb") - common)).select("a", "b")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, text: str = "text",
                    key: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: key, n_shingles, component_id (smallest key reachable over links of
    Jaccard similarity ``percent`` / 100 or more) and kept (the row's key names the component)."""
    rows = written(sketches(docs, words, text, key), "sketches")
    named = rows.where(F.col("set_a").isNotNull() & F.col(key).isNotNull())
    ids = named.groupBy("set_a", "set_b", "n_shingles").agg(F.min(key).alias("id"))
    ids = written(ids, "classes")
    # the sketch of a class: that of a row that names it (rows repeating the key are equal sets or other classes)
    classes = written(named.select(F.col(key).alias("id"), "set_a", "set_b", "n_shingles", "bands", "registers")
                      .join(ids, ["id", "set_a", "set_b", "n_shingles"])
                      .dropDuplicates(["id", "set_a", "set_b"])
                      .select("id", "n_shingles", "bands", "registers"), "class-sketches")
    at = classes.select("id", F.explode("bands").alias("band"))
    lead = at.groupBy("band").agg(F.min("id").alias("lead"), F.count("*").alias("n")).where("n > 1")
    members = written(at.join(lead, "band").select("band", "id", "lead"), "members")
    stars = members.where("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    links = written(_confirmed(stars, classes, docs, words, percent, text, key), "links")

    # members of one bucket in different components: first by registers, in blocks; the ids that are
    # near another component form clusters, and in those the full sets decide, again in blocks
    comp = components(links)
    placed = written(members.select("band", "id").join(comp.withColumnRenamed("node", "id"), "id", "left")
                     .select("band", "id", F.coalesce("component", "id").alias("comp")), "placed")
    mixed = placed.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("band")
    open_ = written(placed.join(mixed, "band", "left_semi").withColumnRenamed("band", "key"), "open")
    near = written(_across(open_, classes.select("id", "n_shingles", F.col("registers").alias("body")),
                           _registers_near, percent / 100).distinct(), "near")
    clusters = written(components(near).withColumnsRenamed({"node": "id", "component": "key"})
                       .join(comp.withColumnRenamed("node", "id"), "id", "left")
                       .select("key", "id", F.coalesce("component", "id").alias("comp")), "clusters")
    sets = written(_sets_of(docs, clusters.select("id"), words, text, key).dropDuplicates(["id", "hashes"])
                   .select("id", F.size("hashes").cast("long").alias("n_shingles"), "hashes"), "sets")
    more = written(_across(clusters, sets.withColumnRenamed("hashes", "body"), _sets_linked, percent), "links")
    # a doc_id on rows of several sets joins those sets, as it is one document
    sets_of = F.struct("set_a", "set_b", "n_shingles")
    several = named.groupBy(key).agg(F.min(sets_of).alias("lo"), F.max(sets_of).alias("hi")).where("lo <> hi").select(key)
    touched = written(named.join(several, key, "left_semi").select(key, "set_a", "set_b", "n_shingles").distinct()
                      .join(ids, ["set_a", "set_b", "n_shingles"]).select(F.col(key).alias("k"), "id"), "repeated-keys")
    joined = touched.join(touched.groupBy("k").agg(F.min("id").alias("a")), "k").where("id <> a").select("a", F.col("id").alias("b"))
    comp = components(links.union(more).union(joined))

    label = ids.join(comp.withColumnRenamed("node", "id"), "id", "left").select(
        "set_a", "set_b", "n_shingles", F.coalesce("component", "id").alias("component"))
    return (rows.select(key, "n_shingles", "set_a", "set_b")
            .join(label, ["set_a", "set_b", "n_shingles"], "left")
            .select(key, "n_shingles", F.coalesce("component", key).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.col(key).isNull()
                                           & F.col("component_id").isNull())))


@query("op1_hyperminhash")
def op1_hyperminhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)
