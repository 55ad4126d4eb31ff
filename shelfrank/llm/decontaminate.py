"""Benchmark decontamination: every training passage queries a BM25 index of the test items.

An item is a question and an answer (its last sentence or line). A passage (a document, whole) holds it if
it shares 80 % of the five-word shingles of each. The index has one entry per item, the longer of the
two, so the distance between question and answer does not matter; its postings carry BM25 impacts divided
by the entry's own full score.  A passage that holds 80 % of an entry's shingles lacks at most as many of
its words as it may lack shingles (a word is missing only if every shingle around it is), so it scores at
least 1 - (the sum of that many largest impacts): this is the entry's threshold, and no item is lost by it.

Retrieval is block-max WAND, without a top-k: one cursor per term of the passage, in order of their
entries (a passage whose terms reach no block's threshold together needs none). The pivot is the first entry at which the terms' largest impacts reach the least threshold; if
the maxima of the pivot's block cannot reach the block's least threshold, all cursors jump behind the block
(or to the next cursor); otherwise the cursors before the pivot move up to it, and once they
are there the entry is scored. What reaches its threshold is verified on question and answer.

The document frequencies and the mean length are computed over all items; the postings are sent to
the tasks in blocks of at most ``items_per_block`` different items, all documents against each of them.

Defined cases: words are runs of word characters in lower case; null or empty items match nothing,
null or empty texts hold nothing; an answer or question of fewer than five words is one shingle;
long texts are read whole; repeated items are matched each, repeated rows give repeated results; an
empty table on either side gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from math import log1p

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.common import table, text_slices
from shelfrank.llm.registry import query

WORD = re.compile(r"\w+")
ENTRY_BLOCK = 4
SLACK = 1e-9
K1, B = 1.2, 0.75


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def shingles(words: list[str], size: int = 5) -> set:
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(size)), strict=False))


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """Words before and in the last sentence or line; an item of one sentence is all answer."""
    parts = [p for p in re.split(r"(?<=[.!?])\s+|\n+", text) if WORD.search(p)]
    return words_of(" ".join(parts[:-1])), words_of(parts[-1] if parts else "")


def entry_of(text: str | None) -> list[str]:
    """Words of the longer of question and answer."""
    q, a = question_and_answer(text or "")
    return q if len(q) >= len(a) else a


class Index:
    """BM25 postings of one block of items, with the largest impact per term and block."""

    def __init__(self, items: list[tuple[int, str, int]], n: int, mean_length: float, df: dict[str, int], overlap: float = 0.8):
        self.items = items
        self.postings: dict[str, tuple[list[int], list[float]]] = {}
        self.block_max: dict[str, dict[int, float]] = {}
        self.need = []
        for e, (_, text, _) in enumerate(items):
            words = entry_of(text)
            counts: dict[str, int] = {}
            for w in words:
                counts[w] = counts.get(w, 0) + 1
            impact = {w: log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * c * (K1 + 1)
                      / (c + K1 * (1 - B + B * len(words) / mean_length)) for w, c in counts.items()}
            full = sum(impact.values())
            for w, i in impact.items():
                entries, impacts = self.postings.setdefault(w, ([], []))
                entries.append(e)
                impacts.append(i / full)
                best = self.block_max.setdefault(w, {})
                best[e // ENTRY_BLOCK] = max(best.get(e // ENTRY_BLOCK, 0.0), i / full)
            lacking = int((1 - overlap) * len(shingles(words)) + SLACK)
            self.need.append(1 - sum(sorted(impact.values(), reverse=True)[:lacking]) / full - SLACK if words else 2.0)
        self.block_need = [min(self.need[s:s + ENTRY_BLOCK]) for s in range(0, len(items), ENTRY_BLOCK)]
        self.term_max = {w: max(impacts) for w, (_, impacts) in self.postings.items()}
        self.checks = [tuple(map(shingles, question_and_answer(text))) for _, text, _ in items]

    def candidates(self, words: set[str]) -> dict[int, float]:
        """Entries whose score reaches their threshold, with it."""
        terms = [w for w in words if w in self.term_max]
        top, found, end = self.term_max, {}, len(self.items)
        least = min(self.block_need, default=2.0)
        if sum(top[w] for w in terms) < least:
            return found
        bounds = [0.0] * len(self.block_need)
        for w in terms:
            for b, i in self.block_max[w].items():
                bounds[b] += i
        if not any(x >= need for x, need in zip(bounds, self.block_need, strict=True)):
            return found                       # no block can hold an entry above its threshold
        lists = [self.postings[w] for w in terms]
        most, blocks = [top[w] for w in terms], [self.block_max[w] for w in terms]
        place = [0] * len(terms)
        cursors = sorted((entries[0], t) for t, (entries, _) in enumerate(lists))

        def moved(t: int, to: int) -> tuple[int, int]:
            entries = lists[t][0]
            place[t] = bisect_left(entries, to, place[t])
            return (entries[place[t]] if place[t] < len(entries) else end, t)

        while cursors:
            bound, at = 0.0, 0
            for entry, t in cursors:
                bound += most[t]
                if bound >= least:
                    break
                at += 1
            else:
                break
            pivot = cursors[at][0]
            while at + 1 < len(cursors) and cursors[at + 1][0] == pivot:
                at += 1
            block = pivot // ENTRY_BLOCK
            before = cursors[:at + 1]
            if sum([blocks[t].get(block, 0.0) for _, t in before]) < self.block_need[block]:
                to = (block + 1) * ENTRY_BLOCK
                if at + 1 < len(cursors):
                    to = min(to, cursors[at + 1][0])
                before = [moved(t, to) for _, t in before]
            elif cursors[0][0] == pivot:
                score = sum([lists[t][1][place[t]] for _, t in before])
                if score >= self.need[pivot]:
                    found[pivot] = score
                before = [moved(t, pivot + 1) for _, t in before]
            else:
                before = [c if c[0] == pivot else moved(c[1], pivot) for c in before]
            cursors = sorted([c for c in before if c[0] < end] + cursors[at + 1:])
        return found

    def verified(self, words: list[str], overlap: float):
        """(item id, score, question overlap, answer overlap) of the items that the text holds."""
        cands = self.candidates(set(words))
        if not cands:
            return
        have = shingles(words)
        held = lambda s: 1.0 if not s else sum(
            x in have if len(x) == 5 else _holds(words, x) for x in s) / len(s)
        for item, score in sorted(cands.items()):
            q, a = self.checks[item]
            hq, ha = held(q), held(a)
            if hq >= overlap and ha >= overlap:
                for _ in range(self.items[item][2]):
                    yield self.items[item][0], score, hq, ha


def _holds(words: list[str], part: tuple) -> bool:
    k = len(part)
    return any(tuple(words[i:i + k]) == part for i in range(len(words) - k + 1) if words[i] == part[0])


def contaminated(docs: DataFrame, items: DataFrame, overlap: float = 0.8,
                 items_per_block: int = 5000, text: str = "text", key: str = "doc_id",
                 item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key, item_id, score, question_overlap, answer_overlap) for every document and item it holds."""
    spark = docs.sparkSession
    items = items.select(F.col(item_key).cast("long").alias("id"), F.col(item_text).alias("t")).where("t is not null")
    split = items.groupBy("id", "t").agg(F.count("*").alias("copies")).withColumn("h", F.pmod(F.xxhash64("id", "t"), F.lit(1 << 20)))
    total = split.count()
    schema = f"{key} long, item_id long, score double, question_overlap double, answer_overlap double"
    if total == 0:
        return spark.createDataFrame([], schema)
    # statistics over all items
    entries = split.mapInArrow(_item_terms, "length long, terms array<string>").where("length > 0")
    n, mean = entries.agg(F.count("*"), F.avg("length")).first()
    if not n:
        return spark.createDataFrame([], schema)
    frequency = entries.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    blocks = -(-total // items_per_block)
    out = None
    for k in range(blocks):
        rows = [(r["id"], r["t"], r["copies"]) for r in split.where(F.col("h") % blocks == k).orderBy("id", "t").collect()]
        if not rows:
            continue
        own = sorted({w for _, t, _ in rows for w in entry_of(t)})
        df = {r[0]: r[1] for r in frequency.join(F.broadcast(
            spark.createDataFrame([(w,) for w in own], "term string")), "term").collect()} if own else {}
        index = Index(rows, n, mean, df, overlap)

        def run(batches, index=index):
            for batch in batches:
                ids = batch.column(key).to_pylist()
                got = []
                for at, texts in text_slices(batch, text):
                    for d, t in zip(ids[at:at + len(texts)], texts, strict=True):
                        got += [(d, *x) for x in index.verified(words_of(t), overlap)]
                cols = list(zip(*got, strict=True)) if got else [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64() if i < 2 else pa.float64()) for i, c in enumerate(cols)],
                    names=[key, "item_id", "score", "question_overlap", "answer_overlap"])

        part = docs.select(F.col(key).cast("long").alias(key), F.col(text).alias(text)).mapInArrow(run, schema)
        out = part if out is None else out.unionAll(part)
    return out


def _item_terms(batches):
    """Length and distinct words of every item's entry."""
    for batch in batches:
        found = [entry_of(t) for t in batch.column("t").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([len(w) for w in found], pa.int64()),
                                          pa.array([sorted(set(w)) for w in found], pa.list_(pa.string()))], names=["length", "terms"])


@query("op4_bm25_decontaminate")
def op4_bm25_decontaminate(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
