"""Line dedup by an exact set-similarity join, in DataFrame expressions only.

A line is the set of its distinct lower-case words. A line goes if an earlier line (smaller doc_id,
or same document, smaller line number) has a set of Jaccard similarity ``percent`` / 100 or more.

Lines with equal sets are one set, named by its first line. Words become 64-bit codes whose upper
bits are a frequency class (counted over all words of all texts in 65,536 hash buckets, a table of
fixed size) and whose lower 48 bits are a hash, so that sorting codes orders words by rarity. The
a + b words that two sets do not share cut the shared ones, in that order, into a + b + 1 runs at most,
so that of the first a + b + 2 shared words two are neighbours in both sets. From a similarity t of
3/4 on there are as many, among the floor(2 (1 - t) n) + 2 rarest words of a set of n: sets meet under
two neighbouring words there (below 3/4 under each of the n - ceil(t n) + 1 rarest words). Sets that
meet must have sizes that allow the similarity (length filter); a 128-bit parity of each set rules out
pairs that provably differ in too many words, and the pairs that pass are verified on all codes.

A cluster of variants is not paired up: in a first round every set meets only the earliest set under
each of its keys; sets for which that proves an earlier match need no further partner.

Defined cases: a null or empty text has no lines to remove; a line without words is never removed
and matches nothing; a line that consists of one very long word is a set of one; rows that repeat doc_id and
text are the same document; a null doc_id comes after all others; an empty table gives an empty
result; other columns pass through, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from shelfrank.llm.common import free_name, table, written
from shelfrank.llm.registry import query

CLASSES = 1 << 16          # hash buckets of the word counts
NEIGHBOURS_FROM = 75       # percent from which similar sets are sure to share two neighbouring words
HASH_BITS = 48
FEW = 400_000              # rows that are broadcast at most


def _words(line: Column) -> Column:
    """Lower-case words; the split by one blank alone is much the faster one."""
    low = F.lower(line)
    return F.array_remove(F.when(line.rlike("[\\t\\r\\f\\x0B\\n]"), F.split(low, "[ \\t\\r\\f\\x0B\\n]+"))
                          .otherwise(F.split(low, " ")), "")


def frequency_classes(docs: DataFrame, text: str) -> Column:
    """array literal: frequency class of each hash bucket, four classes per doubling of the number of
    words in the bucket."""
    counts = (docs.select(F.explode(_words(F.col(text))).alias("w"))
              .groupBy(F.xxhash64("w").bitwiseAND(CLASSES - 1).alias("b")).agg(F.count("*").alias("n")).collect())
    out = [0] * CLASSES
    for b, n in counts:
        out[b] = min(255, int(4 * math.log2(n + 1)))
    return F.split(F.lit(",".join(map(str, out))), ",").cast("array<int>")


def codes(line: Column, classes: Column) -> Column:
    """Sorted distinct codes of the line's words, rarest first."""
    def code(w: Column) -> Column:
        h = F.xxhash64(w)
        return F.shiftleft(F.get(classes, h.bitwiseAND(CLASSES - 1)).cast("long"), HASH_BITS).bitwiseOR(
            F.shiftrightunsigned(h, 64 - HASH_BITS))

    return F.sort_array(F.array_distinct(F.transform(_words(line), code)))


def _parity(codes_: str, half: int) -> Column:
    """64 of 128 bits, each flipped once per code that falls on it. Two sets differ in at least as many
    codes as their parities differ in bits."""
    bit = lambda x: F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(63).cast("int"))
    mine = F.filter(codes_, lambda x: x.bitwiseAND(64) == 64 * half)
    return F.aggregate(mine, F.lit(0).cast("long"), lambda s, x: s.bitwiseXOR(bit(x)))


class _Places:
    """A line's place (document, line) as one comparable column ``at``: a long if both numbers fit
    into 63 bits, else a struct. Documents without doc_id get the number after the largest. If any
    doc_id repeats, a document is its number and the hash of its text, so that different texts under
    one doc_id (or without any) stay apart."""

    def __init__(self, docs: DataFrame, text: str, key: str):
        low, high, lines, repeated = docs.agg(
            F.min(F.col(key).cast("long")), F.max(F.col(key).cast("long")),
            F.max(F.coalesce(F.char_length(text), F.lit(0))),
            F.count("*") - F.count_distinct(F.coalesce(F.col(key).cast("string"), F.lit("")))).first()
        self.key, self.none = key, (-1 if high is None else high) + 1
        self.bits = (int(lines or 0) + 1).bit_length()          # a text has at most one line more than characters
        self.repeated, self.text = bool(repeated), text
        self.packed = (not repeated and (low is None or low >= 0)
                       and self.none.bit_length() + self.bits <= 63)
        if self.none >= 1 << 63:
            raise ValueError("doc_id leaves no number for documents without one")

    def doc(self) -> Column:
        number = F.coalesce(F.col(self.key).cast("long"), F.lit(self.none).cast("long"))
        if self.repeated:
            return F.struct(number.alias("number"), F.xxhash64(self.text).alias("hash")).alias("doc")
        return number.alias("doc")

    def at(self, doc, line) -> Column:
        if self.packed:
            return (F.shiftleft(doc, self.bits) + line.cast("long")).alias("at")
        return F.struct(doc.alias("doc"), line.cast("int").alias("line")).alias("at")

    def split(self, at: str) -> tuple[Column, Column]:
        if self.packed:
            return (F.shiftright(at, self.bits).alias("doc"),
                    F.col(at).bitwiseAND((1 << self.bits) - 1).cast("int").alias("line"))
        return F.col(f"{at}.doc").alias("doc"), F.col(f"{at}.line").alias("line")


def _few(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Broadcast hint if the rows (and the sum of ``weight``) are proven to be few; else a shuffle join."""
    n, w = df.agg(F.count("*"), F.sum(weight) if weight else F.lit(0)).first()
    return F.broadcast(df) if n <= FEW and (w or 0) <= 5 * FEW else df


def _verified(pairs: DataFrame, docs: DataFrame, classes: Column, percent: int, text: str, places: _Places) -> DataFrame:
    """Of the pairs (at, at2): those whose full sets reach the similarity. Their lines are read again."""
    pairs = written(pairs, "line-pairs")
    need = pairs.select("at").union(pairs.select(F.col("at2").alias("at"))).distinct().select(*places.split("at"))
    need = _few(written(need.groupBy("doc").agg(F.collect_set("line").alias("need"), F.count("*").alias("n")),
                        "line-needs"), "n")
    chosen = (docs.select(places.doc(), F.col(text).alias("t")).join(need, "doc")
              .select("doc", F.explode("need").alias("line"), F.split("t", "\n").alias("ls"))
              .select(places.at(F.col("doc"), F.col("line")), codes(F.get("ls", F.col("line")), classes).alias("codes")))
    if places.repeated:
        chosen = chosen.dropDuplicates(["at"])
    chosen = written(chosen, "line-codes")
    both = pairs.join(chosen, "at").join(chosen.toDF("at2", "codes2"), "at2")
    common = F.size(F.array_intersect("codes", "codes2"))
    return both.where(100 * common >= percent * (F.size("codes") + F.size("codes2") - common)).select("at", "at2")


def removed_lines(docs: DataFrame, percent: int = 80, text: str = "text", key: str = "doc_id",
                  near: int = 64) -> tuple[DataFrame, _Places]:
    """((doc, line) of every line with an earlier match, places): ``places.doc()`` gives the ``doc``
    of a row of ``docs``; ``line`` counts from 0."""
    places = _Places(docs, text, key)
    classes = frequency_classes(docs, text)
    n = F.size("codes")
    wide = percent >= NEIGHBOURS_FROM
    keep = F.least(n, (F.floor(F.lit(2 * (100 - percent)) * n / 100) + 2 if wide
                       else n - F.ceil(F.lit(percent) * n / 100) + 1)).cast("int")
    short = F.transform(F.slice("codes", F.lit(1), keep), lambda c: c.bitwiseAND((1 << 31) - 1).cast("int"))
    rows = docs.select(places.doc(), F.posexplode(F.split(F.col(text), "\n")).alias("line", "words"))
    lines = written(rows.select(places.at(F.col("doc"), F.col("line")), codes(F.col("words"), classes).alias("codes"))
                    .where("size(codes) > 0")
                    .select("at", n.alias("n"), F.xxhash64("codes").alias("k1"), _parity("codes", 0).alias("even"),
                            _parity("codes", 1).alias("odd"), short.alias("prefix")), "lines")
    same = ["k1", "even", "odd", "n"]
    sets = written(lines.groupBy(*same).agg(F.min("at").alias("at"), F.first("prefix").alias("prefix")), "line-sets")
    # a set of n words can only match a different set if n >= t (n + 1)
    able = sets.where(F.lit(percent) * (F.col("n") + 1) <= 100 * F.col("n"))
    size = F.size("prefix")
    keys = (F.zip_with(F.slice("prefix", F.lit(1), size - 1), F.slice("prefix", F.lit(2), size),
                       lambda a, b: F.xxhash64(a, b)) if wide else F.col("prefix"))
    order = Window.partitionBy("key").orderBy("at")
    # most keys have one set and end here, so that the sizes and parities travel with few
    shared = written(able.select(F.explode(keys).alias("key"), "at")
                     .select("key", "at", F.lag("at").over(order).alias("before"), F.lead("at").over(order).alias("after"))
                     .where("before is not null or after is not null").select("key", "at"), "line-shared")
    parts = F.struct("at", "n", "even", "odd")
    posting = shared.join(able.select("at", parts.alias("x")), "at").select("key", "at", "x")

    def earlier(x: Column, y: Column) -> Column:
        """``y`` is an earlier set, and sizes and parities allow the similarity."""
        differ = F.bit_count(x["even"].bitwiseXOR(y["even"])) + F.bit_count(x["odd"].bitwiseXOR(y["odd"]))
        return ((y["at"] < x["at"]) & (100 * F.least(x["n"], y["n"]) >= percent * F.greatest(x["n"], y["n"]))
                & ((100 + percent) * differ <= (100 - percent) * (x["n"] + y["n"])))

    framed = posting.select("key", "x", F.row_number().over(order).alias("i"),
                            F.first("x").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("lead"),
                            F.collect_list("x").over(order.rowsBetween(-near, -1)).alias("ys"))
    found = written(framed.where("i > 1").select(
        F.col("x.at").alias("at"), "key", F.when(F.col("i") > near + 1, F.col("x")).alias("far"),
        F.when(earlier(F.col("x"), F.col("lead")), F.col("lead.at")).alias("lead"),
        F.transform(F.filter("ys", lambda y: earlier(F.col("x"), y)), lambda y: y["at"]).alias("at2s"))
        .where("size(at2s) > 0 or lead is not null or far is not null"), "line-near")

    # round 1: every set against the earliest one under each of its keys
    first = found.where("lead is not null").select("at", F.col("lead").alias("at2")).distinct()
    matched = written(_verified(first, docs, classes, percent, text, places).select("at").distinct(), "line-matched")

    # round 2: the sets that have no match yet against all earlier sets; the ``near`` ones before
    # under each key, and by a join the sets further back under frequent keys
    rest = written(found.join(matched, "at", "left_anti"), "line-open")
    second = rest.select("at", F.explode("at2s").alias("at2")).distinct()
    frequent = written(rest.where("far is not null").select("key").distinct(), "line-frequent")
    if not frequent.isEmpty():
        back = posting.join(_few(frequent), "key").select("key", F.col("x").alias("y"))
        late = rest.where("far is not null").select("key", F.col("far").alias("x"))
        second = second.union(late.join(back, "key").where(earlier(F.col("x"), F.col("y")))
                              .select("x.at", "y.at")).distinct()
    matched = matched.union(_verified(second, docs, classes, percent, text, places).select("at")).distinct()

    gone = (sets.select(*same, F.col("at").alias("first"))
            .join(matched.select(F.col("at").alias("first"), F.lit(True).alias("hit")), "first", "left"))
    return (lines.select("at", *same).join(gone, same).where("hit or at <> first")
            .select(*places.split("at")).distinct()), places


def _by_document(gone: DataFrame) -> DataFrame:
    return written(gone.groupBy("doc").agg(F.sort_array(F.collect_set("line")).alias("lines"),
                                           F.count("*").alias("n")), "removed-lines")


def without_repeated_lines(docs: DataFrame, percent: int = 80, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with the remaining lines as text; a document whose lines are all removed goes."""
    removed, places = removed_lines(docs, percent, text, key)
    doc, lines, n = (free_name(docs, c) for c in ("_doc", "_gone", "_n"))
    gone = _by_document(removed).withColumnsRenamed({"doc": doc, "lines": lines, "n": n})
    left = F.filter(F.split(F.col(text), "\n"), lambda x, i: ~F.array_contains(lines, i))
    marked = docs.join(_few(gone, n), places.doc() == gone[doc], "left")
    blank = F.col(lines).isNotNull() & ~F.coalesce(F.exists(left, lambda x: F.trim(x) != ""), F.lit(True))
    return marked.where(~blank).select(*[
        F.when(F.col(lines).isNull(), docs[c]).otherwise(F.array_join(left, "\n")).alias(c) if c == text else docs[c]
        for c in docs.columns])


ORACLE = r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, unnest(range(len(string_split(text, chr(10))))) AS line
           FROM documents),
w AS (SELECT doc_id, line, list_sort(list_distinct(list_filter(string_split_regex(lower(t), '[ \t\r\f\v]+'), lambda x: x <> ''))) AS s FROM l),
sets AS (SELECT s, min((doc_id, line)) AS at, row_number() OVER (ORDER BY min((doc_id, line))) AS id FROM w WHERE len(s) > 0 GROUP BY s),
tok AS (SELECT id, len(s) AS n, unnest(s) AS x FROM sets),
fr AS (SELECT x, count(*) AS f FROM tok GROUP BY x),
rk AS (SELECT id, n, tok.x, row_number() OVER (PARTITION BY id ORDER BY f, tok.x) AS r FROM tok JOIN fr ON fr.x = tok.x),
pre AS (SELECT id, n, x FROM rk WHERE r <= n - ceil(80 * n / 100.0) + 1),
cand AS (SELECT DISTINCT b.id AS id, a.id AS id2 FROM pre a JOIN pre b ON a.x = b.x AND a.id < b.id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
hit AS (SELECT DISTINCT c.id FROM cand c JOIN sets p ON p.id = c.id JOIN sets q ON q.id = c.id2
        WHERE 100 * len(list_intersect(p.s, q.s)) >= 80 * (len(p.s) + len(q.s) - len(list_intersect(p.s, q.s)))),
gone AS (SELECT DISTINCT w.doc_id, w.line FROM w JOIN sets ON sets.s = w.s LEFT JOIN hit ON hit.id = sets.id
         WHERE hit.id IS NOT NULL OR (w.doc_id, w.line) <> sets.at)
SELECT d.doc_id, CAST(len(string_split(d.text, chr(10))) AS INTEGER) AS n_lines,
       coalesce(g.n, 0) AS n_removed, coalesce(g.removed, '') AS removed
FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n, string_agg(CAST(line AS VARCHAR), ',' ORDER BY line) AS removed
                            FROM gone GROUP BY doc_id) g ON g.doc_id = d.doc_id
"""


@query("op9_line_dedup", ORACLE)
def op9_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    removed, places = removed_lines(docs)
    gone = _by_document(removed)
    counted = docs.select("doc_id", places.doc(), F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).alias("n_lines"))
    return counted.join(gone, "doc", "left").select(
        "doc_id", "n_lines", F.coalesce("n", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join(F.col("lines").cast("array<string>"), ","), F.lit("")).alias("removed"))
