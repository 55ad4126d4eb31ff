"""Filter interaction audit: what each of several filters removes under every order of them.

A document is reduced to the mask of the filters it fails. Under one order it is removed at the first
position whose filter is in the mask; all orders that begin with the same filters up to there are
neighbours in lexicographic order, so they are one interval of Lehmer ranks. A mask thus covers a few
intervals per step. Documents are counted per (part, mask); every interval of a mask adds the count at
its first rank and takes it off behind its last one, and a running sum over the ranks of a (part,
step) gives the removals under all orders at once. Nothing grows with documents x orders.

Defined cases: a null text is empty; a null part is the empty string; a row without key fails no
duplicate filter, makes none, and has no flags; rows that repeat a key and a text are no duplicates of
each other (no key is smaller); several flag rows of a key count as set if one of them is; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from shelfrank.llm.common import table, text_slices, written
from shelfrank.llm.registry import query

FEW_WORDS, DISTINCT_PERCENT, UPPER_PERCENT, SYMBOLS = 100, 80, 10, b"#$%&*|"
UPPER = bytes(range(65, 91))


def removal_intervals(n: int) -> list[tuple[int, int, int, int]]:
    """(mask, step, lo, hi): the orders of rank lo <= rank < hi remove what fails the filters of
    ``mask`` (bit i: the i-th filter) at ``step``. The first rank of the orders with one prefix is the
    prefix's Lehmer code in factorial digits."""
    out = []

    def walk(left: list[int], passed: int, step: int, lo: int):
        size = factorial(len(left) - 1)
        for i, f in enumerate(left):
            first = lo + i * size
            out.extend((m, step, first, first + size) for m in range(1, 1 << n) if m >> f & 1 and not m & passed)
            if len(left) > 1:
                walk(left[:i] + left[i + 1:], passed | 1 << f, step + 1, first)

    walk(list(range(n)), 0, 1, 0)
    return out


def audit(masks: DataFrame, letters: str, flags: list[str]) -> DataFrame:
    """The audit of ``masks`` (part, mask, n, one count per flag), which may hold any number of rows
    per part and mask: one row per part, order and step."""
    spark, n = masks.sparkSession, len(letters)
    if not 1 <= n <= 6:
        raise ValueError("an audit lists all orders: one to six filters")
    ranks, counts = factorial(n), ["n", *flags]
    cells = written(masks.groupBy("part", "mask").agg(*[F.sum(c).cast("long").alias(c) for c in counts]), "audit-cells")
    intervals = spark.createDataFrame(removal_intervals(n), "mask int, step int, lo int, hi int")
    ends = cells.join(F.broadcast(intervals), "mask").select(
        "part", "step", F.explode(F.array(
            F.struct(F.col("lo").alias("rank"), *[F.col(c).alias(c) for c in counts]),
            F.struct(F.col("hi").alias("rank"), *[(-F.col(c)).alias(c) for c in counts]))).alias("e")).select("part", "step", "e.*")
    has = lambda f: F.col("mask").bitwiseAND(1 << f) != 0
    parts = cells.groupBy("part").agg(
        F.sum("n").alias("total"),
        F.array(*[F.sum(F.when(has(f), F.col("n")).otherwise(0)) for f in range(n)]).alias("failing"),
        F.array(*[F.sum(F.when(F.col("mask") == 1 << f, F.col("n")).otherwise(0)) for f in range(n)]).alias("only"))
    grid = parts.select("part", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step")).select(
        "part", "step", F.explode(F.sequence(F.lit(0), F.lit(ranks - 1))).alias("rank"),
        *[F.lit(0).cast("long").alias(c) for c in counts])
    changes = ends.where(F.col("rank") < ranks).unionByName(grid).groupBy("part", "step", "rank").agg(
        *[F.sum(c).alias(c) for c in counts])
    upto = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    removed = changes.select("part", "step", "rank", *[F.sum(c).over(upto).alias(c) for c in counts])
    orders = F.array(*[F.lit("".join(p)) for p in permutations(letters)])   # lexicographic, as the letters ascend
    named = (removed.withColumn("filter_order", F.get(orders, F.col("rank")))
             .withColumn("f", F.instr(F.lit(letters), F.expr("substring(filter_order, step, 1)")) - 1)
             .join(parts, "part"))
    before = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return named.select(
        "part", "filter_order", "step", (F.col("total") - F.sum("n").over(before)).alias("kept"), F.col("n").alias("removed"),
        (F.get("failing", F.col("f")) - F.col("n")).alias("redundant"), F.get("only", F.col("f")).alias("unique_fails"),
        *[F.col(c).alias(f"{c}_lost") for c in flags], F.sum("n").over(Window.partitionBy("part", "f")).alias("shapley"))


def failures(docs: DataFrame, part: str = "lang", text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, part, mask of the filters A to D, digest of the text) of every row."""
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("part", T.StringType()),
                           T.StructField("mask", T.IntegerType()), T.StructField("same", T.BinaryType())])

    def run(batches):
        for batch in batches:
            raw = pc.fill_null(pc.cast(batch.column("text"), pa.binary()), b"")
            points = np.asarray(pc.fill_null(pc.utf8_length(batch.column("text")), 0))
            masks, same = [], []
            for at, texts in text_slices(pa.RecordBatch.from_arrays([raw], ["raw"]), "raw"):
                for t, n_points in zip(texts, points[at:at + len(texts)], strict=True):
                    words = t.split()      # of bytes: exactly at \x20 and \x09-\x0D
                    upper = len(t) - len(t.translate(None, UPPER))
                    masks.append((len(words) < FEW_WORDS) | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
                                 | (100 * upper > UPPER_PERCENT * int(n_points)) << 2
                                 | (len(t.translate(None, SYMBOLS)) < len(t)) << 3)
                    same.append(hashlib.sha256(t).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("part"), pa.array(masks, pa.int32()), pa.array(same, pa.binary())],
                names=schema.names)

    return docs.select(F.col(key).alias("key"), F.coalesce(part, F.lit("")).alias("part"),
                       F.col(text).alias("text")).mapInArrow(run, schema)


def document_masks(docs: DataFrame, labels: DataFrame, part: str = "lang", text: str = "text",
                   key: str = "doc_id") -> DataFrame:
    """(part, mask of A to E, n, good, toxic). E: a row with a smaller key has the same text."""
    rows = written(failures(docs, part, text, key).groupBy("key", "part", "mask", "same").agg(F.count("*").alias("n")),
                   "audit-rows")
    keyed = rows.where("key is not null")
    first = keyed.groupBy("same").agg(F.min("key").alias("key")).withColumn("first", F.lit(True))
    # joined by key and text: copies of one text, however many, are as many keys
    marked = (keyed.join(first, ["key", "same"], "left")
              .withColumn("mask", F.col("mask").bitwiseOR(F.when(F.col("first"), 0).otherwise(16)))
              .groupBy("key", "part", "mask").agg(F.sum("n").alias("n")))
    flags = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    out = marked.join(flags, "key", "left").select("part", "mask", "n", "good", "toxic").unionByName(
        rows.where("key is null").select("part", "mask", "n", F.lit(0).alias("good"), F.lit(0).alias("toxic")))
    return out.select("part", "mask", "n", *[F.when(F.col(c) == 1, F.col("n")).otherwise(0).alias(c) for c in ("good", "toxic")])


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS ws FROM d),
lb AS (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY doc_id),
fl AS (SELECT w.part, coalesce(lb.good, 0) AS good, coalesce(lb.toxic, 0) AS toxic,
         len(w.ws) < 100 AS a, 100 * len(list_distinct(w.ws)) < 80 * len(w.ws) AS b,
         100 * length(regexp_replace(w.t, '[^A-Z]', '', 'g')) > 10 * length(w.t) AS c,
         regexp_matches(w.t, '[#$%&*|]') AS d, coalesce(w.doc_id > m.first, false) AS e
       FROM w LEFT JOIN (SELECT t, min(doc_id) AS first FROM d GROUP BY t) m ON m.t = w.t LEFT JOIN lb ON lb.doc_id = w.doc_id),
mk AS (SELECT part, concat(CASE WHEN a THEN 'A' ELSE '' END, CASE WHEN b THEN 'B' ELSE '' END, CASE WHEN c THEN 'C' ELSE '' END,
         CASE WHEN d THEN 'D' ELSE '' END, CASE WHEN e THEN 'E' ELSE '' END) AS mask,
         count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fl GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT concat(p.x, q.x, r.x, s.x, t.x) AS o FROM l p, l q, l r, l s, l t
      WHERE p.x <> q.x AND r.x NOT IN (p.x, q.x) AND s.x NOT IN (p.x, q.x, r.x) AND t.x NOT IN (p.x, q.x, r.x, s.x)),
st AS (SELECT o, unnest([1, 2, 3, 4, 5]) AS step FROM o),
hit AS (SELECT mk.*, st.o, st.step, contains(mk.mask, substr(st.o, st.step, 1)) AS fails,
          contains(mk.mask, substr(st.o, 1, 1)) OR (st.step > 2 AND contains(mk.mask, substr(st.o, 2, 1)))
          OR (st.step > 3 AND contains(mk.mask, substr(st.o, 3, 1))) OR (st.step > 4 AND contains(mk.mask, substr(st.o, 4, 1))) AS early
        FROM mk, st),
res AS (SELECT part, o AS filter_order, step,
          sum(CASE WHEN NOT fails AND (step = 1 OR NOT early) THEN n ELSE 0 END) AS kept,
          sum(CASE WHEN fails AND (step = 1 OR NOT early) THEN n ELSE 0 END) AS removed,
          sum(CASE WHEN fails AND step > 1 AND early THEN n ELSE 0 END) AS redundant,
          sum(CASE WHEN mask = substr(o, step, 1) THEN n ELSE 0 END) AS unique_fails,
          sum(CASE WHEN fails AND (step = 1 OR NOT early) THEN good ELSE 0 END) AS good_lost,
          sum(CASE WHEN fails AND (step = 1 OR NOT early) THEN toxic ELSE 0 END) AS toxic_lost
        FROM hit GROUP BY part, o, step)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, substr(filter_order, step, 1)) AS BIGINT) AS shapley
FROM res
"""


@query("op11_filter_audit", ORACLE)
def op11_filter_audit(spark, sf_dir):
    masks = document_masks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return audit(masks, "ABCDE", ["good", "toxic"])
