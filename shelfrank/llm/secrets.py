"""Secret scan in DataFrame expressions: three pattern rules and a character Markov classifier.

The rules find assignments, access keys and long hexadecimal runs. The classifier judges every
other long run of key characters by the log-likelihood ratio of two first-order Markov models over
characters: one of random strings, one of ordinary identifiers. Both are trained here from labelled
samples. Ordinary: the alphabetic words of all documents, each counted, and ``sample_values``
identifiers made of the words with the lowest hashes in the usual styles (``STYLES``: camel case,
constants, snake case, hyphens, paths, numbered names). Random: hashes of the same words, written in
base 64 and in hexadecimal digits of either case. What the models gather is the (at most STATES^2) transition counts.

Defined cases: a null text counts as empty and has no spans; every character of a long text is
scanned; repeated rows give repeated results; an empty table gives an empty result and models that
are smoothing alone; positions are code points, ends exclusive; other columns pass through.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from shelfrank.llm.common import free_name, table, written
from shelfrank.llm.registry import query

ASSIGN = ("(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?"
          "([A-Za-z0-9+/_.=-]+)")
ACCESS = "AKIA[A-Z0-9]{16,}"     # a run of 20 or more; a shorter one holds no longer one
HEX = "[0-9a-f]{24,}"
KEY_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
RUN = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}"
KINDS = ["assign", "access", "hex", "markov"]   # order of spans with equal starts
STATES = len(KEY_CHARS) + 1                     # 0 stands before the first character
MIXED = 0.7                                     # weight of a transition against its character's frequency


def _places(text: Column, pattern: str, kind: str, value_group: int = 0, least: int = 1) -> Column:
    """array of struct(start, rank, end, kind, value): the leftmost non-overlapping matches whose
    ``value_group`` has ``least`` characters. The pieces between matches give the positions."""
    pat = F.lit(pattern)
    rows = F.arrays_zip(F.regexp_extract_all(text, pat, F.lit(0)).alias("whole"),
                        F.regexp_extract_all(text, pat, F.lit(value_group)).alias("value"),
                        F.split(text, pattern, -1).alias("before"))
    empty = F.struct(F.lit(0).alias("at"), F.expr(
        "cast(array() as array<struct<start:int,rank:int,end:int,kind:string,value:string>>)").alias("found"))

    def step(s: Column, m: Column) -> Column:
        start = s["at"] + F.char_length(m["before"])
        end = start + F.char_length(F.coalesce(m["whole"], F.lit("")))
        keep = F.coalesce(F.char_length(m["value"]) >= least, F.lit(False))  # the last piece has no match
        place = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.alias("end"),
                         F.lit(kind).alias("kind"), m["value"].alias("value"))
        return F.struct(end.alias("at"),
                        F.when(keep, F.concat(s["found"], F.array(place))).otherwise(s["found"]).alias("found"))

    return F.when(text.rlike(pattern), F.aggregate(rows, empty, step, lambda s: s["found"])).otherwise(empty["found"])


def base_spans(text: Column) -> Column:
    """All spans of the three rules, by start, then by rule."""
    return F.array_sort(F.concat(_places(text, ASSIGN, "assign", 2, 6), _places(text, ACCESS, "access", 0, 20),
                                 _places(text, HEX, "hex", 0, 24)))


def _bigram_counts(words: DataFrame, weight: str | None = None) -> dict[tuple[int, int], float]:
    """Transitions between character states, summed over the column ``word`` (times ``weight``); at
    most STATES^2 rows reach the driver."""
    at = lambda i: F.instr(F.lit(KEY_CHARS), F.substring("word", i, 1))
    steps = words.select("word", *([weight] if weight else []), F.explode(F.sequence(F.lit(1), F.char_length("word"))).alias("i"))
    pairs = steps.select(F.when(F.col("i") == 1, F.lit(0)).otherwise(at(F.col("i") - 1)).cast("int").alias("a"),
                         at(F.col("i")).cast("int").alias("b"), (F.col(weight) if weight else F.lit(1)).alias("w"))
    return {(r[0], r[1]): float(r[2]) for r in
            pairs.where("b > 0").groupBy("a", "b").agg(F.sum("w").alias("n")).collect()}


def _styles(a: str, b: str, c: str) -> list[Column]:
    """Identifiers of three words in the usual styles."""
    words, cap = [F.col(a), F.col(b), F.col(c)], [F.initcap(x) for x in (a, b, c)]
    number = F.pmod(F.xxhash64(a), F.lit(100)).cast("string")
    return [F.concat(words[0], *cap[1:]), F.concat(*cap), F.concat(words[0], cap[1]), F.upper(F.concat_ws("_", *words)),
            F.concat_ws("_", *words), F.concat_ws("-", *words), F.concat_ws("/", *words), F.concat_ws("/", words[0], F.concat(*cap)),
            F.concat(words[0], F.lit("_"), words[1], number), F.concat(F.lit("/"), F.concat_ws("/", words[0], words[1])),
            F.concat(cap[0], cap[1], number), F.concat_ws("-", F.lit("https"), *words)]


def train(docs: DataFrame, text: str = "text", key: str = "doc_id", sample_values: int = 5_000) -> list[float]:
    """Log-likelihood ratios random / ordinary, by state * STATES + next state."""
    token = F.explode(F.split(F.coalesce(F.col(text), F.lit("")), " ")).alias("token")
    words = (docs.select(token).select(F.lower(F.rtrim("token", F.lit(".,;:!?"))).alias("word")).where("word rlike '^[a-z]{3,19}$'")
             .groupBy("word").agg(F.count("*").alias("n")))
    words = written(words, "ordinary-words")
    # the words with the lowest hashes, three in a row: a bounded sample
    some = words.select("word").orderBy(F.xxhash64("word"), "word").limit(sample_values)
    order = Window.orderBy(F.xxhash64("a", F.lit(1)), "a")
    triples = some.select(F.col("word").alias("a")).select("a", F.lead("a", 1).over(order).alias("b"), F.lead("a", 2).over(order).alias("c")).where(
        "c is not null")
    identifiers = triples.select(F.explode(F.array(*_styles("a", "b", "c"))).alias("word"))
    digest = F.sha2("a", 256)
    tokens = triples.select(F.explode(F.array(
        F.substring(F.base64(F.unhex(digest)), 1, 40), F.translate(F.substring(F.base64(F.unhex(F.sha2("b", 256))), 1, 40), "+/", "-_"),
        F.substring(F.regexp_replace(F.base64(F.unhex(F.sha2("c", 512))), "[+/=]", ""), 1, 40),
        F.substring(F.upper(digest), 1, 20), F.substring(digest, 1, 20))).alias("word"))
    random, ordinary, common = _bigram_counts(tokens), _bigram_counts(identifiers), _bigram_counts(words, "n")
    # words and identifiers weigh alike
    share = sum(ordinary.values()) / max(1.0, sum(common.values()))
    for k, n in common.items():
        ordinary[k] = ordinary.get(k, 0.0) + share * n

    def log_probs(counts: dict) -> list[list[float]]:
        """Transitions mixed with the frequencies of the characters, each seen once more."""
        single = [0.0] + [sum(n for (_, b), n in counts.items() if b == c) + 1 for c in range(1, STATES)]
        whole, out = sum(single), []
        for a in range(STATES):
            row = [counts.get((a, b), 0.0) for b in range(STATES)]
            total = sum(row[1:])
            out.append([0.0] + [math.log((MIXED * row[b] / total if total else 0.0)
                                         + (1 - MIXED if total else 1.0) * single[b] / whole) for b in range(1, STATES)])
        return out

    r, o = log_probs(random), log_probs(ordinary)
    return [round(r[a][b] - o[a][b], 6) for a in range(STATES) for b in range(STATES)]


def likelihood_ratio(word: Column, model: list[float]) -> Column:
    ratios = F.split(F.lit(",".join(map(str, model))), ",").cast("array<double>")   # folded to one literal
    zero = F.struct(F.lit(0).alias("state"), F.lit(0.0).alias("sum"))

    def step(s: Column, c: Column) -> Column:
        b = F.instr(F.lit(KEY_CHARS), c)
        return F.struct(b.alias("state"), (s["sum"] + F.get(ratios, s["state"] * STATES + b)).alias("sum"))

    return F.aggregate(F.filter(F.split(word, ""), lambda c: c != ""), zero, step, lambda s: s["sum"])


def scan(docs: DataFrame, model: list[float], text: str = "text", least_run: int = 16,
         least_mean: float = 0.3) -> DataFrame:
    """``docs`` with ``base`` (spans of the rules) and ``added`` (runs of at least ``least_run`` key
    characters apart from them whose mean log-likelihood ratio per character is ``least_mean``). Columns of these names are replaced."""
    t = F.coalesce(F.col(text), F.lit(""))
    runs = free_name(docs, "_runs")
    found = docs.withColumn("base", base_spans(t)).withColumn(runs, _places(t, RUN % least_run, "markov"))
    return found.withColumn("added", F.filter(runs, lambda r: ~F.exists(
        "base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"]))
        & (likelihood_ratio(r["value"], model) >= least_mean * F.char_length(r["value"])))).drop(runs)


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@query("op3_secret_scan")
def op3_secret_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, train(docs))
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", n("assign"), n("access"), n("hex"),
                        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                        joined(F.array_sort(F.concat("base", "added"))).alias("spans"),
                        F.size("added").cast("long").alias("n_added"))
