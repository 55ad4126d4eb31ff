"""Corpus preparation in five stages, each written as Parquet before the next one reads it.

1. quality: documents that the boosted trees score under 0.3 go.
2. lines: lines with an earlier match go; a document without remaining lines goes.
3. near_duplicates: one document of each component of five-word-shingle similarity 0.8 stays.
4. benchmark: documents that hold a test item's question and answer go.
5. pieces: the texts as SentencePiece ids, with the check that they decode to the text.

Stages 1 to 4 return the columns of ``documents`` (n_chars follows the text). Every row is a document
of its own, judged by its text: one without doc_id or with a repeated one like any other. In stage 3 the
row with the smallest doc_id of a group stays, or, if doc_ids are missing or repeat, its first row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.llm.common import free_name, small_side, table, written
from shelfrank.llm.decontaminate import contaminated
from shelfrank.llm.line_dedup import without_repeated_lines
from shelfrank.llm.near_dedup import near_duplicates
from shelfrank.llm.quality import ACCEPT, score, train
from shelfrank.llm.sentencepiece import UnigramModel, encode

FEW_IDS = 1_000_000   # removed rows that are broadcast at most: 8 MB


def _by_row(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number per row, and the number's name: the doc_id where all rows have one of their
    own, else a number given when the rows are written."""
    name = free_name(docs, "_row")
    n, distinct = docs.agg(F.count("*"), F.count_distinct("doc_id")).first()
    if n == distinct:
        return docs.withColumn(name, F.col("doc_id").cast("long")), name
    return written(docs.withColumn(name, F.monotonically_increasing_id()), "numbered-rows"), name


def _without(numbered: DataFrame, found: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """``numbered`` without the rows whose number is in ``found``."""
    ids = written(found.select(name).distinct(), "removed-rows")
    return numbered.join(small_side(ids, FEW_IDS), name, "left_anti").select(*columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = train(docs, table(spark, sf_dir, "labels"))
    name = free_name(docs, "_quality")
    return score(docs, model, name=name, keep_text=True).where(F.col(name) >= ACCEPT).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = without_repeated_lines(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    numbered, name = _by_row(docs)
    found = near_duplicates(numbered, words=5, percent=80, key=name)
    return _without(numbered, found.where("not kept"), name, docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    numbered, name = _by_row(docs)
    return _without(numbered, contaminated(numbered, table(spark, sf_dir, "benchmark"), key=name), name, docs.columns)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode(docs.select("doc_id", "text"), UnigramModel.load(spark)).selectExpr(
        "doc_id", "size(ids) as n_ids", "round_trip", "ids")


STAGES = [("quality classifier", quality), ("line dedup", lines), ("MinHash near-dedup", near_duplicate),
          ("benchmark decontamination", benchmark), ("SentencePiece encoding", pieces)]

ORACLE_SQL = None   # trained trees and Viterbi paths have no SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
