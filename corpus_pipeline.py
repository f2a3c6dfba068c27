"""The corpus pipeline: language, near copies, repeated passages, benchmarks, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's docs. All but the last return the columns of
documents. Rows that repeat a doc_id are one document: near copies and benchmarks leave
them or drop them together. Every row with a null doc_id is a document of its own, judged
like all others; of near copies one without an id stays only where none has an id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerscope.llm import decontaminate, jaccard_join, langid_crf, queries, sentencepiece_bpe, suffix_dedup
from ledgerscope.llm._shared import Scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: a text whose best language has a mean posterior below this, so that other languages
#: together outweigh it, is rejected, as ``und`` is
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in one of the learned languages; null texts and texts without a letter go."""
    docs = docs.select(*COLUMNS)
    blob = langid_crf.fit(docs.filter(langid_crf.fold() != 2), "doc_id", "text", "lang", 500)
    return langid_crf.accepted(docs, blob, LEAST_SCORE)


def numbered(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """docs with an id for each row, saved so that all later plans see the same ids."""
    return scratch.save(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of documents linked by near-equal shingle sets;
    of a group without ids, one row."""
    scratch = Scratch(spark)
    docs = numbered(docs, scratch)
    ids = docs.select("row", "doc_id")
    linked = scratch.save(jaccard_join.near_rows(docs, "row").filter("component_id <> row").select("row", "component_id"))
    few = linked.count() <= jaccard_join.BROADCAST_IDS
    # a group's smallest row is its component and stands in no row of linked
    roots = linked.select(F.col("component_id").alias("row"), "component_id").distinct()
    member = linked.union(roots)
    member = scratch.save(ids.join(F.broadcast(member) if few else member, "row"))
    best = member.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("best"))
    stays = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("doc_id").isNotNull() | (F.col("row") == F.col("best.row")))
    gone = scratch.save(member.join(best, "component_id").filter(~stays).select("row"))
    return docs.join(F.broadcast(gone) if few else gone, "row", "left_anti").select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the 200-byte strings that occur again; n_chars follows."""
    cut = suffix_dedup.without_repeats(docs, suffix_dedup.repeated_spans(docs))
    return cut.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*COLUMNS)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    docs = numbered(docs, Scratch(spark))
    found = decontaminate.decontaminate(docs, queries.table(spark, sf_dir, "benchmark"), row_col="row")
    bad = found.filter("contaminated").select(F.col("doc_id").alias("bad_id"), F.col("row").alias("bad_row"))
    own = F.when(F.col("doc_id").isNull(), F.col("row"))
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col("bad_id")) & own.eqNullSafe(F.col("bad_row")), "left_anti").select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: number and digest of its token ids, and digest of their decoding."""
    return sentencepiece_bpe.digests(docs, queries.piece_model())


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("benchmark_decontamination", benchmarks),
    ("sentencepiece", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents at sf_dir, each written and read again."""
    scratch = Scratch(spark)
    docs = queries.table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
