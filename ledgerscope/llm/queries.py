"""Queries of the corpus operators, one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerscope.llm import merkle

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def piece_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


@register("op1_ordinal_quality")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerscope.llm import ordinal_quality as Q
    docs = table(spark, sf_dir, "documents")
    blob = Q.fit(Q.rated_sample(docs, Q.grades(table(spark, sf_dir, "labels"))), "doc_id", "text", "grade")
    return Q.predict(docs, blob).select("doc_id", "expected_grade", "tail_prob", F.col("grade_probs")[0].alias("p_toxic"), "kept")


@register("op2_boosted_url_filter")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerscope.llm import url_filter as U
    return U.judge(table(spark, sf_dir, "pages"))


@register("op3_cross_document_lines")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerscope.llm import line_rules as R
    return R.line_quality(table(spark, sf_dir, "documents"))


@register("op4_winnowing_decontamination")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerscope.llm import decontaminate as D
    return D.digest(D.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


@register("op5_crf_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerscope.llm import langid_crf as L
    got = L.identify(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "held_out", "lang_pred", "score", "n_words", F.size("runs").alias("n_runs"))


@register("op6_induced_suffix_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerscope.llm import suffix_dedup as S
    docs = table(spark, sf_dir, "documents")
    return S.digest(docs, S.repeated_spans(docs))


@register("op7_size_aware_jaccard")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerscope.llm import jaccard_join as J
    return J.near_groups(table(spark, sf_dir, "documents"))


@register("op8_sampled_splitters")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerscope.llm import sharding as S
    return S.shard(table(spark, sf_dir, "documents"))


@register("op9_backtracking_bpe")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerscope.llm import sentencepiece_bpe as S
    return S.digests(table(spark, sf_dir, "documents"), piece_model(), keep_units=400_000)


@register("op10_chat_hmm")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerscope.llm import chat_hmm as C
    got = C.parse(table(spark, sf_dir, "conversations"))
    return got.select("conv_id", "turn", "role", "role_pred", "n_turns", "rendered")


@register("op11_crf_toxicity")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerscope.llm import toxicity_crf as T
    got = T.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return got.select("doc_id", "held_out", "score", "predicted", F.size("spans").alias("n_spans"),
                      F.expr("transform(spans, s -> s.start)").alias("span_starts"))


@register("op12_bidiagonal_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerscope.llm import whitening as W
    return W.whiten(table(spark, sf_dir, "embeddings"))


@register("op13_recursive_merkle", merkle.oracle())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.prove(table(spark, sf_dir, "documents"))
