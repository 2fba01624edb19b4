"""The operators' registered queries: each over the whole of its table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cumulus.llm import (
    chat,
    decontaminate,
    embeddings,
    host_rules,
    html_text,
    jaccard,
    periodic,
    pieces,
    quality,
    resample,
    secrets,
    token_counts,
    toxicity,
)
from cumulus.llm.common import bounded_batches


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_pieces(_table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.document_token_counts(_table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.fit_quality(docs, _table(spark, sf_dir, "labels")))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return secrets.secret_digest(secrets.scan_secrets(docs, secrets.fit_secrets(docs)))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(_table(spark, sf_dir, "pages"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model, _ = toxicity.fit_toxicity(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model)


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.collapse_and_render(_table(spark, sf_dir, "conversations"))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents"))


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.embedding_links(_table(spark, sf_dir, "embeddings"))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.judge_documents(_table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digest(periodic.periodic_runs(periodic.with_planted_runs(_table(spark, sf_dir, "documents"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sentencepiece,
        op2_token_counts,
        op3_quality,
        op4_secrets,
        op5_decontamination,
        op6_html,
        op7_toxicity,
        op8_chat,
        op9_jaccard,
        op10_embeddings,
        op11_resampling,
        op12_quality_rules,
        op13_periodic_runs,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op5_decontamination": decontaminate.ORACLE,
    "op8_chat": chat.ORACLE,
    "op10_embeddings": embeddings.ORACLE,
    "op11_resampling": resample.ORACLE,
    "op12_quality_rules": host_rules.ORACLE,
}
