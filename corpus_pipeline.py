"""A corpus pipeline of five stages over ``documents``, each on all that its predecessor kept.

Every stage but the last returns the columns of ``documents``:

1. ``quality``: documents that the ordinal classifier rejects go;
2. ``near_duplicates``: of each group of documents linked by a five-word Jaccard of 0.8 or more the one with the
   smallest id stays (one without an id only where none has one);
3. ``decontamination``: documents with a benchmark window go;
4. ``secrets``: secret spans are replaced by a mark (``n_chars`` follows the text);
5. ``sentencepiece``: ids of the texts that are left.

Null texts count as empty; documents are told apart by id and text, so rows
without an id and texts under one id are judged each for itself; rows repeated
in both stay or go together; columns of any name may come along; empty tables
give empty results.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cumulus.llm import decontaminate, jaccard, pieces, quality, secrets
from cumulus.llm.common import bounded_batches, scratch_table
from cumulus.operators.joins import bounded_broadcast
from cumulus.session import scratch_path

MAX_BROADCAST_IDS = 500_000
NEAR_WORDS, NEAR_PERCENT = 5, 80  # near copies: five-word shingles, Jaccard 0.8 or more


def _without(docs: DataFrame, key: Column, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``key`` is not in the one column of ``gone``."""
    gone = bounded_broadcast(gone, MAX_BROADCAST_IDS)
    return docs.join(gone, key == gone[gone.columns[0]], "left_anti")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.select_quality(docs, quality.fit_quality(docs, labels))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    # Documents are told apart by id and text, so that ids may repeat or be missing.
    key = F.xxhash64(docs["doc_id"].isNull(), docs["doc_id"], docs["text"])
    keyed = docs.select(key.alias("near_key"), docs["doc_id"].alias("near_id"), docs["text"].alias("near_text"))
    told = scratch_table(jaccard.jaccard_components(keyed, "near_key", "near_text", NEAR_PERCENT, NEAR_WORDS), "near")
    several = told.filter("doc_id <> component_id").select("component_id").distinct()
    members = told.join(bounded_broadcast(several, MAX_BROADCAST_IDS), "component_id", "left_semi")
    members = members.join(keyed.select("near_key", "near_id"), F.col("doc_id") == F.col("near_key"))
    order = F.struct(F.col("near_id").isNull().alias("without_id"), "near_id", "near_key")
    first = members.groupBy("component_id").agg(F.min(order)["near_key"].alias("kept_key"))
    gone = members.join(first, "component_id").filter("near_key <> kept_key").select("near_key").distinct()
    return _without(docs, key, scratch_table(gone, "near"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contamination(docs, benchmark, with_hash=True).filter("contaminated")
    gone = bounded_broadcast(found.select("doc_id", "text_hash"), MAX_BROADCAST_IDS)
    same = docs["doc_id"].eqNullSafe(gone["doc_id"]) & (decontaminate.text_key(docs["text"]) == gone["text_hash"])
    return docs.join(gone, same, "left_anti")


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    clean = secrets.redact(docs, secrets.fit_secrets(docs))
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return pieces.encode_pieces(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("sentencepiece", sentencepiece_stage),
]

ORACLE_SQL = None  # classifiers and tokenisers are not SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}-{uuid.uuid4().hex}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
