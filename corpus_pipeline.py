"""Five stages from raw documents to encoded ones; each takes all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.llm import byte_bpe, decontaminate, near_dedup, pii, quality
from wattledger.llm.common import Run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents scored 0.5 or more by a model of the labels of ``sf_dir``; rows that are
    equal, or have no doc_id, are scored like any others."""
    weights = quality.train(docs.select("doc_id", "text"), _table(spark, sf_dir, "labels"))
    # Columns by place: whatever their names, none meets that of the score.
    text = docs.columns.index("text")
    apart = docs.toDF(*["text" if i == text else f"c{i}" for i in range(len(docs.columns))])
    return quality.score(apart, weights).filter("score >= 0.5").drop("score").toDF(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each class of near duplicates (Jaccard
    0.8 on five-word shingles), and one of repeated rows; rows without doc_id all stay."""
    classes = near_dedup.near_duplicates(docs.select("doc_id", "text"), Run(spark, "near"))
    gone = classes.filter(~F.col("kept")).select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    named = kept.filter("doc_id is not null").dropDuplicates(["doc_id", "text"])
    return named.union(kept.filter("doc_id is null"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a share of 1 in 20 words or more inside 13-word benchmark passages."""
    judged = decontaminate.contamination(docs.select("doc_id", "text"), _table(spark, sf_dir, "benchmark"), Run(spark, "clean"))
    gone = judged.filter("contaminated and doc_id is not null").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind and renews n_chars; every document stays."""
    run = Run(spark, "pii")
    clean = pii.redacted(docs, pii.learned(docs, run), run)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the digest of the decoded bytes, for every document."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    decoded = byte_bpe.encode(docs.select("doc_id", "text"), path, decoded=True)
    return decoded.select("doc_id", F.expr("cast(length(ids) div 4 as long)").alias("n_tokens"), "ids", F.sha2("bytes", 256).alias("decoded_sha256"))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("personal_data", personal_data_stage),
    ("encoding", encoding_stage),
]

#: No stage can be put in SQL as a whole; tests hold each against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored as Parquet and read again by the next."""
    tables = Run(spark, "pipeline")
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = tables.store(stage(spark, docs, sf_dir), name)
    return docs
