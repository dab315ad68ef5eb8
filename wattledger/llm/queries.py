"""One query per operator, with its production parameters, over its whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.llm import alignment, byte_bpe, decontaminate, fingerprints, licenses, merkle, near_dedup, pii, quality, substring_dedup, token_store, toxicity, vector_dedup
from wattledger.llm.common import Run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_quality_classifier(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = quality.train(docs, _table(spark, sf_dir, "labels"))
    scored = quality.score(docs, weights).drop("text")
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op2_token_store(spark, sf_dir):
    docs, run = _table(spark, sf_dir, "documents").select("doc_id", "text"), Run(spark, "op2")
    folder = f"{run.folder}/store"
    token_store.write(docs, folder, run, public_tokenizers.path("byte_bpe_50k.json"))
    return token_store.read(spark, folder).select(
        "doc_id", "start", F.expr("cast(length(ids) div 4 as long)").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op3_noisy_or_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"), "sentences")


def op4_bootstrapped_pii(spark, sf_dir):
    docs, run = _table(spark, sf_dir, "documents").select("doc_id", "text"), Run(spark, "op4")
    spans = pii.extract(docs, pii.learned(docs, run), run).drop("text")
    counts = [F.size(F.expr(f"filter(base, s -> s.kind = '{k}')")).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return spans.select("doc_id", *counts, F.sha2(pii.joined("base").cast("binary"), 256).alias("base_sha256"), pii.joined("base", "found").alias("spans"))


def op5_byte_level_bpe(spark, sf_dir):
    docs, path = _table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    decoded = byte_bpe.encode(docs, path, decoded=True)
    return decoded.select(
        "doc_id", F.expr("cast(length(ids) div 4 as long)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


def op6_rotated_codes(spark, sf_dir):
    return vector_dedup.near_vectors(_table(spark, sf_dir, "embeddings"), Run(spark, "op6"))


def op7_circulant_minhash(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dedup.near_duplicates(docs, Run(spark, "op7"), size=3, percent=85)


def op8_winnowing(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.contamination(docs, _table(spark, sf_dir, "benchmark"), Run(spark, "op8"))


def op9_blockwise_suffixes(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = substring_dedup.without_repeats(docs, Run(spark, "op9"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_license_automaton(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs).drop("spans")


def op11_improbable_features(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = fingerprints.edits(docs, fingerprints.ranking(fingerprints.class_counts(docs)))
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op12_merkle_manifest(spark, sf_dir):
    docs, run = _table(spark, sf_dir, "documents"), Run(spark, "op12")
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    rows = merkle.build(docs, run, tampered=F.when(chosen, merkle.leaf(text=lower))).proofs()
    folded = merkle.folded(F.coalesce("tampered", "digest"), F.col("path"))
    found = rows.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_lockstep_alignment(spark, sf_dir):
    docs, paths = _table(spark, sf_dir, "documents").select("doc_id", "text"), [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment.align(docs, Run(spark, "op13"), *paths)


QUERIES = {f.__name__: f for f in (op1_quality_classifier, op2_token_store, op3_noisy_or_toxicity, op4_bootstrapped_pii, op5_byte_level_bpe, op6_rotated_codes, op7_circulant_minhash, op8_winnowing, op9_blockwise_suffixes, op10_license_automaton, op11_improbable_features, op12_merkle_manifest, op13_lockstep_alignment)}
ORACLES: dict[str, str] = {}
