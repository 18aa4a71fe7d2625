"""The operators applied to the whole tables, with the parameters of their contracts."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plaudit.llm import (
    binary, codes, contamination, language, manifest, packing, quality, rules, simhash, substring, suffix, tokens, toxicity)
from plaudit.llm.rows import fold

DOC_ID = "doc.doc_id"  # an operator's rows hold the document in one column


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the folds 0 and 2 of 3."""
    docs, held_out = table(spark, sf_dir, "documents"), fold("doc_id", 3).eqNullSafe(1)
    model = toxicity.fitted(docs, table(spark, sf_dir, "labels").filter(~held_out))
    return _judged(toxicity.scored(docs, model), held_out)


def _judged(rows: DataFrame, held_out) -> DataFrame:
    return rows.select(DOC_ID, "score").select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left after later copies of 13-word passages are taken out."""
    rows = substring.without_repeats(table(spark, sf_dir, "documents"))
    return rows.select(DOC_ID, "n_words", "n_removed",
                       F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return packing.sequences(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain benchmark passages."""
    rows = contamination.searched(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select(DOC_ID, "n_words", "n_hit", "n_items",
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                       contaminated().alias("contaminated"))


def contaminated():
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes left after every copy of a repeated 400-byte string is taken out."""
    rows = suffix.without_repeats(table(spark, sf_dir, "documents"))
    return rows.select(DOC_ID, "n_bytes", "n_removed",
                       F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the folds 0 and 2 of 3."""
    docs, held_out = table(spark, sf_dir, "documents"), fold("doc_id", 3).eqNullSafe(1)
    rows = language.identified(docs, language.fitted(docs.filter(~held_out)))
    return rows.select(DOC_ID, "lang_pred", "score").select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the folds 0, 1 and 3 of 4."""
    docs, held_out = table(spark, sf_dir, "documents"), fold("doc_id", 4).eqNullSafe(2)
    model = quality.fitted(docs, table(spark, sf_dir, "labels").filter(~held_out))
    return _judged(quality.scored(docs, model), held_out)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    rows = tokens.counted(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))
    return rows.select(DOC_ID, "n_bytes", "n_tokens",
                       (F.col("n_tokens") > 4096).alias("over_limit"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    rows = rules.judged(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                       "kept")


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    rows = simhash.near_copies(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors, 8 parts with 16 entries each after 6 rounds."""
    found = codes.coded(table(spark, sf_dir, "embeddings"), carry=["label"])
    rows = codes.with_label_error(found.rows, "label")
    return rows.select("doc.vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
                       F.sha2(F.lit(codes.listed(found.entries)), 256).alias("codebooks_sha256"))


def op12_binary_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids in bit-packed files, and what is read back from them."""
    files = binary.written(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))
    return binary.documents(spark, files).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of the documents, a proof for each, and the root that the proof leads to after some have been changed."""
    own, others = F.col("text"), [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    changed = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.when(fold("doc_id", 3) == 0, manifest.row_digest(*others, changed))
    leaves = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", manifest.row_digest(*others, own).alias("leaf"), tampered.alias("tampered"))
    tree = manifest.built(leaves, "leaf", carry=["tampered"])
    rows = manifest.proven(tree, tree.leaves)
    return rows.select(
        DOC_ID, F.col("digest").alias("leaf"), "subroot", F.lit(tree.root).alias("root"),
        F.sha2(manifest.siblings(F.col("path")), 256).alias("proof_sha256"),
        manifest.folded(F.coalesce("doc.tampered", "digest"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


LLM_QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_substring_dedup, op3_packing, op4_benchmark_decontamination, op5_suffix_array_dedup,
    op6_language_id, op7_quality_classifier, op8_token_counts, op9_quality_rules, op10_simhash_near_dedup, op11_vector_codes,
    op12_binary_tokens, op13_merkle_manifest)}
