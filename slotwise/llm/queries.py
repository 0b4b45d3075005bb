"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from slotwise.llm import decontaminate, language, lengths, maintext, mixing, ngram, phrases, simhash, sketches, substring, tokens, toxicity, variants
from slotwise.llm.frames import original_id


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substring.remove_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.fingerprints(table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_digests(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    held_out = F.coalesce(toxicity.fold_of(F.col("doc_id")) == 1, F.lit(False)).alias("held_out")
    return rows.select("doc_id", held_out, "score", "predicted", "spans")


def op5_ngram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram.train_and_score(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op7_page_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.page_languages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op8_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lengths.limits(lengths.length_histogram(table(spark, sf_dir, "documents")))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mix(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"), "source", "times")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return rows.select(original_id(), digits, original_id("component_id"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.phrases(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"))


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintext.main_texts(table(spark, sf_dir, "pages"))


LLM_QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_fingerprints": op2_fingerprints,
    "op3_token_files": op3_token_files,
    "op4_toxicity": op4_toxicity,
    "op5_ngram_scores": op5_ngram_scores,
    "op6_decontamination": op6_decontamination,
    "op7_page_language": op7_page_language,
    "op8_length_histogram": op8_length_histogram,
    "op9_source_mixing": op9_source_mixing,
    "op10_simhash": op10_simhash,
    "op11_phrases": op11_phrases,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_main_text": op13_main_text,
}
