"""Registered queries: each operator with production parameters on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lineside.llm import (
    decontamination, language_id, licenses, line_dedup, minhash, oracles, packing, pii, quality_classifier, quality_rules,
    ranked_search, secret_scan, spelling, token_files)
from lineside.llm.common import ship

PREDICTED_FROM = 0.3


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def held_out() -> Column:
    """Rows that no label is learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").where(~held_out()).select("doc_id", F.col("quality").alias("label"))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality_classifier.fit(docs, training_labels(spark, sf_dir))
    return quality_classifier.scored(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= PREDICTED_FROM).cast("int").alias("predicted"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summary(documents(spark, sf_dir))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), k=2, percent=80)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_path(), end_id=1, capacity=4096)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.remove_common(documents(spark, sf_dir))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(spark, documents(spark, sf_dir), tokenizer_path(), end_id=2)


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The table names no repository: every document stands for one, and its source for their owner.
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return secret_scan.summary(docs, owner=F.col("source"), repository=F.col("doc_id"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir), least_length=5, least_n=3, noise=97)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"), k=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_quality_classifier, op2_decontamination, op3_quality_rules, op4_personal_data, op5_near_duplicates, op6_packing,
        op7_language_id, op8_license_scan, op9_line_dedup, op10_token_files, op11_secret_scan, op12_spelling_variants, op13_ranked_search)
}
ORACLES: dict[str, str] = {
    "op5_near_duplicates": oracles.NEAR_DUPLICATES, "op11_secret_scan": oracles.SECRETS,
    "op12_spelling_variants": oracles.SPELLING, "op13_ranked_search": oracles.SEARCH,
}
