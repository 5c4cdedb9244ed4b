"""A training corpus in five stages: quality, repeated lines, near-duplicates, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir), works on all documents that the stage before kept, and all but the last return
the columns of ``documents``. Rows with one ``doc_id`` are one document. Empty tables pass through as empty ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineside.llm import catalog, decontamination, line_dedup, minhash, packing, quality_classifier
from lineside.llm.common import settle, ship, without


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = quality_classifier.fit(docs, catalog.training_labels(spark, sf_dir))
    kept = quality_classifier.scored(docs, model).where(F.col("score") >= catalog.PREDICTED_FROM)
    return kept.select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of lines that an earlier document has go; a document that loses all its text goes with them."""
    ship(spark)
    left = line_dedup.remove_common(docs).where("n_removed = 0 OR trim(text) <> ''")
    changed = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", changed).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    ship(spark)
    return without(docs, minhash.near_duplicates(docs, k=5, percent=80).where("NOT kept"))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    hits = decontamination.contaminated(docs, catalog.table(spark, sf_dir, "benchmark"))
    return decontamination.without_contaminated(docs, hits)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences."""
    ship(spark)
    return packing.pack(docs, catalog.tokenizer_path(), end_id=1, capacity=4096)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("best-fit packing", packed),
]
# The classifier, the alignment and the packing have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage; what each one returns is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name.split()[0].lower()}")
    return docs
