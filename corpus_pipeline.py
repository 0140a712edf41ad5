"""Corpus pipeline: stages over ``documents``, each written as Parquet and read again.

Each stage works on all rows its predecessor kept, and all but the last return
the columns they were given. Null texts have no words and fail the quality
rules; rows that share an id are kept or dropped as near-duplicates together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm.minhash import near_duplicates
from tributary.llm.packing import pack
from tributary.llm.quality import quality_filter
from tributary.llm.secrets import redacted
from tributary.llm.store import fresh_name, written
from tributary.llm.tiling import drop_contaminated
from tributary.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules (operator 6)."""
    return quality_filter(docs)


# Similarity, in percent, from which the stage holds documents for near-duplicates.
NEAR_PERCENT = 80


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of smallest id, of each group of near-duplicates (operator 1)."""
    name = fresh_name("kept_id", docs)
    kept = near_duplicates(docs, percent=NEAR_PERCENT).where("kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col(name)), "left_semi")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages (operator 5)."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark (operator 2); n_chars follows the text."""
    out = redacted(docs, scratch_path(spark, "secret-ledger"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in bins (operator 4)."""
    return pack(docs)


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("secret_scan", secret_scan), ("best_fit_packing", best_fit_packing)]

# Suffix arrays, MinHash components and best-fit packing have no SQL form; tests
# hold the pipeline against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
