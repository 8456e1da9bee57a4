"""From raw documents to a training mix: the stages and how they follow each other.

Each stage reads what its predecessor wrote. All but the last return rows with the
columns of ``documents``; the last adds ``size`` and ``copies``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from contractcheck.llm import decontaminate, mixing, ngram_join, pii, quality_model

#: No SQL can express the trained classifiers; tests compare each stage with brute force.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier keeps."""
    return quality_model.kept(docs)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.one_per_group(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of the benchmark; texts that are mostly benchmark go."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), length_col="n_chars")


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return pii.redacted(docs, length_col="n_chars")


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes and how often."""
    return mixing.mixed(docs)


STAGES = [
    ("quality_classifier", quality_stage),
    ("ngram_jaccard_join", near_copies_stage),
    ("benchmark_decontamination", benchmark_stage),
    ("pii", pii_stage),
    ("mixing", mix_stage),
]


def shared_folder(spark: SparkSession) -> str:
    """Where stages hand over: the session's checkpoint folder, else the warehouse."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    root = f"{shared_folder(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        at = f"{root}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
    return docs
