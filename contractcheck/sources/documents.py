"""Agreement and model-definition files as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractcheck.functions.text import yaml_to_json
from contractcheck.operators.contracts import REQUIRED_KEYS

YAML_FILES = "*.{yaml,yml}"


def read_text_files(spark: SparkSession, path: str, pattern: str = YAML_FILES) -> DataFrame:
    """One row per file below ``path``: ``source_path, text``.

    Spark's readers have no row for a file of zero bytes, but list it; it gets an empty text.
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    files = reader.text(path, wholetext=True)
    texts = files.select(F.col("_metadata.file_path").alias("source_path"), F.col("value").alias("text"))
    # A local path is listed as file:///x and read as file:/x.
    listed = spark.createDataFrame([(f.replace(":///", ":/"),) for f in files.inputFiles()], "source_path string")
    return listed.join(texts, ["source_path"], "left").select("source_path", F.coalesce("text", F.lit("")).alias("text"))


def parse_documents(files: DataFrame) -> DataFrame:
    """``source_path, content, parse_error``: the document as JSON text, or why not.

    Parsing costs about a millisecond per document and moving its text almost
    nothing, so the documents are spread over all cores first.
    """
    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parsed = files.repartition(tasks, "source_path").select("source_path", yaml_to_json("text").alias("_doc"))
    return parsed.select("source_path", "_doc.content", "_doc.parse_error")


def parse_changed(files: DataFrame, known: DataFrame) -> DataFrame:
    """``source_path, digest, content, parse_error`` of all files, parsing only new and changed ones.

    ``known`` is what an earlier call returned. A file whose text has the digest recorded
    under its path keeps its parsed document; those that could not be read then are tried
    again, and files that are gone have no row.
    """
    hashed = files.withColumn("digest", F.sha2("text", 256))
    parsed = known.filter(F.col("content").isNotNull()).select("source_path", "digest", "content").withColumn("_known", F.lit(True))
    judged = hashed.join(parsed, ["source_path", "digest"], "left")
    kept = judged.filter("_known").select("source_path", "digest", "content", F.lit(None).cast("string").alias("parse_error"))
    changed = judged.filter(F.col("_known").isNull())
    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fresh = changed.repartition(tasks, "source_path").select("source_path", "digest", yaml_to_json("text").alias("_doc"))
    return kept.unionAll(fresh.select("source_path", "digest", "_doc.content", "_doc.parse_error"))


def read_contracts(spark: SparkSession, path: str) -> DataFrame:
    """Every agreement file below ``path``, good or bad."""
    return parse_documents(read_text_files(spark, path))


def split_contracts(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable documents, and rejected ones with a reason. A document needs all
    mandatory top-level keys."""
    missing = F.array_except(
        F.array(*[F.lit(k) for k in REQUIRED_KEYS]),
        F.coalesce(F.json_object_keys("content"), F.array().cast("array<string>")),
    )
    judged = documents.withColumn(
        "reject_reason",
        F.when(F.col("content").isNull(), F.col("parse_error")).when(
            F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ", "))
        ),
    )
    good = judged.filter(F.col("reject_reason").isNull()).select("source_path", "content")
    return good, judged.filter(F.col("reject_reason").isNotNull()).select("source_path", "reject_reason")


def read_model_definitions(spark: SparkSession, path: str) -> DataFrame:
    """One row per model: ``source_path, content``. Unreadable files give no rows."""
    return explode_models(parse_documents(read_text_files(spark, path)))


def explode_models(documents: DataFrame) -> DataFrame:
    models = F.from_json("content", "models array<string>").getField("models")
    return documents.select("source_path", F.explode_outer(models).alias("content")).filter(F.col("content").isNotNull())
