"""Run artifacts, seed files, data tables and their columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractcheck.operators.lookups import union_all

ARTIFACT_SCHEMA = (
    "results array<struct<resource_type:string, unique_id:string, status:string, message:string,"
    " execution_time:double, compiled_code:string, failures:bigint>>"
)

SEED_SCHEMAS = {
    "accounts": "account_id string, account_name string, account_type string, account_status string,"
    " customer_id string, balance_usd decimal(18,2), currency_code string, last_transaction_date string,"
    " opened_date string, closed_date string",
    "publishers": "publisher_id string, publisher_name string, publisher_type string, publisher_contact string",
    "subscribers": "subscriber_id string, subscriber_name string, subscriber_type string, subscriber_contact string",
    "slo_metrics": "slo_id string, contract_id string, metric_name string, metric_value double, metric_timestamp string",
}


def read_artifact(spark: SparkSession, path: str) -> DataFrame:
    """Test-run results, one row each; a broken or empty file gives none."""
    raw = spark.read.schema(ARTIFACT_SCHEMA).json(path, multiLine=True)
    return raw.select(F.inline("results"))


def only_tests(results: DataFrame) -> DataFrame:
    """Result rows of tests, also when the artifact leaves the kind out."""
    return results.filter((F.col("resource_type") == "test") | F.col("unique_id").startswith("test."))


def read_seed(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema(SEED_SCHEMAS[name]).csv(path, header=True, emptyValue="")


def publishers_from_seed(seed: DataFrame) -> DataFrame:
    return seed.select(
        F.col("publisher_id").alias("id"),
        "publisher_type",
        F.col("publisher_name").alias("name"),
        F.to_json(F.struct(F.col("publisher_contact").alias("contact"))).alias("config_json"),
    )


def subscribers_from_seed(seed: DataFrame, watch_lists: Mapping[str, str]) -> DataFrame:
    """``watch_lists`` gives the JSON list of watched agreements per subscriber id."""
    lists = F.lit(None).cast("string")
    for sub, text in watch_lists.items():
        lists = F.when(F.col("subscriber_id") == sub, F.lit(text)).otherwise(lists)
    return seed.select(
        F.col("subscriber_id").alias("id"),
        "subscriber_name",
        F.col("subscriber_contact").alias("email"),
        lists.alias("watching_contract_ids_json"),
    )


def slo_metrics_from_seed(seed: DataFrame) -> DataFrame:
    moment = F.regexp_replace("metric_timestamp", "Z$", "")
    return seed.select(
        F.col("slo_id").alias("id"),
        "contract_id",
        F.col("metric_name").alias("metric_type"),
        F.col("metric_value").alias("actual_value"),
        moment.cast("timestamp_ntz").alias("measurement_ts"),
    )


def table_columns(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, pos, column_name, data_type`` from the schemas; reads no data."""
    rows = [
        (name, i, f.name, f.dataType.simpleString())
        for name, df in tables.items()
        for i, f in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(rows, "table_name string, pos int, column_name string, data_type string")


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def run_metrics(spark: SparkSession, statements: Mapping[str, str]) -> DataFrame:
    """Custom measurements: each statement gives one ``actual_value``."""
    frames = [
        spark.sql(text.rstrip().rstrip(";")).select(
            F.lit(name).alias("metric_type"), F.col("actual_value").cast("double").alias("actual_value")
        )
        for name, text in statements.items()
    ]
    if not frames:
        return spark.createDataFrame([], "metric_type string, actual_value double")
    return union_all(frames)


def fused_metrics(spark: SparkSession, statements: Mapping[str, str]) -> DataFrame:
    """:func:`run_metrics` with each statement as a scalar subquery of one row.

    Catalyst merges subqueries that are plain aggregates over the same rows of a table,
    so any number of them reads the table once; conditions belong into the aggregates
    (``count_if``, ``FILTER``) rather than into ``WHERE`` for that. Other statements run
    on their own. A statement without a row gives NULL, one with several rows fails.
    """
    if not statements:
        return run_metrics(spark, statements)
    pairs = [
        f"{sql_text(name)}, (SELECT CAST(actual_value AS DOUBLE) FROM (\n{text.rstrip().rstrip(';')}\n))"
        for name, text in statements.items()
    ]
    return spark.sql(f"SELECT stack({len(pairs)}, {', '.join(pairs)}) AS (metric_type, actual_value)")


def sql_text(value: str) -> str:
    """A string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def metric_queries(spark: SparkSession, path: str, fused: bool = False) -> DataFrame:
    """:func:`run_metrics`, or :func:`fused_metrics`, for the ``*.sql`` files of a folder.
    Only the statements' text comes to the driver."""
    files = (
        spark.read.option("pathGlobFilter", "*.sql")
        .text(path, wholetext=True)
        .select(F.col("_metadata.file_name").alias("name"), "value")
    )
    statements = {r.name.removesuffix(".sql"): r.value for r in files.orderBy("name").collect()}
    return fused_metrics(spark, statements) if fused else run_metrics(spark, statements)
