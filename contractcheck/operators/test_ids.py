"""Test-run results: which model and column a test belongs to, and log rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contractcheck.functions.numbers import ntz
from contractcheck.functions.text import (
    classify_test,
    column_after,
    guess_model,
    stable_id,
    strip_test_prefix,
    test_base_name,
)
from contractcheck.operators.lookups import lookup_join
from contractcheck.schemas import TEST_RESULTS, conform



def parse_test_ids(unique_ids: DataFrame, models: DataFrame | None = None) -> DataFrame:
    """``unique_id, test_name, test_type, model_name, column_name`` per distinct id.

    With a registry the longest registered model name wins: the words behind the
    test type are turned into candidate names and matched by equality. Ids that
    match nothing fall back to the naming convention.
    """
    base = _with_rest(unique_ids.select("unique_id").distinct())
    if models is None:
        known = base.withColumn("_known", F.lit(None).cast("string"))
    else:
        words = F.split("_rest", "_")
        sizes = F.sequence(F.lit(1), F.size(words))
        names = F.transform(sizes, lambda n: F.array_join(F.slice(words, F.lit(1), n), "_"))
        # Outer, so that no emptiness test of the names is pushed below the distinct.
        options = base.select("unique_id", F.explode_outer(names).alias("model_name"))
        registered = models.select("model_name").distinct()
        hits = lookup_join(options, registered, ["model_name"], "inner", spread_by=["unique_id"])
        best = hits.groupBy("unique_id").agg(F.max_by("model_name", F.length("model_name")).alias("_known"))
        known = base.join(best, ["unique_id"], "left")
    return _named(known).select("unique_id", "test_name", "test_type", "model_name", "column_name")


def _with_rest(ids: DataFrame) -> DataFrame:
    """Add the test name and the words behind its test type."""
    named = ids.withColumn("test_name", test_base_name(F.col("unique_id")))
    dotted = F.size(F.split("unique_id", r"\.")) >= 3
    return named.withColumn("_rest", F.when(dotted, strip_test_prefix(F.col("test_name"))))


def _named(known: DataFrame) -> DataFrame:
    """Type, model and column from the words and the registered model, if any."""
    model = F.coalesce("_known", guess_model(F.col("_rest")))
    return known.withColumns(
        {
            "test_type": classify_test(F.col("test_name")),
            "model_name": F.coalesce(model, F.lit("unknown")),
            "column_name": column_after(F.col("_rest"), model),
        }
    )


def denormalise_results(
    results: DataFrame, run_id: str, as_of: str, models: DataFrame | None = None, configured_by: str = "test_run"
) -> DataFrame:
    """Log rows for test results, one per result. Without a registry the names come
    from the identifiers alone and no row is shuffled."""
    if models is None:
        rows = _named(_with_rest(results).withColumn("_known", F.lit(None).cast("string")))
    else:
        rows = lookup_join(results, parse_test_ids(results, models), ["unique_id"], "left")
    failed = (F.col("status") == "fail") & (F.col("failures") > 0)
    moment = ntz(as_of)
    log = rows.select(
        stable_id(F.lit(run_id), F.col("unique_id"), moment).alias("id"),
        F.lit(run_id).alias("run_id"),
        F.col("unique_id").alias("test_id"),
        "model_name",
        "column_name",
        "test_name",
        "test_type",
        F.coalesce("status", F.lit("unknown")).alias("status"),
        F.nullif("message", F.lit("")).alias("failure_message"),
        F.when(failed, F.col("failures")).alias("rows_affected"),
        (F.coalesce("execution_time", F.lit(0.0)) * 1000).cast("bigint").alias("execution_time_ms"),
        F.nullif(F.col("compiled_code"), F.lit("")).alias("compiled_sql"),
        moment.alias("run_timestamp"),
        F.lit(configured_by).alias("configured_by"),
        moment.alias("_inserted_ts"),
    )
    return conform(log, TEST_RESULTS)


def enrich_contract(results: DataFrame, models: DataFrame) -> DataFrame:
    """Fill ``contract_id`` from the registry; a model registered by its agreement
    wins over one registered by its definition file."""
    owner = (
        models.filter(F.col("contract_id").isNotNull())
        .groupBy("model_name")
        .agg(F.min_by("contract_id", F.struct((F.col("id") != F.col("contract_id")).cast("int"), "id")).alias("_cid"))
    )
    spread = [c for c in ("id", "test_id") if c in results.columns] or None
    joined = lookup_join(results, owner, ["model_name"], "left", spread_by=spread)
    cols = [
        F.coalesce("contract_id", "_cid").alias(c) if c == "contract_id" else F.col(c) for c in results.columns
    ]
    return joined.select(*cols)
