"""Read-side views over the registry and the logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contractcheck.functions.numbers import day_bounds, pct2
from contractcheck.operators.lookups import all_of


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key. Spark keeps one row per key in every input task before
    the shuffle, so a key with a long history costs one row per task."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def latest_by_max(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """As :func:`latest`, as an aggregate."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}") for c in rest]).select(*df.columns)


def latest_test_results(results: DataFrame) -> DataFrame:
    return latest(results, ["test_id"], ["run_timestamp", "id"]).select(
        "test_name", "model_name", "column_name", "status", "failure_message", "execution_time_ms", "run_timestamp"
    )


def contract_health(contracts: DataFrame, models: DataFrame, tests: DataFrame, results: DataFrame) -> DataFrame:
    """Per agreement: tests, their latest outcomes and the pass rate.

    Results shrink to the latest per test, then to counts per model, before they
    meet the registry.
    """
    now = latest(results.select("test_id", "status", "run_timestamp", "id"), ["test_id"], ["run_timestamp", "id"])
    state = tests.select(F.col("id").alias("test_id"), "model_id").join(now, ["test_id"], "left")
    per_model = state.groupBy("model_id").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col("status") == s).alias(s) for s in ("pass", "fail", "skipped")],
        F.max("run_timestamp").alias("last"),
    )
    owned = models.select(F.col("id").alias("model_id"), "contract_id").join(per_model, ["model_id"])
    per_contract = owned.groupBy("contract_id").agg(
        *[F.sum(c).alias(c) for c in ("n", "pass", "fail", "skipped")], F.max("last").alias("last_test_run")
    )
    base = contracts.select(F.col("id").alias("contract_id"), "name", "domain").distinct()
    joined = base.join(per_contract, ["contract_id"], "left")
    n = {c: F.coalesce(c, F.lit(0)) for c in ("n", "pass", "fail", "skipped")}
    return joined.select(
        "name",
        "domain",
        n["n"].alias("total_tests"),
        n["pass"].alias("passing_tests"),
        n["fail"].alias("failing_tests"),
        n["skipped"].alias("skipped_tests"),
        "last_test_run",
        pct2(n["pass"], n["n"]).alias("pass_rate"),
    )


def subscriber_readiness(subscribers: DataFrame) -> DataFrame:
    return subscribers.select(
        "subscriber_name", "ready_for_consumption", "ready_for_consumption_reason", "daily_slo_check_ts", "_updated_ts"
    ).orderBy(F.desc("_updated_ts"), "subscriber_name")


def find_results(
    results: DataFrame,
    model_name: str | None = None,
    test_type: str | None = None,
    status: str | None = None,
    day: str | None = None,
) -> DataFrame:
    wanted = {"model_name": model_name, "test_type": test_type, "status": status}
    conditions = [F.col(c) == v for c, v in wanted.items() if v is not None]
    if day:
        conditions.append(day_bounds(F.col("run_timestamp"), day))
        if "run_date" in results.columns:
            conditions.append(F.col("run_date") == F.lit(day).cast("date"))
    return results.filter(all_of(conditions))


def totals(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def run_summary(results: DataFrame, critical: Sequence[str] = ("unique", "not_null")) -> DataFrame:
    """Per run: passed, failed and skipped checks and a level, 2 when a check of a
    critical type failed, 1 for any other failure, 0 when clean."""
    failed = F.col("status").isin("fail", "error")
    counts = results.groupBy("run_id").agg(
        F.count_if(F.col("status") == "pass").alias("passed"),
        F.count_if(failed).alias("failed"),
        F.count_if(F.col("status").isin("skipped", "unknown")).alias("skipped"),
        F.count_if(failed & F.col("test_type").isin(*critical)).alias("critical_failed"),
    )
    level = F.when(F.col("critical_failed") > 0, 2).when(F.col("failed") > 0, 1).otherwise(0)
    return counts.withColumn("level", level)


def with_levels_and_rejects(
    summary: DataFrame, slos: DataFrame, rejects: DataFrame, run_id: str, as_of: str, quality: DataFrame | None = None
) -> DataFrame:
    """The summary of a run with its failed levels, quality issues and rejected documents.

    Adds ``slo_failed``, ``quality_failed`` and ``rejected`` and raises ``level``: 2 if a table
    was not available or an issue is critical, 1 for any other failed level, issue or rejected
    document. A run without any test still gives a row.
    """
    failed, moment = F.col("status") == "fail", F.lit(as_of).cast("timestamp_ntz")
    levels = slos.filter(F.col("measurement_ts") == moment).agg(
        F.count_if(failed).alias("slo_failed"), F.count_if(failed & (F.col("metric_type") == "availability")).alias("_gone")
    )
    if quality is None:
        issues = levels.select(F.lit(0).cast("bigint").alias("quality_failed"), F.lit(0).cast("bigint").alias("_critical"))
    else:
        issues = quality.filter(F.col("detected_at") == moment).agg(
            F.count_if(failed).alias("quality_failed"), F.count_if(failed & (F.col("severity") == "critical")).alias("_critical")
        )
    # One row each.
    other = levels.crossJoin(issues).crossJoin(rejects.agg(F.count(F.lit(1)).alias("rejected"))).withColumn("run_id", F.lit(run_id))
    both = other.join(summary, ["run_id"], "left")
    worst = (F.col("_gone") > 0) | (F.col("_critical") > 0)
    some = (F.col("slo_failed") > 0) | (F.col("quality_failed") > 0) | (F.col("rejected") > 0)
    raised = F.when(worst, 2).when(some, 1).otherwise(0)
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in summary.columns if c not in ("run_id", "level")]
    return both.select("run_id", *zero, "slo_failed", "quality_failed", "rejected", F.greatest(F.coalesce("level", F.lit(0)), raised).alias("level"))
