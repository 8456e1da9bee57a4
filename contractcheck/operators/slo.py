"""Service levels: freshness, completeness, availability, accuracy, coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractcheck.functions.numbers import age_micros, fraction_to_percent, hours2, mean_pct2, ntz, pct2
from contractcheck.functions.text import stable_id
from contractcheck.operators.lookups import lookup_join, union_all
from contractcheck.schemas import SLO_METRICS, conform

# Thresholds used when an agreement gives none.
DEFAULT_FRESHNESS_HOURS = 24
DEFAULT_COMPLETENESS_PCT = 99.0
AVAILABILITY_PCT = 99.9
DEFAULT_TIMESTAMP_COLUMNS = ("created_at", "updated_at", "_updated_ts")

METRIC = ["metric_type", "expected_value", "actual_value", "status", "severity", "details"]


def _metric(
    df: DataFrame, name: str, expected: Column, actual: Column, status: Column, details: Column, keys: Sequence[str] = ()
) -> DataFrame:
    bad = "critical" if name == "availability" else "high"
    return df.select(
        *keys,
        F.lit(name).alias("metric_type"),
        expected.cast("double").alias("expected_value"),
        actual.cast("double").alias("actual_value"),
        status.alias("status"),
        F.when(status == "fail", bad).otherwise("info").alias("severity"),
        details.alias("details"),
    )


def newest(df: DataFrame, ts_columns: Sequence[str]) -> Column:
    """Latest moment over those candidate columns that exist; NULL without any."""
    present = [F.col(c).cast("timestamp_ntz") for c in ts_columns if c in df.columns]
    if not present:
        return F.lit(None).cast("timestamp_ntz")
    return F.max(F.greatest(*present) if len(present) > 1 else present[0])


def freshness(df: DataFrame, ts_columns: Sequence[str], max_hours: float, as_of: str) -> DataFrame:
    """Age of the newest row; equal to the limit still passes."""
    latest = df.agg(newest(df, ts_columns).alias("latest"))
    return _freshness(latest, F.lit(max_hours), as_of)


def _freshness(moments: DataFrame, max_hours: Column, as_of: str, keys: Sequence[str] = ()) -> DataFrame:
    """The level of each row's ``latest``."""
    age = hours2(age_micros(F.col("latest"), ntz(as_of)))
    limit = max_hours.cast("double")
    status = F.when(age.isNull(), "unknown").when(age <= limit, "pass").otherwise("fail")
    details = F.when(age.isNull(), F.lit("no timestamp found")).otherwise(
        F.concat(F.lit("latest data is "), age.cast("string"), F.lit(" hours old"))
    )
    return _metric(moments, "freshness", limit, age, status, details, keys)


def _scores() -> list[Column]:
    """What the mean share of a profile's required columns needs."""
    return [F.count("column_name").alias("columns"), F.count("non_null_bp").alias("scored"), F.sum("non_null_bp").alias("points")]


def completeness(profile: DataFrame, min_pct: float = DEFAULT_COMPLETENESS_PCT) -> DataFrame:
    """Mean non-null share of the required columns in ``profile``
    (:func:`contractcheck.operators.counters.null_profile`)."""
    return _completeness(profile.agg(*_scores()), F.lit(min_pct))


def _completeness(scores: DataFrame, min_pct: Column, keys: Sequence[str] = ()) -> DataFrame:
    """The level of each row's scores."""
    limit = fraction_to_percent(min_pct)
    none = F.col("columns") == 0
    actual = F.when(none, F.lit(100.0)).otherwise(mean_pct2(F.col("points"), F.col("scored")))
    status = (
        F.when(none | actual.isNull(), "unknown").when(actual >= limit, "pass").otherwise("fail")
    )
    details = F.when(none, F.lit("no required columns")).otherwise(
        F.concat(F.lit("mean over "), F.col("columns").cast("string"), F.lit(" required columns"))
    )
    return _metric(scores, "completeness", limit, actual, status, details, keys)


def availability(spark: SparkSession, path: str) -> DataFrame:
    """Whether a table can be read. A count needs only the file footers."""
    try:
        n, problem = spark.read.parquet(path).count(), None
    except Exception as exc:  # whatever makes the table unreadable is the finding
        n, problem = None, type(exc).__name__
    return _availability(spark.createDataFrame([(n, problem)], "n bigint, problem string"))


def _availability(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The level of each row's ``n``, the rows that were counted, or ``problem``."""
    ok = F.col("n").isNotNull()
    return _metric(
        counts,
        "availability",
        F.lit(AVAILABILITY_PCT),
        F.when(ok, 100.0).otherwise(0.0),
        F.when(ok, "pass").otherwise("fail"),
        F.when(ok, F.concat(F.lit("table is accessible with "), F.col("n").cast("string"), F.lit(" rows"))).otherwise(
            F.concat(F.lit("table not accessible: "), F.coalesce("problem", F.lit("not read")))
        ),
        keys,
    )


def levels(targets: DataFrame, counts: DataFrame, profile: DataFrame, as_of: str) -> DataFrame:
    """Freshness, completeness and availability of every agreement's model at once.

    ``targets`` comes from :func:`slo_targets`; ``counts`` holds a run's measures per table
    (:mod:`contractcheck.plans.shared_scan`) and ``profile`` the null shares of the required
    columns per table. A level asked for twice is measured once. Levels of a table that
    nobody could read are its availability alone.
    """
    keys = ["contract_id", "model_name"]
    facts = counts.filter(F.col("severity") == "table").groupBy(F.col("table_name").alias("model_name")).agg(
        F.max(F.when(F.col("check_type") == "table", F.col("rows_total"))).alias("n"),
        F.max(F.when(F.col("check_type") == "table", F.col("reason"))).alias("problem"),
        F.max("latest").alias("latest"),
    )
    scores = profile.groupBy(F.col("table_name").alias("model_name")).agg(*_scores())
    known = targets.join(facts, ["model_name"], "left")
    scored = known.join(scores, ["model_name"], "left").fillna({"columns": 0, "scored": 0})
    read = F.col("n").isNotNull()
    fresh = known.filter(read & F.col("freshness_slo_hours").isNotNull())
    full = scored.filter(read & F.col("completeness_slo").isNotNull())
    parts = [
        _freshness(fresh, F.col("freshness_slo_hours"), as_of, keys),
        _completeness(full, F.col("completeness_slo"), keys),
        _availability(known, keys),
    ]
    return union_all(parts).distinct()


def uptime(slo_metrics: DataFrame, target: float = 0.999) -> DataFrame:
    """Share of passing availability measurements per agreement."""
    limit = fraction_to_percent(F.lit(target))
    per = (
        slo_metrics.filter(F.col("metric_type") == "availability")
        .groupBy("contract_id")
        .agg(F.count(F.lit(1)).alias("measurements"), F.count_if(F.col("status") == "pass").alias("passing"))
    )
    actual = pct2(F.col("passing"), F.col("measurements"))
    return per.select(
        "contract_id",
        "measurements",
        "passing",
        actual.alias("uptime_pct"),
        F.when(actual >= limit, "pass").otherwise("fail").alias("status"),
    )


def reconcile(
    a: DataFrame, a_value: str | Column, b: DataFrame, b_value: str | Column, tolerance_pct: float = 0.01
) -> DataFrame:
    """Two sums agree within a tolerance.

    Whole numbers and decimals are summed as they are. So are doubles by the decimals they
    are written as, while 18 places and 20 digits before them hold them all; otherwise their
    sums are sums of doubles. Only the shown difference has two places, and all of them
    where it would show as nothing.
    """
    def parts(df: DataFrame, v: str | Column, name: str) -> DataFrame:
        rows = df.select((F.col(v) if isinstance(v, str) else v).alias("v"))
        value, floating = F.col("v"), isinstance(rows.schema["v"].dataType, T.FractionalType) and not isinstance(rows.schema["v"].dataType, T.DecimalType)
        exact = value.try_cast("decimal(38,18)") if floating else value
        lossless = F.coalesce(exact.cast("double") == value, value.isNull()) if floating else F.lit(True)
        sums = rows.agg(F.try_sum(exact).alias("exact"), F.min(lossless).alias("lossless"), F.sum(value.cast("double")).alias("rough"))
        held = sums.schema["exact"].dataType
        # One digit less keeps the scale of the difference.
        short = F.col("exact").try_cast(T.DecimalType(37, held.scale)) if isinstance(held, T.DecimalType) and held.precision > 37 else F.col("exact")
        return sums.select(F.when(F.col("lossless"), short).alias(name), F.col("rough").alias(f"{name}_rough"))

    # One row each.
    sums = parts(a, a_value, "a").crossJoin(parts(b, b_value, "b"))
    left, right = (F.coalesce(F.col(c).cast("double"), F.col(f"{c}_rough")) for c in "ab")
    gap = F.abs(F.col("a") - F.col("b"))
    apart = F.coalesce(gap.cast("double"), F.abs(left - right))
    status = F.when(apart.isNull(), "unknown").when(apart <= F.abs(right) * tolerance_pct / 100, "pass").otherwise("fail")
    short, tiny = gap.try_cast("decimal(38,2)"), (apart > 0) & (apart < 0.005)
    shown = F.when(tiny | short.isNull(), F.coalesce(gap.cast("string"), apart.cast("string"))).otherwise(short.cast("string"))
    return _metric(sums, "accuracy", right, left, status, F.concat(F.lit("difference "), shown))


def custom_metric(values: DataFrame, min_value: float) -> DataFrame:
    """Custom measurements judged against one lower limit each."""
    actual = F.col("actual_value")
    status = F.when(actual.isNull(), "unknown").when(actual >= min_value, "pass").otherwise("fail")
    return values.select(
        "metric_type",
        F.lit(min_value).cast("double").alias("expected_value"),
        actual.alias("actual_value"),
        status.alias("status"),
        F.when(status == "fail", "high").otherwise("info").alias("severity"),
        F.lit("custom query").alias("details"),
    )


def measured(metrics: DataFrame, contract_id: str | Column, as_of: str, model_name: str | Column = "") -> DataFrame:
    """Metric rows as they are appended to the ``slo_metrics`` log."""
    moment = ntz(as_of)
    contract, model = (F.lit(v) if isinstance(v, str) else v for v in (contract_id, model_name))
    key = (contract, model, F.col("metric_type"), F.col("expected_value"))
    rows = metrics.select(
        stable_id(*key, moment).alias("id"),
        contract.alias("contract_id"),
        *[c for c in METRIC if c != "details"],
        F.to_json(F.struct("details")).alias("measurement_details_json"),
        moment.alias("measurement_ts"),
        moment.alias("_inserted_ts"),
    )
    return conform(rows, SLO_METRICS)


def slo_targets(contracts: DataFrame, models: DataFrame, schemas: DataFrame | None = None) -> DataFrame:
    """Which levels apply to which model: distinct agreement and model pairs. With
    ``schemas`` only models of the schemas listed there count."""
    if schemas is not None:
        models = lookup_join(models, schemas.select("schema_name").distinct(), ["schema_name"], "left_semi", spread_by=["id"])
    names = contracts.select(F.col("id").alias("contract_id"), F.col("name").alias("contract_name")).distinct()
    wanted = models.select("contract_id", "model_name", "freshness_slo_hours", "completeness_slo")
    pairs = lookup_join(wanted, names, ["contract_id"], "inner", spread_by=["model_name"])
    return pairs.select(
        "contract_id", "contract_name", "model_name", "freshness_slo_hours", "completeness_slo"
    ).distinct()


def filled_targets(targets: DataFrame) -> DataFrame:
    """Levels an agreement leaves open are the common defaults; the others stay as written."""
    return targets.withColumns(
        {
            "freshness_slo_hours": F.coalesce("freshness_slo_hours", F.lit(DEFAULT_FRESHNESS_HOURS)),
            "completeness_slo": F.coalesce("completeness_slo", F.lit(DEFAULT_COMPLETENESS_PCT)),
        }
    )


def with_default_targets(targets: DataFrame) -> DataFrame:
    """The same with shares in percent."""
    return filled_targets(targets).withColumn("completeness_slo", fraction_to_percent(F.col("completeness_slo")))


def required_columns(columns: DataFrame, models: DataFrame) -> DataFrame:
    """Required columns per model name."""
    m = models.select(F.col("id").alias("model_id"), "model_name")
    needed = columns.filter("required_flag").select("model_id", "column_name")
    return lookup_join(needed, m, ["model_id"], "inner", spread_by=["column_name"]).select("model_name", "column_name").distinct()
