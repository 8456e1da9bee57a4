"""Value-level checks that report groups instead of one count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType

from contractcheck.functions.numbers import age_micros, hours2, ntz, whole_div
from contractcheck.functions.text import quote_name
from contractcheck.operators.counters import Check, failing_rows
from contractcheck.operators.lookups import lookup_join
from contractcheck.operators.ordered import with_prior


def check_accepted(df: DataFrame, column: str, values: Sequence, negate: bool = False) -> DataFrame:
    """Each value outside the list (or inside it, for a deny list) and its rows."""
    kind = "not_accepted_values" if negate else "accepted_values"
    bad = failing_rows(Check(column, kind, {"values": list(values)}))
    return df.filter(bad).groupBy(F.col(quote_name(column)).alias("value")).agg(F.count(F.lit(1)).alias("rows_failed"))


def check_expression(df: DataFrame, expression: str) -> DataFrame:
    """Rows for which the expression is false; NULL does not fail."""
    return df.filter(~F.expr(expression))


def recency(df: DataFrame, ts: str, max_hours: int, as_of: str) -> DataFrame:
    """Whether the newest row is at most ``max_hours`` old."""
    newest = df.agg(F.max(ts).alias("latest"))
    age = hours2(age_micros(F.col("latest"), ntz(as_of)))
    return newest.select(
        "latest",
        age.alias("age_hours"),
        F.when(age.isNull(), "unknown").when(age <= max_hours, "pass").otherwise("fail").alias("status"),
    )


def type_family(declared: str | DataType) -> str:
    """Coarse type used when a declared type is compared to a real one."""
    name = declared.simpleString() if isinstance(declared, DataType) else str(declared).strip().lower()
    base = name.split("(")[0].split("<")[0]
    # Names that mean the same family.
    families = {
        "integer": ("tinyint", "smallint", "int", "integer", "bigint", "long", "short", "byte"),
        "float": ("float", "double", "real"),
        "decimal": ("decimal", "numeric", "number"),
        "string": ("string", "varchar", "char", "text"),
        "timestamp": ("timestamp", "timestamp_ntz", "timestamp_ltz", "datetime"),
        "boolean": ("boolean", "bool"),
    }
    for family, names in families.items():
        if base in names:
            return family
    return base


def type_matches(declared: str, actual: DataType) -> bool:
    """Same family; a decimal must also have room for the declared digits."""
    if type_family(declared) != type_family(actual):
        return False
    if isinstance(actual, DecimalType) and "(" in declared:
        precision, scale = (int(x) for x in declared.split("(")[1].rstrip(") ").split(","))
        return actual.scale >= scale and actual.precision - actual.scale >= precision - scale
    return True


def group_quantiles(
    df: DataFrame, group_by: Sequence[str], value: str, percents: Sequence[int], slices: int | None = None
) -> DataFrame:
    """Exact interpolated percentiles per group.

    Values are counted first, then ranked with carried running counts, so a group
    is never held in one task as a built-in exact percentile would.
    """
    counts = (
        df.filter(F.col(value).isNotNull()).groupBy(*group_by, value).agg(F.count(F.lit(1)).alias("_n"))
    )
    ranked = with_prior(
        counts, group_by, [value], sums={"_before": F.col("_n")}, totals=["_before"], slices=slices, cuts_from=df
    )
    first, total = F.coalesce("_before", F.lit(0)), F.col("total__before")
    picks = []
    for p in percents:
        scaled = (total - 1) * p
        low, rest = whole_div(scaled, F.lit(100)), scaled % 100
        high = F.when(rest > 0, low + 1).otherwise(low)

        def at(rank):
            return F.max(F.when((rank >= first) & (rank < first + F.col("_n")), F.col(value)))

        picks += [at(low).alias(f"_lo{p}"), at(high).alias(f"_hi{p}"), F.max(rest).alias(f"_r{p}")]
    wide = ranked.groupBy(*group_by).agg(F.sum("_n").alias("n_values"), *picks)
    return wide.select(
        *group_by,
        "n_values",
        *[
            (F.col(f"_lo{p}") + (F.col(f"_hi{p}") - F.col(f"_lo{p}")) * (F.col(f"_r{p}") / F.lit(100.0))).alias(f"p{p}")
            for p in percents
        ],
    )


def outliers_iqr(
    df: DataFrame, group_by: Sequence[str], value: str, factor: float = 1.5, approx: bool = False
) -> DataFrame:
    """Per group: quartile fences and the rows outside them. ``approx`` swaps the
    exact quartiles for a sketch."""
    if approx:
        marks = F.percentile_approx(value, F.array(F.lit(0.25), F.lit(0.75))).alias("_q")
        quart = (
            df.groupBy(*group_by)
            .agg(F.count(value).alias("n_values"), marks)
            .select(*group_by, "n_values", F.col("_q")[0].alias("p25"), F.col("_q")[1].alias("p75"))
        )
    else:
        quart = group_quantiles(df, group_by, value, (25, 75))
    spread = (F.col("p75") - F.col("p25")) * F.lit(factor)
    fences = quart.select(
        *group_by, "n_values", (F.col("p25") - spread).alias("lower_fence"), (F.col("p75") + spread).alias("upper_fence")
    )
    counts = df.filter(F.col(value).isNotNull()).groupBy(*group_by, value).agg(F.count(F.lit(1)).alias("_n"))
    judged = lookup_join(counts, fences, list(group_by), "inner", spread_by=[value])
    outside = (F.col(value) < F.col("lower_fence")) | (F.col(value) > F.col("upper_fence"))
    return judged.groupBy(*group_by).agg(
        F.first("n_values").alias("n_values"),
        F.first("lower_fence").alias("lower_fence"),
        F.first("upper_fence").alias("upper_fence"),
        F.coalesce(F.sum(F.when(outside, F.col("_n"))), F.lit(0)).alias("outlier_rows"),
    )


def outliers_z(df: DataFrame, group_by: Sequence[str], value: str, limit: float = 3.0) -> DataFrame:
    """Per group: rows more than ``limit`` sample deviations from the mean.

    Values are judged as they are, without rounding. Mean and deviation are merged
    from centred moments, so large means cost no digits.
    """
    given = df.filter(F.col(value).isNotNull()).select(*group_by, F.col(value).cast("double").alias("_v"))
    counts = given.groupBy(*group_by, "_v").agg(F.count(F.lit(1)).alias("_n"))
    stats = given.groupBy(*group_by).agg(
        F.count(F.lit(1)).alias("n_values"), F.avg("_v").alias("_mean"), F.stddev_samp("_v").alias("_sd")
    )
    judged = lookup_join(counts, stats, list(group_by), "inner", spread_by=["_v"])
    far = F.abs(F.col("_v") - F.col("_mean")) > F.col("_sd") * F.lit(limit)
    return judged.groupBy(*group_by).agg(
        F.first("n_values").alias("n_values"),
        F.coalesce(F.sum(F.when(far, F.col("_n"))), F.lit(0)).alias("outlier_rows"),
    )


def overlapping_ranges(
    df: DataFrame, low: str, high: str, partition_by: Sequence[str] = (), slices: int | None = None
) -> DataFrame:
    """Rows per group whose ``[low, high)`` starts before an earlier range ended.

    Ranges that start together are folded into one row first, so equal starts
    never pile up in one task.
    """
    wide = F.col(high) > F.col(low)
    starts = (
        df.filter(F.col(low).isNotNull() & F.col(high).isNotNull())
        .groupBy(*partition_by, low)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.count_if(wide).alias("_open"),
            F.max(high).alias("_end"),
        )
    )
    seen = with_prior(starts, partition_by, [low], maxima={"_reach": F.col("_end")}, slices=slices, cuts_from=df)
    late = F.coalesce(F.col("_reach") > F.col(low), F.lit(False))
    failed = F.when(late, F.col("_n")).otherwise(F.greatest(F.col("_open") - 1, F.lit(0)))
    return seen.groupBy(*partition_by).agg(
        F.sum("_n").alias("rows_total"), F.sum(failed).cast("bigint").alias("rows_failed")
    )


def sequence_breaks(
    df: DataFrame, value: str, step: int = 1, partition_by: Sequence[str] = (), slices: int | None = None
) -> DataFrame:
    """Rows per group that are not exactly ``step`` after the row before them."""
    distinct = (
        df.filter(F.col(value).isNotNull()).groupBy(*partition_by, value).agg(F.count(F.lit(1)).alias("_n"))
    )
    seen = with_prior(distinct, partition_by, [value], maxima={"_last": F.col(value)}, slices=slices, cuts_from=df)
    gap = F.coalesce(F.col(value) != F.col("_last") + step, F.lit(False)).cast("bigint")
    repeats = F.lit(0) if step == 0 else F.col("_n") - 1
    return seen.groupBy(*partition_by).agg(
        F.sum("_n").alias("rows_total"), F.sum(gap + repeats).cast("bigint").alias("rows_failed")
    )
