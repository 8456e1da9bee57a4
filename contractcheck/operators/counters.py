"""All row-level checks of a table in one pass.

Each check becomes one conditional count. A table with hundreds of checks is read
once, with only the checked columns, and every task sends a single row of counts
to the final step.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractcheck.functions.numbers import basis_points, ntz, pct2
from contractcheck.functions.text import quote_name
from contractcheck.operators.lookups import union_all
from contractcheck.schemas import RESULT, conform

MAX_COUNTERS_PER_PASS = 400

# What the test names of agreements and model definitions mean here.
TEST_ALIASES = {
    "in": "accepted_values",
    "enum": "accepted_values",
    "dbt_utils.expression_is_true": "expression_is_true",
    "dbt_expectations.expect_column_values_to_be_of_type": "column_type",
}


@dataclass(frozen=True)
class Check:
    """One check of one column; ``params`` depends on ``kind``."""

    column: str | None
    kind: str
    params: dict = field(default_factory=dict, hash=False)
    severity: str = "error"

    @property
    def test_name(self) -> str:
        return self.params.get("test_name", self.kind)


def check_from_row(column: str | None, test_name: str, params_json: str | None, severity: str = "error") -> Check:
    """A check from a row of the ``tests`` table. Parameters are the JSON text of
    the one-key map ``{test_name: parameters}``."""
    kind = TEST_ALIASES.get(test_name, test_name.rsplit(".", 1)[-1])
    given = json.loads(params_json).get(test_name) if params_json else None
    params: dict = {"test_name": test_name}
    if isinstance(given, dict):
        params.update(given)
    elif isinstance(given, list):
        params["values"] = given
    elif given is not None:
        params["value"] = given
    return Check(column, kind, params, severity)


def _values(check: Check) -> list:
    """The listed values. A NULL in the list only says that NULL is allowed, which it is anyway."""
    return [v for v in check.params["values"] if v is not None]


ROW_CHECKS = {
    "not_null": lambda c, k: c.isNull(),
    "accepted_values": lambda c, k: c.isNotNull() & ~c.isin(*_values(k)),
    "not_accepted_values": lambda c, k: c.isin(*_values(k)),
    "max_length": lambda c, k: F.char_length(c) > int(k.params["value"]),
    "length": lambda c, k: F.char_length(c) != int(k.params["value"]),
    "castable": lambda c, k: c.isNotNull() & c.try_cast(k.params["type"]).isNull(),
}


def failing_rows(check: Check) -> Column:
    """True for a row that breaks the check; NULL and false both pass."""
    if check.kind == "expression_is_true":
        text = check.params["expression"]
        return ~F.expr(f"{quote_name(check.column)} {text}" if check.column else text)
    return ROW_CHECKS[check.kind](F.col(quote_name(check.column)), check)


def problem(df: DataFrame, check: Check) -> str | None:
    """Why a row check can't be evaluated on a table, looking at its schema only."""
    try:
        if check.column is None or check.column in df.columns:
            df.limit(0).select(row_counter(check).alias("n")).schema  # noqa: B018
    except Exception as exc:  # a check that can't be built is a finding of its own
        return (str(exc) or type(exc).__name__).strip().split("\n", 1)[0]
    return None


def is_row_check(check: Check) -> bool:
    return check.kind in ROW_CHECKS or check.kind in ("expression_is_true", "at_least_one")


def row_counter(check: Check) -> Column:
    if check.kind == "at_least_one":
        return (F.count(F.col(quote_name(check.column))) == 0).cast("bigint")
    return F.count_if(failing_rows(check))


def column_counters(df: DataFrame, checks: Iterable[Check]) -> DataFrame:
    """One row per check: ``pos, column_name, check_type, severity, rows_total,
    rows_failed``. A check on a column the table lacks has NULL ``rows_failed``."""
    numbered = list(enumerate(checks))
    have = set(df.columns)
    frames = []
    for start in range(0, max(len(numbered), 1), MAX_COUNTERS_PER_PASS):
        part = numbered[start : start + MAX_COUNTERS_PER_PASS]
        counts = [
            row_counter(k).alias(f"n{i}") for i, k in part if k.column is None or k.column in have
        ]
        wide = df.agg(F.count(F.lit(1)).alias("rows_total"), *counts)
        rows = [
            F.struct(
                F.lit(i).alias("pos"),
                F.lit(k.column).cast("string").alias("column_name"),
                F.lit(k.kind).alias("check_type"),
                F.lit(k.severity).alias("severity"),
                F.col("rows_total"),
                (F.col(f"n{i}") if k.column is None or k.column in have else F.lit(None).cast("bigint")).alias(
                    "rows_failed"
                ),
            )
            for i, k in part
        ]
        frames.append(wide.select(F.inline(F.array(*rows))) if rows else wide.limit(0).select(
            F.lit(0).alias("pos"), F.lit("").alias("column_name"), F.lit("").alias("check_type"),
            F.lit("").alias("severity"), "rows_total", F.col("rows_total").alias("rows_failed"),
        ))
    return union_all(frames)


def status_of(rows_total: Column, rows_failed: Column) -> Column:
    """Empty tables are ``unknown``; a check that could not run is ``error``."""
    return (
        F.when(rows_failed.isNull(), "error")
        .when(rows_total == 0, "unknown")
        .when(rows_failed == 0, "pass")
        .otherwise("fail")
    )


def to_results(
    counts: DataFrame, as_of: str, table_name: str, model_id: str | None = None, contract_id: str | None = None
) -> DataFrame:
    """Counter rows in the common result layout."""
    total, failed = F.col("rows_total"), F.col("rows_failed")
    rows = counts.select(
        F.lit(contract_id).alias("contract_id"),
        F.lit(model_id).alias("model_id"),
        F.lit(table_name).alias("table_name"),
        "column_name",
        "check_type",
        status_of(total, failed).alias("status"),
        (F.col("severity") if "severity" in counts.columns else F.lit("error")).alias("severity"),
        "rows_total",
        "rows_failed",
        F.lit(0.0).alias("expected_value"),
        failed.cast("double").alias("actual_value"),
        F.to_json(F.struct("column_name", "check_type", "rows_failed")).alias("details"),
        ntz(as_of).alias("as_of"),
    )
    return conform(rows, RESULT)


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null and non-null share of every column, one scan for all of them."""
    return profile_from_counts(column_counters(df, [Check(c, "not_null") for c in columns]))


def profile_from_counts(counts: DataFrame, keys: Sequence[str] = ("pos",)) -> DataFrame:
    """The same out of ``not_null`` counters that were taken together with others."""
    total, nulls = F.col("rows_total"), F.col("rows_failed")
    present = counts.filter((F.col("check_type") == "not_null") & nulls.isNotNull())
    return present.select(
        *keys,
        "column_name",
        "rows_total",
        nulls.alias("null_rows"),
        pct2(nulls, total).alias("null_pct"),
        pct2(total - nulls, total).alias("non_null_pct"),
        basis_points(total - nulls, total).alias("non_null_bp"),
    )


def null_spike(profile: DataFrame, threshold: float = 10, keys: Sequence[str] = ()) -> DataFrame:
    """Required columns whose null share is above the threshold; ``high`` above
    twice the threshold. Empty tables raise no issue. ``keys`` are carried along."""
    pct = F.col("null_pct")
    shown = F.lit(threshold).cast("double")
    return profile.filter(pct > shown).select(
        *keys,
        "column_name",
        F.lit("null_spike").alias("quality_check_type"),
        F.when(pct > shown * 2, "high").otherwise("medium").alias("severity"),
        F.lit("fail").alias("status"),
        F.concat(
            F.lit("Column '"), F.col("column_name"), F.lit("' has "), pct.cast("string"),
            F.lit(f"% nulls (threshold: {threshold:g}%)"),
        ).alias("description"),
        F.to_json(
            F.struct(
                F.col("column_name").alias("column"), pct.alias("null_percentage"), shown.alias("threshold")
            )
        ).alias("details_json"),
        "rows_total",
        "null_rows",
        "null_pct",
    )
