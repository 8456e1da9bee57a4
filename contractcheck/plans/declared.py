"""Declared tests that need a shuffle or a second table, as counts of rows and failures.

Each takes the table, the check and ``other``, which gives the table that a parameter
names (``orders`` or ``ref('orders')``), and returns one row ``rows_total, rows_failed``.
A missing parameter or column raises; the run logs that as an error of this check alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contractcheck.operators import keys, values
from contractcheck.operators.counters import Check

Other = Callable[[str], DataFrame]

# Hours of the units in which ``recency`` is declared.
UNIT_HOURS = {"hour": 1, "day": 24, "week": 168}


def counted(df: DataFrame, failing: DataFrame) -> DataFrame:
    """Rows of a table and of its failing rows."""
    both = df.select(F.lit(0).alias("f")).unionAll(failing.select(F.lit(1).alias("f")))
    return both.agg(F.count_if(F.col("f") == 0).alias("rows_total"), F.count_if(F.col("f") == 1).alias("rows_failed"))


def _names(given: str | list[str] | None) -> list[str]:
    if given is None:
        return []
    return [given] if isinstance(given, str) else list(given)


def _summed(groups: DataFrame) -> DataFrame:
    return groups.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("rows_total", "rows_failed")])


def unique_key(check: Check) -> list[str] | None:
    """The columns that a uniqueness test declares, None for other tests; ``columns`` makes the key composite."""
    if check.kind == "unique":
        return _names(check.params.get("columns")) or [check.column]
    if check.kind == "unique_combination_of_columns":
        return _names(check.params["combination_of_columns"])
    return None


def _unique(df: DataFrame, check: Check, other: Other) -> DataFrame:
    return keys.check_unique(df, unique_key(check))


def _relationships(df: DataFrame, check: Check, other: Other) -> DataFrame:
    return keys.check_relationship_by_bitmap(df, [check.column], other(check.params["to"]), [check.params["field"]])


def _equal_rowcount(df: DataFrame, check: Check, other: Other) -> DataFrame:
    """Fails by the difference of the two counts."""
    named = check.params.get("compare_model", check.params.get("value"))
    counts = keys.equal_rowcount(df, other(named))
    most = F.greatest("left_rows", "right_rows")
    return counts.select(most.alias("rows_total"), (most - F.least("left_rows", "right_rows")).alias("rows_failed"))


def _cardinality_equality(df: DataFrame, check: Check, other: Other) -> DataFrame:
    """Fails by the number of values whose counts differ."""
    differing = keys.cardinality_equality(df, [check.column], other(check.params["to"]), [check.params["field"]])
    return counted(df, differing)


def _recency(df: DataFrame, check: Check, as_of: str) -> DataFrame:
    """One failure if the newest row is too old; no moment at all is unknown."""
    unit = check.params.get("datepart", "hour")
    hours = int(check.params.get("interval", check.params.get("value"))) * UNIT_HOURS[unit]
    newest = values.recency(df, check.params.get("field", check.column), hours, as_of)
    return newest.select(
        F.col("latest").isNotNull().cast("bigint").alias("rows_total"), (F.col("status") == "fail").cast("bigint").alias("rows_failed")
    )


def _mutually_exclusive_ranges(df: DataFrame, check: Check, other: Other) -> DataFrame:
    low = check.params.get("lower_bound_column", check.column)
    groups = _names(check.params.get("partition_by"))
    return _summed(values.overlapping_ranges(df, low, check.params["upper_bound_column"], groups))


def _sequential_values(df: DataFrame, check: Check, other: Other) -> DataFrame:
    groups = _names(check.params.get("group_by_columns"))
    return _summed(values.sequence_breaks(df, check.column, int(check.params.get("interval", 1)), groups))


TESTS: dict[str, Callable[[DataFrame, Check, Other], DataFrame]] = {
    "unique": _unique,
    "unique_combination_of_columns": _unique,
    "relationships": _relationships,
    "equal_rowcount": _equal_rowcount,
    "cardinality_equality": _cardinality_equality,
    "mutually_exclusive_ranges": _mutually_exclusive_ranges,
    "sequential_values": _sequential_values,
}


def declared_counts(df: DataFrame, check: Check, other: Other, as_of: str) -> DataFrame | None:
    """Counts of a declared test, or None for a name that is not one of them."""
    if check.kind == "recency":
        return _recency(df, check, as_of)
    test = TESTS.get(check.kind)
    return test(df, check, other) if test else None
