"""Declared columns against real ones. Names are compared as written."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contractcheck.operators.lookups import lookup_join
from contractcheck.operators.values import type_matches


def contract_column_list(columns: DataFrame, model_id: str) -> DataFrame:
    """Declared columns of one model in declared order."""
    return columns.filter(F.col("model_id") == model_id).select("pos", "column_name").orderBy("pos")


def schema_diff(declared: DataFrame, actual: DataFrame, keys: Sequence[str] = ("table_name",)) -> DataFrame:
    """``keys..., diff_type, column_name`` for all tables at once; tables without
    any declared column are left out."""
    on = [*keys, "column_name"]
    sides = declared.select(*on, F.lit(True).alias("_d"), F.lit(False).alias("_a")).unionByName(
        actual.select(*on, F.lit(False).alias("_d"), F.lit(True).alias("_a"))
    )
    both = sides.groupBy(*on).agg(F.bool_or("_d").alias("_d"), F.bool_or("_a").alias("_a"))
    diff = both.filter(~(F.col("_d") & F.col("_a"))).select(
        *keys, F.when(F.col("_d"), "missing").otherwise("extra").alias("diff_type"), "column_name"
    )
    return lookup_join(diff, declared.select(*keys).distinct(), list(keys), "left_semi", spread_by=["column_name"])


def missing_columns(declared: DataFrame, actual: DataFrame, keys: Sequence[str] = ("table_name",)) -> DataFrame:
    """Declared columns the table lacks."""
    on = [*keys, "column_name"]
    found = actual.select(*on).distinct()
    return declared.select(*on).distinct().join(found, on, "left_anti").withColumnRenamed("column_name", "missing_column")


def schema_drift(declared: DataFrame, actual: DataFrame, keys: Sequence[str] = ("table_name",)) -> DataFrame:
    """Differences as issues. Extra columns starting with ``_`` are system columns."""
    diff = schema_diff(declared, actual, keys)
    missing = F.col("diff_type") == "missing"
    kept = diff.filter(missing | ~F.col("column_name").startswith("_"))
    name = F.concat(F.lit("Column '"), F.col("column_name"))
    return kept.select(
        *keys,
        "column_name",
        F.lit("schema_drift").alias("quality_check_type"),
        F.when(missing, "high").otherwise("medium").alias("severity"),
        F.when(missing, "fail").otherwise("warning").alias("status"),
        F.when(missing, F.concat(name, F.lit("' in contract but missing from table")))
        .otherwise(F.concat(name, F.lit("' in table but not in contract")))
        .alias("description"),
        F.to_json(
            F.struct(
                F.when(missing, "missing_column").otherwise("extra_column").alias("issue_type"),
                F.col("column_name").alias("column"),
            )
        ).alias("details_json"),
    )


def column_types(df: DataFrame, declared: dict[str, str]) -> list[tuple[str, str, str | None, bool]]:
    """``(column, declared, actual, matches)`` from the schema alone."""
    real = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for name, text in declared.items():
        kind = real.get(name)
        out.append((name, text, kind.simpleString() if kind else None, bool(kind) and type_matches(text, kind)))
    return out
