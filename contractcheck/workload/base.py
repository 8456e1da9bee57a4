"""Registration of the named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

AS_OF = "2024-02-01 00:00:00"


def query(name: str, sql: str | None = None):
    """Register a query under ``name`` with the SQL that gives the same rows."""

    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_pct2(part: str, whole: str) -> str:
    """Oracle side of :func:`contractcheck.functions.numbers.pct2`."""
    return (
        f"CASE WHEN {whole} > 0 THEN CAST((20000*CAST({part} AS BIGINT) + CAST({whole} AS BIGINT))"
        f" // (2*CAST({whole} AS BIGINT)) AS DOUBLE) / 100 END"
    )
