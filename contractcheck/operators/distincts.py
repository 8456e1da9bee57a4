"""Distinct counts over long ranges of a log: sketches kept per day, and an exact way beside them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractcheck.functions.numbers import ntz
from contractcheck.operators.storage import DAY, _children, read_log
from contractcheck.schemas import LOG_TABLES

#: Logarithm of the number of registers: 4 KB a sketch at most, a standard error of 1.04 / sqrt(2^12) = 1.6%.
REGISTERS = 12


def between(log: DataFrame, ts: str, first: str, last: str) -> DataFrame:
    """Rows from the day ``first`` to the day ``last``, both included, as a range on the timestamp
    and, where the log has day folders, as a filter on them."""
    inside = (F.col(ts) >= ntz(f"{first} 00:00:00")) & (F.col(ts) < ntz(f"{last} 00:00:00") + F.make_dt_interval(F.lit(1)))
    if DAY in log.columns:
        inside = inside & F.col(DAY).between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return log.filter(inside)


def distinct_in_range(log: DataFrame, ts: str, first: str, last: str, by: Sequence[str], value: str) -> DataFrame:
    """``by, rows, distinct_values`` over the days, exact. Rows are reduced to one per key and value in
    every task and again after the shuffle, which spreads the values of a hot key; nulls are no values."""
    pairs = between(log, ts, first, last).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    return pairs.groupBy(*by).agg(F.sum("_n").alias("rows"), F.count(value).alias("distinct_values"))


def day_sketches(log: DataFrame, ts: str, by: Sequence[str], value: str, registers: int = REGISTERS) -> DataFrame:
    """``run_date, by, rows, sketch``: one mergeable sketch of the values per key and day."""
    day = F.col(DAY) if DAY in log.columns else F.to_date(ts)
    return log.groupBy(day.alias(DAY), *by).agg(F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg(value, registers).alias("sketch"))


def keep_day_sketches(spark: SparkSession, root: str, table: str, day: str, by: Sequence[str], value: str) -> None:
    """Write the sketches of one day of a log to ``<root>/<table>_distinct_<value>``. The day's
    folder is replaced as a whole, so a repeated run changes nothing."""
    made = day_sketches(read_log(spark, root, table, day), LOG_TABLES[table][1], by, value)
    made.drop(DAY).coalesce(1).write.mode("overwrite").parquet(f"{root}/{table}_distinct_{value}/{DAY}={day}")


def sketched_days(spark: SparkSession, root: str, table: str, value: str) -> DataFrame | None:
    """All kept sketches of a log; None before the first day."""
    path = f"{root}/{table}_distinct_{value}"
    return spark.read.parquet(path) if _children(spark, path, f"{DAY}=") else None


def sketched_in_range(sketches: DataFrame, first: str, last: str, by: Sequence[str]) -> DataFrame:
    """``by, rows, distinct_estimate`` over the days, from kept sketches alone: one small row per key
    and day is read, however long the log is."""
    inside = F.col(DAY).between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    merged = sketches.filter(inside).groupBy(*by).agg(F.sum("rows").alias("rows"), F.hll_union_agg("sketch").alias("sketch"))
    return merged.select(*by, "rows", F.hll_sketch_estimate("sketch").alias("distinct_estimate"))
