"""Everything a run wants to know about its tables, one aggregate per table.

The probes of a table (row checks, null counts of required columns, its row count, its
newest moment) become one aggregate and so one scan, all its unique keys a second one with
one shuffle; those of many tables make one job.
A probe that fails while it runs, such as a cast of ``oops`` to a number, would take the
whole job with it. Then the probes are halved and each half is counted again, until the
culprits stand alone: they become error rows with their reason and all others keep their
counts. ``k`` culprits among ``n`` probes cost about ``2 k log2(n / k)`` further passes.

A pass ends in one row per probe, which is as many as there are declared checks.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from contractcheck.operators.counters import MAX_COUNTERS_PER_PASS, Check, is_row_check, row_counter
from contractcheck.operators.keys import check_unique_many
from contractcheck.operators.lookups import union_all
from contractcheck.operators.slo import newest

COUNT_COLUMNS = (
    "table_name string, test_id string, column_name string, check_type string, severity string,"
    " rows_total bigint, rows_failed bigint, latest timestamp_ntz, reason string"
)
REASON_CHARS = 500
#: What makes a job fail because of the data or of one file.
FAILURES = (PySparkException, Py4JJavaError)
ROW_COUNT, NEWEST = "table", "newest"


@dataclass(frozen=True)
class Probe:
    """One thing to count. ``counts`` holds ``rows_total, rows_failed`` of a check that
    needs more than its table's rows, ``key`` the columns of a key that must be unique;
    ``reason`` says why a probe cannot be counted."""

    table: str
    test_id: str
    check: Check
    counts: DataFrame | None = None
    key: tuple[str, ...] = ()
    reason: str | None = None


def table_probes(table: str, with_moment: bool = True) -> list[Probe]:
    """The table's row count, which also tells whether it can be read, and its newest moment."""
    kinds = (ROW_COUNT, NEWEST) if with_moment else (ROW_COUNT,)
    return [Probe(table, f"{table}/{kind}", Check(None, kind, severity="table")) for kind in kinds]


def reason_of(exc: BaseException) -> str:
    """The first line of what went wrong, without a stack."""
    if isinstance(exc, Py4JJavaError):
        cause = exc.java_exception
        while cause.getCause() is not None:
            cause = cause.getCause()
        text = f"{cause.getClass().getSimpleName()}: {cause.getMessage()}"
    else:
        text = str(exc) or type(exc).__name__
    return text.strip().split("\n", 1)[0][:REASON_CHARS]


def _labels(p: Probe) -> list:
    return [
        F.lit(p.table).alias("table_name"),
        F.lit(p.test_id).alias("test_id"),
        F.lit(p.check.column).cast("string").alias("column_name"),
        F.lit(p.check.kind).alias("check_type"),
        F.lit(p.check.severity).alias("severity"),
    ]


def _measures(total, failed, latest=None) -> list:
    return [
        total.cast("bigint").alias("rows_total"),
        failed.cast("bigint").alias("rows_failed"),
        (F.lit(None) if latest is None else latest).cast("timestamp_ntz").alias("latest"),
        F.lit(None).cast("string").alias("reason"),
    ]


def _in_scan(p: Probe) -> bool:
    return p.counts is None and not p.key and (is_row_check(p.check) or p.check.kind in (ROW_COUNT, NEWEST))


def _scan(df: DataFrame, probes: Sequence[Probe], ts_columns: Sequence[str]) -> DataFrame:
    """All probes of one table in one aggregate."""
    have, total = set(df.columns), F.col("rows_total")
    aggregates, rows = [F.count(F.lit(1)).alias("rows_total")], []
    for i, p in enumerate(probes):
        failed, latest = F.lit(0), None
        if p.check.kind == NEWEST:
            aggregates.append(newest(df, ts_columns).alias(f"n{i}"))
            latest = F.col(f"n{i}")
        elif p.check.kind != ROW_COUNT and (p.check.column is None or p.check.column in have):
            aggregates.append(row_counter(p.check).alias(f"n{i}"))
            failed = F.col(f"n{i}")
        elif p.check.kind != ROW_COUNT:
            failed = F.lit(None)
        rows.append(F.struct(*_labels(p), *_measures(total, failed, latest)))
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def _unique_keys(df: DataFrame, probes: Sequence[Probe]) -> DataFrame:
    """All unique keys of one table in one shuffle."""
    labels = F.element_at(F.array(*[F.struct(*_labels(p)) for p in probes]), F.col("pos") + 1)
    found = check_unique_many(df, [p.key for p in probes]).withColumn("label", labels)
    return found.select("label.*", *_measures(F.col("rows_total"), F.col("rows_failed")))


def one_pass(tables: Mapping[str, DataFrame], probes: Sequence[Probe], ts_columns: Sequence[str]) -> DataFrame:
    """The counts of all probes as one frame: a scan per table, and one per ``MAX_COUNTERS_PER_PASS`` more of its probes."""
    frames = []
    for name in dict.fromkeys(p.table for p in probes):
        own = [p for p in probes if p.table == name and _in_scan(p)]
        for start in range(0, len(own), MAX_COUNTERS_PER_PASS):
            frames.append(_scan(tables[name], own[start : start + MAX_COUNTERS_PER_PASS], ts_columns))
        unique = [p for p in probes if p.table == name and p.key]
        if unique:
            frames.append(_unique_keys(tables[name], unique))
    for p in probes:
        if p.counts is not None:
            frames.append(p.counts.select(*_labels(p), *_measures(F.col("rows_total"), F.col("rows_failed"))))
    return union_all(frames)


def error_row(p: Probe, reason: str) -> Row:
    return Row(p.table, p.test_id, p.check.column, p.check.kind, p.check.severity, None, None, None, reason)


def bisected(tables: Mapping[str, DataFrame], probes: Sequence[Probe], ts_columns: Sequence[str]) -> list[Row]:
    """The rows of all probes; those that cannot be counted as error rows."""
    if not probes:
        return []
    try:
        return one_pass(tables, probes, ts_columns).collect()
    except FAILURES as exc:
        if len(probes) == 1:
            return [error_row(probes[0], reason_of(exc))]
    half = len(probes) // 2
    return bisected(tables, probes[:half], ts_columns) + bisected(tables, probes[half:], ts_columns)


def measured(
    spark: SparkSession, tables: Mapping[str, DataFrame], probes: Iterable[Probe], ts_columns: Sequence[str] = (), tables_per_job: int = 20
) -> DataFrame:
    """``COUNT_COLUMNS`` of every probe. A probe of a table that ``tables`` lacks needs a ``reason``."""
    probes = list(probes)
    rows = [error_row(p, p.reason) for p in probes if p.reason is not None]
    countable = [p for p in probes if p.reason is None]
    names = sorted({p.table for p in countable})
    for start in range(0, len(names), tables_per_job):
        batch = set(names[start : start + tables_per_job])
        rows += bisected(tables, sorted((p for p in countable if p.table in batch), key=lambda p: p.table), ts_columns)
    return spark.createDataFrame([tuple(r) for r in rows], COUNT_COLUMNS)
