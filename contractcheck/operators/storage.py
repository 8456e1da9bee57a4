"""Snapshots for small mutable tables, day-partitioned appends for logs.

Parquet has no row updates. A changed table is written as a new ``v=N`` folder and
the newest complete one (it has Spark's success marker) is current; one writer at a
time is assumed. Logs only grow and are deleted by day.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractcheck.functions.numbers import days_before, ntz
from contractcheck.operators.keys import duplicate_keys
from contractcheck.schemas import COLUMN_DEFAULTS, LOG_KEYS, LOG_TABLES, REGISTRY_TABLES, conform, empty

DAY = "run_date"


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def _children(spark: SparkSession, path: str, prefix: str) -> list[str]:
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(jpath)]
    return sorted(n for n in names if n.startswith(prefix))


def _delete(spark: SparkSession, path: str) -> None:
    fs, jpath = _fs(spark, path)
    fs.delete(jpath, True)


def current_version(spark: SparkSession, root: str, table: str) -> int:
    """Number of the newest complete snapshot, 0 when there is none."""
    for name in reversed(_children(spark, f"{root}/{table}", "v=")):
        if _complete(spark, f"{root}/{table}/{name}"):
            return int(name.removeprefix("v="))
    return 0


def read_current(spark: SparkSession, root: str, table: str) -> DataFrame:
    version = current_version(spark, root, table)
    schema = REGISTRY_TABLES.get(table)
    if version == 0:
        if schema is None:
            raise FileNotFoundError(f"no snapshot of {table} below {root}")
        return empty(spark, schema)
    return spark.read.parquet(f"{root}/{table}/v={version:09d}")


def write_snapshot(df: DataFrame, root: str, table: str) -> int:
    """Write the next version and return its number."""
    spark = df.sparkSession
    version = current_version(spark, root, table) + 1
    if table in REGISTRY_TABLES:
        df = conform(df, REGISTRY_TABLES[table], COLUMN_DEFAULTS.get(table))
    df.write.mode("overwrite").parquet(f"{root}/{table}/v={version:09d}")
    return version


def ensure_tables(spark: SparkSession, root: str) -> None:
    """Empty registry tables where none exist yet."""
    for table, schema in REGISTRY_TABLES.items():
        if current_version(spark, root, table) == 0:
            write_snapshot(empty(spark, schema), root, table)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    insert_only: Sequence[str] = (),
) -> DataFrame:
    """Merge ``source`` into ``target``: known keys take ``update_cols`` and keep
    everything else, new keys also take ``insert_only``, other target rows stay.
    ``source`` must hold each key once (:func:`assert_unique`)."""
    given = [c for c in [*update_cols, *insert_only] if c in source.columns]
    new = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in given], F.lit(True).alias("_in_source"))
    joined = target.withColumn("_in_target", F.lit(True)).join(new, list(keys), "full_outer")
    matched, inserted = F.col("_in_source").isNotNull(), F.col("_in_target").isNull()
    cols = []
    for field in target.schema.fields:
        c = field.name
        if c in keys or c not in given:
            cols.append(F.col(c))
            continue
        take = matched if c in update_cols else inserted
        cols.append(F.when(take, F.col(f"_s_{c}").cast(field.dataType)).otherwise(F.col(c)).alias(c))
    return joined.select(*cols)


def assert_unique(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    bad = duplicate_keys(df, keys).limit(3).collect()
    if bad:
        raise ValueError(f"{name}: keys {list(keys)} are not unique, e.g. {bad[0].asDict()}")
    return df


def keyed_update(target: DataFrame, changes: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Overwrite ``columns`` of target rows that have a change; nothing is inserted."""
    new = changes.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in columns], F.lit(True).alias("_hit"))
    joined = target.join(new, list(keys), "left")
    return joined.select(
        *[F.when(F.col("_hit"), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns]
    )


def append_log(df: DataFrame, root: str, table: str) -> None:
    """Append rows below their day; nothing is written for an empty frame."""
    schema, ts = LOG_TABLES[table]
    rows = conform(df, schema, COLUMN_DEFAULTS.get(table)).withColumn(DAY, F.to_date(ts))
    # Rebalancing gathers each day into few files and still splits a large day.
    rows.hint("rebalance", DAY).sortWithinPartitions(DAY, ts).write.mode("append").partitionBy(DAY).parquet(f"{root}/{table}")


def append_once(df: DataFrame, root: str, table: str, day: str) -> None:
    """Append the rows of ``day`` that the log does not hold yet, so that a run
    repeated after a failure adds nothing twice."""
    known = read_log(df.sparkSession, root, table, day).select(*LOG_KEYS[table])
    append_log(df.join(known, LOG_KEYS[table], "left_anti"), root, table)


def read_log(spark: SparkSession, root: str, table: str, day: str | None = None) -> DataFrame:
    """A log, or one day of it; only that day's folder is read."""
    schema, _ = LOG_TABLES[table]
    if not _children(spark, f"{root}/{table}", f"{DAY}="):
        return empty(spark, schema).withColumn(DAY, F.lit(None).cast("date"))
    log = spark.read.schema(_with_day(schema)).parquet(f"{root}/{table}")
    return log if day is None else log.filter(F.col(DAY) == F.lit(day).cast("date"))


def _with_day(schema: T.StructType) -> T.StructType:
    fields = [T.StructField(f.name, f.dataType, True) for f in schema.fields]
    return T.StructType([*fields, T.StructField(DAY, T.DateType())])


def retain(df: DataFrame, ts: str, days: int, as_of: str) -> DataFrame:
    """Rows at most ``days`` old; rows without a time are kept."""
    return df.filter((F.col(ts) >= days_before(ntz(as_of), days)) | F.col(ts).isNull())


def expired(df: DataFrame, ts: str, days: int, as_of: str) -> DataFrame:
    return df.filter(F.col(ts) < days_before(ntz(as_of), days))


def archive_split(df: DataFrame, ts: str, days: int, as_of: str) -> tuple[DataFrame, DataFrame]:
    """Rows to keep and rows to move to the archive."""
    return retain(df, ts, days, as_of), expired(df, ts, days, as_of)


def expire_log(
    spark: SparkSession, root: str, table: str, days: int, as_of: str, archive: str | None = None, enabled: bool = True
) -> int:
    """Delete log rows older than ``days`` and return how many went.

    Whole days are dropped as folders; only the day the limit falls into is
    rewritten, through a staging folder, so the work does not grow with the log.
    With ``archive`` the rows are appended there first. A call that was cut short
    can be repeated: a complete staging folder is put in place first, and rows
    already in the archive are not added again.
    """
    if not enabled:
        return 0
    _, ts = LOG_TABLES[table]
    path = f"{root}/{table}"
    cutoff = datetime.fromisoformat(as_of) - timedelta(days=days)
    edge = cutoff.date().isoformat()
    staging = f"{root}/_staging/{table}-{edge}"
    if _complete(spark, staging):
        _put_in_place(spark, staging, f"{path}/{DAY}={edge}")
    names = [n.removeprefix(f"{DAY}=") for n in _children(spark, path, f"{DAY}=")]
    touched = [n for n in names if n[:4].isdigit() and n <= edge]
    if not touched:
        return 0
    log = read_log(spark, root, table)
    old = expired(log.filter(F.col(DAY) <= F.lit(edge).cast("date")), ts, days, as_of)
    gone = old.count()
    if gone and archive:
        target = f"{archive}/{table}"
        if _children(spark, target, f"{DAY}="):
            stored = spark.read.schema(old.schema).parquet(target)
            stored = stored.filter(F.col(DAY).between(F.lit(min(touched)).cast("date"), F.lit(edge).cast("date")))
            old = old.join(stored.select(*LOG_KEYS[table]), LOG_KEYS[table], "left_anti")
        old.write.mode("append").partitionBy(DAY).parquet(target)
    if edge in names:
        kept = retain(read_log(spark, root, table, edge), ts, days, as_of)
        kept.drop(DAY).write.mode("overwrite").parquet(staging)
        _put_in_place(spark, staging, f"{path}/{DAY}={edge}")
    for n in touched:
        if n < edge:
            _delete(spark, f"{path}/{DAY}={n}")
    spark.catalog.refreshByPath(path)
    return gone


def _complete(spark: SparkSession, path: str) -> bool:
    fs, marker = _fs(spark, f"{path}/_SUCCESS")
    return fs.exists(marker)


def _put_in_place(spark: SparkSession, staging: str, target: str) -> None:
    """Replace a day's folder by the staged rows, or drop it when none are left."""
    rest = spark.read.parquet(staging)
    if rest.isEmpty():
        _delete(spark, target)
    else:
        rest.write.mode("overwrite").parquet(target)
    _delete(spark, staging)


def materialise(df: DataFrame, path: str, partition_column: str | None = None) -> None:
    """Write a model as a table. A declared hash column spreads the rows by it; a
    value that owns too many rows is split at run time."""
    if partition_column:
        df = df.hint("rebalance", partition_column)
    df.write.mode("overwrite").parquet(path)
