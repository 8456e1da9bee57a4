"""Joins in which one key may hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SALT = "_salt"


def _hashable(df: DataFrame) -> list[str]:
    complex_types = (T.MapType, T.VariantType)
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, complex_types)]


def default_salts(df: DataFrame) -> int:
    """A quarter of the tasks of a shuffle."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "left",
    salts: int | None = None,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Join ``facts`` to ``dim``, which holds about one row per key.

    Without ``salts`` the join is adaptive: by the sizes measured when both sides have been
    written to the shuffle, Spark broadcasts a small ``dim`` or splits the partitions that a
    hot key makes large, repeating their part of ``dim``. No estimate decides. With ``salts``
    the rows of one key are spread over so many tasks by a hash of the row itself
    (repeatable on retry) and ``dim`` is repeated once per salt: for joins whose keys are
    known to be few and hot, or sessions without adaptive execution.
    """
    if salts is None:
        return facts.join(dim, list(on), how)
    spread = list(spread_by or _hashable(facts))
    salted = facts.withColumn(SALT, F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    copies = dim.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*on, SALT], how).drop(SALT)


def key_counts(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Rows per non-null key. Map-side counting collapses hot keys before the shuffle."""
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.filter(present).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def renamed_keys(df: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
