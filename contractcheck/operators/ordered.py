"""Running totals and maxima over ordered rows without one task per group.

A window over ``partitionBy(group).orderBy(x)`` sorts each group in one task. When
a group holds a third of all rows that task never finishes. So rows are counted per
hash bucket of the group first. Groups in ordinary buckets use the plain window. For
the rest the order is cut into slices of about equal size: the window runs per (group,
slice), one small row per slice carries the earlier slices' total forward, and both are
combined. Buckets and cut points are read once and become literals, so a retried task
always puts a row into the same place.

Cut points are whole rows of the order columns, from a sample of ``SAMPLES`` rows per
slice, and are compared as Spark compares structs. Any type that can be sorted can be
cut, decimals and text among them, and rows that tie in the first column are cut by the
next. Where the cuts lie decides about balance alone, never about results.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil, sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

GROUP_BUCKETS = 65_536
# Rows a task may sort in any case; above it, half of a task's fair share counts.
TASK_ROWS = 5_000_000
SAMPLES = 64
SEED = 20
# Characters of a text that a cut point keeps.
CUT_CHARS = 256


def _key(df: DataFrame, order_by: Sequence[str]) -> Column:
    """The order columns as one comparable value; nulls come first."""
    return F.col(order_by[0]) if len(order_by) == 1 else F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order_by)])


def cut_points(df: DataFrame, order_by: Sequence[str], slices: int, rows: int | None = None) -> list[Column]:
    """Rising values of the order columns that cut ``df`` into about ``slices`` equal parts.

    The driver sees about ``SAMPLES`` rows per slice, texts cut to ``CUT_CHARS``. ``rows``
    is the number of rows, where it is known.
    """
    kinds = [df.schema[c].dataType for c in order_by]
    short = [F.substring(c, 1, CUT_CHARS).alias(c) if isinstance(k, T.StringType) else F.col(c) for c, k in zip(order_by, kinds, strict=True)]
    wanted, n = SAMPLES * slices, df.count() if rows is None else rows
    keys = df.select(*short)
    some = keys if n <= wanted else keys.sample(wanted / n, SEED)
    sampled = some.sort(*order_by).select(*[F.col(c).cast("string") for c in order_by]).collect()
    picked = [tuple(sampled[i * len(sampled) // slices]) for i in range(1, slices)] if sampled else []
    out = []
    for cut in dict.fromkeys(picked):
        values = [F.lit(v).cast(k) for v, k in zip(cut, kinds, strict=True)]
        out.append(values[0] if len(values) == 1 else F.struct(*[v.alias(f"o{i}") for i, v in enumerate(values)]))
    return out


def slice_number(value: Column, cuts: list[Column]) -> Column:
    """How many cut points are at most ``value``; two short searches, not one long."""
    if not cuts:
        return F.lit(0)
    width = ceil(sqrt(len(cuts)))
    blocks = [cuts[i : i + width] for i in range(0, len(cuts), width)]
    full = F.size(F.filter(F.array(*[b[0] for b in blocks]), lambda cut: cut <= value))
    body = F.array(*[F.array(*b) for b in blocks])
    inside = F.size(F.filter(F.element_at(body, full), lambda cut: cut <= value))
    return F.when(full > 0, (full - 1) * width + inside).otherwise(0)


def slice_of(df: DataFrame, order_by: Sequence[str], slices: int, rows: int | None = None) -> Column:
    """A slice number that rises with ``order_by``, from the values in ``df``."""
    return slice_number(_key(df, order_by), cut_points(df, order_by, slices, rows))


def _task_count(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _bucket(partition_by: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*partition_by), F.lit(GROUP_BUCKETS)).cast("int")


def hot_buckets(df: DataFrame, partition_by: Sequence[str]) -> dict[int, int]:
    """Buckets whose groups may be too large for one task, and their rows. Each task sends
    one count per bucket and the driver sees at most one number per bucket."""
    sizes = df.groupBy(_bucket(partition_by).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
    limit = max(TASK_ROWS, sum(r.n for r in sizes) // (2 * _task_count(df)))
    return {r.b: r.n for r in sizes if r.n > limit}


def needed_slices(df: DataFrame) -> int:
    """Two per task, so that one large slice does not end last."""
    return max(2, 2 * _task_count(df))


def with_prior(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[str],
    maxima: dict[str, Column] | None = None,
    sums: dict[str, Column] | None = None,
    totals: Sequence[str] = (),
    slices: int | None = None,
    cuts_from: DataFrame | None = None,
) -> DataFrame:
    """Add, per output name, the maximum or sum over all earlier rows of the group.

    ``order_by`` is ascending and must be unique inside a group. Names in
    ``totals`` also get ``total_<name>``, the value over the whole group. When
    ``df`` is itself an aggregate, ``cuts_from`` names its input: the cut points then
    come from a plain scan of the order columns and the aggregate runs only once.
    ``slices`` sets the number of slices instead of the size check.
    """
    shape = _Shape(list(partition_by), list(order_by), maxima or {}, sums or {}, list(totals))
    source = df if cuts_from is None else cuts_from
    if slices is not None:
        return _plain(df, shape) if slices < 2 else _sliced(df, shape, source, slices)
    if not partition_by:
        n = source.count()
        return _plain(df, shape) if n <= TASK_ROWS else _sliced(df, shape, source, needed_slices(df), n)
    hot = hot_buckets(source, partition_by)
    if not hot:
        return _plain(df, shape)
    heavy = _bucket(partition_by).isin(list(hot))
    large = _sliced(df.filter(heavy), shape, source.filter(heavy), needed_slices(df), sum(hot.values()))
    return _plain(df.filter(~heavy), shape).unionByName(large)


@dataclass(frozen=True)
class _Shape:
    """What :func:`with_prior` computes."""

    partition_by: list[str]
    order_by: list[str]
    maxima: dict[str, Column]
    sums: dict[str, Column]
    totals: list[str]

    @property
    def values(self) -> dict[str, Column]:
        return {**self.maxima, **self.sums}

    def fold(self, name: str, value: Column | str) -> Column:
        return F.max(value) if name in self.maxima else F.sum(value)


def _plain(df: DataFrame, shape: _Shape) -> DataFrame:
    """One task per group."""
    whole = Window.partitionBy(*shape.partition_by)
    earlier = whole.orderBy(*shape.order_by).rowsBetween(Window.unboundedPreceding, -1)
    return df.select(
        "*",
        *[shape.fold(k, v).over(earlier).alias(k) for k, v in shape.values.items()],
        *[shape.fold(k, shape.values[k]).over(whole).alias(f"total_{k}") for k in shape.totals],
    )


def _sliced(df: DataFrame, shape: _Shape, source: DataFrame, slices: int, rows: int | None = None) -> DataFrame:
    """One task per group and slice."""
    values, fold = shape.values, shape.fold
    partition_by, order_by, totals = shape.partition_by, shape.order_by, shape.totals
    group = F.struct(*partition_by) if partition_by else F.struct(F.lit(0).alias("all"))
    base = df.select("*", group.alias("_group"), slice_of(source, order_by, slices, rows).alias("_slice"))

    earlier = (
        Window.partitionBy("_group", "_slice").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = base.select("*", *[fold(k, v).over(earlier).alias(f"_in_{k}") for k, v in values.items()])

    per_slice = base.groupBy("_group", "_slice").agg(*[fold(k, v).alias(f"_all_{k}") for k, v in values.items()])
    slice_order = Window.partitionBy("_group").orderBy("_slice")
    before = slice_order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_group")
    carried = per_slice.select(
        "_group",
        "_slice",
        *[fold(k, f"_all_{k}").over(before).alias(f"_carry_{k}") for k in values],
        *[fold(k, f"_all_{k}").over(whole).alias(f"total_{k}") for k in totals],
    )
    joined = inside.join(carried, ["_group", "_slice"])
    out = []
    for k in values:
        own, carry = F.col(f"_in_{k}"), F.col(f"_carry_{k}")
        both = F.greatest(own, carry) if k in shape.maxima else own + carry
        out.append(F.coalesce(both, own, carry).alias(k))
    return joined.select(*df.columns, *out, *[F.col(f"total_{k}") for k in totals])
