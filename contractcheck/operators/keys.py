"""Checks that look across rows: uniqueness, references, equal counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractcheck.functions.numbers import pct2
from contractcheck.functions.text import quote_name
from contractcheck.operators.lookups import all_of, key_counts, renamed_keys


def _one(df: DataFrame, *aggs) -> DataFrame:
    return df.agg(*aggs)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every non-null key that occurs more than once, with its row count."""
    return key_counts(df, keys, "rows_per_key").filter(F.col("rows_per_key") > 1)


def check_unique(df: DataFrame, keys: Sequence[str], digest: bool = False) -> DataFrame:
    """``rows_total, keys_total, rows_failed`` where ``rows_failed`` counts the
    repeated keys and ``duplicate_rows`` the rows they cover. NULL keys are not
    duplicates but do count as rows. ``digest`` shuffles a SHA-256 of long text
    keys instead of the text."""
    if digest:
        df = df.select(*[F.unhex(F.sha2(k, 256)).alias(k) for k in keys])
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    repeated = present & (F.col("_n") > 1)
    return _one(
        per_key,
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_total"),
        F.count_if(present).alias("keys_total"),
        F.count_if(repeated).alias("rows_failed"),
        F.coalesce(F.sum(F.when(repeated, F.col("_n"))), F.lit(0)).alias("duplicate_rows"),
    )


def check_unique_many(df: DataFrame, key_sets: Sequence[Sequence[str]]) -> DataFrame:
    """:func:`check_unique` of several keys out of one scan and one shuffle.

    The rows of all key sets go through one aggregate (grouping sets), which counts in each
    task before the shuffle, so a hot key travels as one row per task and set. Adds ``pos``,
    the place of the key set in the list.
    """
    sets = [list(dict.fromkeys(keys)) for keys in key_sets]
    columns = list(dict.fromkeys(c for keys in sets for c in keys))
    # The bits of grouping_id: the first column is the highest, 1 if it is not in the set.
    bits = {c: 1 << i for i, c in enumerate(reversed(columns))}
    number = [sum(b for c, b in bits.items() if c not in keys) for keys in sets]
    distinct_sets = {n: keys for n, keys in zip(number, sets, strict=True)}
    named = df.select(*[F.col(quote_name(c)).alias(f"k{i}") for i, c in enumerate(columns)])
    place = {c: F.col(f"k{i}") for i, c in enumerate(columns)}
    grouped = named.groupingSets([[place[c] for c in keys] for keys in distinct_sets.values()], *[place[c] for c in columns])
    per_key = grouped.agg(F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_set"))
    present = F.lit(False)
    for n, keys in distinct_sets.items():
        present = present | ((F.col("_set") == n) & all_of([place[c].isNotNull() for c in keys]))
    repeated = present & (F.col("_n") > 1)
    per_set = per_key.groupBy("_set").agg(
        F.sum("_n").alias("rows_total"),
        F.count_if(present).alias("keys_total"),
        F.count_if(repeated).alias("rows_failed"),
        F.coalesce(F.sum(F.when(repeated, F.col("_n"))), F.lit(0)).alias("duplicate_rows"),
    )
    # One row per set; an empty table has none there.
    wanted = df.sparkSession.createDataFrame(list(enumerate(number)), "pos int, _set bigint")
    counts = ["rows_total", "keys_total", "rows_failed", "duplicate_rows"]
    return wanted.join(per_set, ["_set"], "left").select("pos", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts])


def orphan_keys(child: DataFrame, key: Sequence[str], parent: DataFrame, parent_key: Sequence[str]) -> DataFrame:
    """Child keys without a parent. Both sides are reduced to one row per key
    before they meet, so a hot key costs no more than any other."""
    children = key_counts(child, key, "rows_per_key")
    parents = renamed_keys(parent, parent_key, key).distinct()
    return children.join(parents, list(key), "left_anti")


def check_relationship(
    child: DataFrame, key: Sequence[str], parent: DataFrame, parent_key: Sequence[str]
) -> DataFrame:
    """``rows_failed`` child rows whose key has no parent, and how many keys."""
    children = key_counts(child, key, "rows_per_key")
    parents = renamed_keys(parent, parent_key, key).distinct().withColumn("_found", F.lit(True))
    matched = children.join(parents, list(key), "left")
    lost = F.col("_found").isNull()
    return _one(
        matched,
        F.coalesce(F.sum("rows_per_key"), F.lit(0)).alias("rows_total"),
        F.coalesce(F.sum(F.when(lost, F.col("rows_per_key"))), F.lit(0)).alias("rows_failed"),
        F.count_if(lost).alias("keys_failed"),
    )


#: Bytes of one bitmap (32,768 keys), and of all bitmaps that a check may broadcast.
BITMAP_BYTES, MOST_BITMAP_BYTES = 4096, 64 * 2**20


def key_bitmaps(df: DataFrame, key: str) -> DataFrame:
    """``bucket, bits``: the whole-number keys that occur, as one bitmap per 32,768 neighbouring keys.
    Each task sends one bitmap per bucket it meets, however often a key occurs."""
    keyed = df.select(F.col(key).cast("bigint").alias("_k")).filter(F.col("_k").isNotNull())
    return keyed.groupBy(F.bitmap_bucket_number("_k").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_k")).alias("bits"))


def _whole(df: DataFrame, key: str) -> bool:
    return isinstance(df.schema[key].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def check_relationship_by_bitmap(
    child: DataFrame, key: Sequence[str], parent: DataFrame, parent_key: Sequence[str], most_bytes: int = MOST_BITMAP_BYTES
) -> DataFrame:
    """:func:`check_relationship` for one whole-number key, without a shuffle of the child's keys.

    The parent's keys become exact bitmaps, which are broadcast once their measured size is
    known to stay within ``most_bytes`` (64 MB hold 500 million neighbouring keys). Rows that
    have a parent are settled where they are read; each task sends one count for them and one
    for each key without a parent. Nothing is guessed: a set bit is a key. Keys of other types,
    composite keys and wider key ranges take the join on reduced keys.
    """
    plain = len(key) != 1 or not _whole(child, key[0]) or not _whole(parent, parent_key[0])
    if not plain:
        bucket = F.bitmap_bucket_number(F.col(parent_key[0]).cast("bigint"))
        n_buckets = parent.filter(F.col(parent_key[0]).isNotNull()).select(bucket.alias("b")).distinct().count()
        plain = n_buckets * BITMAP_BYTES > most_bytes
    if plain:
        return check_relationship(child, key, parent, parent_key)
    keyed = child.select(F.col(key[0]).cast("bigint").alias("_k")).filter(F.col("_k").isNotNull())
    keyed = keyed.withColumn("bucket", F.bitmap_bucket_number("_k"))
    place = F.bitmap_bit_position("_k").cast("int")
    byte = F.conv(F.hex(F.substring(F.col("bits"), F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("int")
    there = F.col("bits").isNotNull() & (byte.bitwiseAND(F.expr("shiftleft(1, cast(bitmap_bit_position(_k) % 8 as int))")) != 0)
    met = keyed.join(F.broadcast(key_bitmaps(parent, parent_key[0])), "bucket", "left")
    per_key = met.groupBy(F.when(~F.coalesce(there, F.lit(False)), F.col("_k")).alias("lost")).agg(F.count(F.lit(1)).alias("_n"))
    lost = F.col("lost").isNotNull()
    return _one(
        per_key,
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_total"),
        F.coalesce(F.sum(F.when(lost, F.col("_n"))), F.lit(0)).alias("rows_failed"),
        F.count_if(lost).alias("keys_failed"),
    )


def coverage(
    entities: DataFrame, key: Sequence[str], records: DataFrame, record_key: Sequence[str], min_pct: float
) -> DataFrame:
    """Share of distinct entities that have at least one record."""
    wanted = renamed_keys(entities, key, key).dropna().distinct()
    present = renamed_keys(records, record_key, key).distinct().withColumn("_found", F.lit(True))
    counts = _one(
        wanted.join(present, list(key), "left"),
        F.count(F.lit(1)).alias("rows_total"),
        F.count("_found").alias("covered"),
    )
    actual = pct2(F.col("covered"), F.col("rows_total"))
    return counts.select(
        "rows_total",
        "covered",
        F.lit(min_pct).cast("double").alias("expected_value"),
        actual.alias("actual_value"),
        F.when(actual.isNull(), "unknown").when(actual >= min_pct, "pass").otherwise("fail").alias("status"),
    )


MOST_ROWS = 2**63 - 1


def join_report(left: DataFrame, left_key: Sequence[str], right: DataFrame, right_key: Sequence[str]) -> DataFrame:
    """What an inner join on the keys would do, without building its rows.

    ``joined_rows`` is exact up to the largest bigint and stays there beyond.
    """
    a = key_counts(left, left_key, "_l")
    b = key_counts(right.select(*[F.col(r).alias(n) for r, n in zip(right_key, left_key, strict=True)]), left_key, "_r")
    both = a.join(b, list(left_key), "full_outer")
    hit = F.col("_l").isNotNull() & F.col("_r").isNotNull()

    def total(expr):
        return F.coalesce(F.sum(expr), F.lit(0)).cast("bigint")

    def wide(name):
        return F.col(name).cast("decimal(19,0)")

    return _one(
        both,
        total(F.when(hit, F.col("_l"))).alias("left_matched"),
        total(F.when(~hit, F.col("_l"))).alias("left_unmatched"),
        total(F.when(hit, F.col("_r"))).alias("right_matched"),
        total(F.when(~hit, F.col("_r"))).alias("right_unmatched"),
        F.least(F.coalesce(F.sum(F.when(hit, wide("_l") * wide("_r"))), F.lit(0)), F.lit(MOST_ROWS)).cast("bigint").alias("joined_rows"),
        F.coalesce(F.max(F.when(hit, F.col("_r"))), F.lit(0)).alias("max_fan_out"),
    )


def equal_rowcount(left: DataFrame, right: DataFrame) -> DataFrame:
    """Row counts of two relations and whether they agree."""
    sides = left.select(F.lit(1).alias("l"), F.lit(0).alias("r")).unionAll(
        right.select(F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    counts = _one(
        sides,
        F.coalesce(F.sum("l"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("r"), F.lit(0)).alias("right_rows"),
    )
    return counts.select(
        "left_rows",
        "right_rows",
        F.when(F.col("left_rows") == F.col("right_rows"), "pass").otherwise("fail").alias("status"),
    )


def cardinality_equality(
    left: DataFrame, left_key: Sequence[str], right: DataFrame, right_key: Sequence[str]
) -> DataFrame:
    """Values whose number of rows differs between two relations."""
    a = key_counts(left, left_key, "left_rows")
    b = key_counts(
        right.select(*[F.col(r).alias(n) for r, n in zip(right_key, left_key, strict=True)]), left_key, "right_rows"
    )
    both = a.join(b, list(left_key), "full_outer").select(
        *left_key,
        F.coalesce("left_rows", F.lit(0)).alias("left_rows"),
        F.coalesce("right_rows", F.lit(0)).alias("right_rows"),
    )
    return both.filter(F.col("left_rows") != F.col("right_rows"))
