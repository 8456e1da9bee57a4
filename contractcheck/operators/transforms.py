"""Model transforms: staging, dimension, category, currency and activity rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractcheck.functions.numbers import ntz
from contractcheck.operators.lookups import lookup_join
from contractcheck.operators.ordered import with_prior


def blank_to_date(text: Column, strict: bool = True) -> Column:
    """Blank text becomes NULL, other text a date. ``strict`` fails on malformed
    text, otherwise it becomes NULL too."""
    filled = F.when(F.trim(text) != "", text)
    return filled.cast("date") if strict else filled.try_cast("date")


def staging(df: DataFrame, date_columns: Sequence[str], strict: bool = True) -> DataFrame:
    return df.select(
        *[blank_to_date(F.col(c), strict).alias(c) if c in date_columns else F.col(c) for c in df.columns]
    )


def malformed_dates(df: DataFrame, date_columns: Sequence[str]) -> DataFrame:
    """Rows per column whose text is neither blank nor a date, in one pass."""
    wide = df.agg(
        *[
            F.count_if((F.trim(c) != "") & F.col(c).try_cast("date").isNull()).alias(c)
            for c in date_columns
        ]
    )
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("rows_failed")) for c in date_columns]
    return wide.select(F.inline(F.array(*rows)))


def dimension(staged: DataFrame, columns: Sequence[str]) -> DataFrame:
    return staged.select(*columns)


def standardise(df: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """Replace category spellings. ``mapping`` holds ``raw, standard``; values it
    lacks are upper-cased and trimmed."""
    clean = F.upper(F.trim(column))
    rules = mapping.groupBy(F.upper(F.trim("raw")).alias("_key")).agg(F.min("standard").alias("_standard"))
    joined = lookup_join(df.withColumn("_key", clean), rules, ["_key"], "left")
    return joined.select(
        *[F.coalesce("_standard", "_key").alias(c) if c == column else F.col(c) for c in df.columns]
    )


def _one_rate(rates: DataFrame) -> DataFrame:
    """One row per currency and day: its ``rate``, NULL where several differ, and how many there are."""
    per_day = rates.dropna(subset=["currency", "day", "rate"]).groupBy("currency", "day").agg(F.min("rate").alias("_low"), F.max("rate").alias("_high"))
    conflict = F.col("_low") != F.col("_high")
    return per_day.select("currency", "day", F.when(~conflict, F.col("_low")).alias("rate"), conflict.alias("conflict"))


def _converted(amount: Column, rate: Column, scale: int) -> Column:
    """The product of both as they are, rounded once."""
    return F.round(amount * rate, scale).cast(f"decimal(38,{scale})")


def _rate_status(found: Column, conflict: Column) -> Column:
    return F.when(conflict, "several rates").when(found.isNull(), "no rate").otherwise("ok")


def convert_currency(
    df: DataFrame, amount: str, currency: str, day: str, rates: DataFrame, into: str = "amount_usd", scale: int = 2
) -> DataFrame:
    """Multiply by the rate of the day. ``rates`` holds ``currency, day, rate``.

    Amounts and rates are multiplied with all their digits and the product is rounded once.
    ``<into>_status`` is ``ok``, ``no rate``, or ``several rates`` where a day has rates
    that differ; the last two keep a NULL amount.
    """
    daily = _one_rate(rates).select(
        F.col("currency").alias(currency), F.col("day").alias(day), F.col("rate").alias("_rate"), F.col("conflict").alias("_conflict")
    )
    joined = lookup_join(df, daily, [currency, day], "left")
    status = _rate_status(F.col("_rate"), F.col("_conflict"))
    return joined.select(*df.columns, _converted(F.col(amount), F.col("_rate"), scale).alias(into), status.alias(f"{into}_status"))


def convert_as_of(
    df: DataFrame, amount: str, currency: str, day: str, rates: DataFrame, key: str, into: str = "amount_usd", scale: int = 2, slices: int | None = None
) -> DataFrame:
    """Multiply by the newest rate up to the row's day.

    Rates and amounts are put in one order per currency and the last rate is carried on. A
    currency that owns most rows is cut into slices of that order (:func:`with_prior`), so
    none is one task's work. ``key`` identifies the rows of ``df``. Adds ``rate_day`` too.
    """
    known = _one_rate(rates).select(
        F.col("currency").alias("_c"), F.col("day").alias("_d"), F.lit(0).alias("_kind"), F.lit(None).cast(df.schema[key].dataType).alias("_key"),
        F.struct(F.col("day").alias("d"), F.col("rate").alias("r"), F.col("conflict").alias("x")).alias("_known"), F.lit(None).cast(df.schema).alias("_row"),
    )
    wanted = df.select(
        F.col(currency).alias("_c"), F.col(day).alias("_d"), F.lit(1).alias("_kind"), F.col(key).alias("_key"),
        F.lit(None).cast(known.schema["_known"].dataType).alias("_known"), F.struct(*df.columns).alias("_row"),
    )
    carried = with_prior(known.unionAll(wanted), ["_c"], ["_d", "_kind", "_key"], maxima={"_last": F.col("_known")}, slices=slices)
    status = _rate_status(F.col("_last.r"), F.coalesce("_last.x", F.lit(False)))
    rows = carried.filter(F.col("_kind") == 1)
    return rows.select(
        "_row.*", F.col("_last.d").alias("rate_day"), _converted(F.col(f"_row.{amount}"), F.col("_last.r"), scale).alias(into), status.alias(f"{into}_status")
    )


def last_known_rates(rates: DataFrame, as_of: str) -> DataFrame:
    """One rate per currency: the newest up to ``as_of``."""
    return (
        rates.filter(F.col("day") <= ntz(as_of).cast("date"))
        .groupBy("currency")
        .agg(F.max_by("rate", "day").alias("rate"), F.max("day").alias("day"))
    )


def dormant(activity: DataFrame, keys: Sequence[str], ts: str, as_of: str, days: int = 90) -> DataFrame:
    """Entities whose last activity lies more than ``days`` days back."""
    last = activity.groupBy(*keys).agg(F.max(ts).alias("last_activity"))
    idle = F.datediff(ntz(as_of).cast("date"), F.col("last_activity").cast("date"))
    return last.select(*keys, "last_activity", idle.alias("idle_days"), (idle > days).alias("dormant"))


def tagged(contracts: DataFrame) -> DataFrame:
    """``contract_id, tag, value`` per tag; plain tags have no value."""
    tags = F.from_json(F.get_json_object("contract_json", "$.tags"), "array<string>")
    rows = contracts.select(F.col("id").alias("contract_id"), F.explode_outer(tags).alias("t")).filter(F.col("t").isNotNull())
    mapped = F.col("t").startswith("{")
    return rows.select(
        "contract_id",
        F.when(mapped, F.json_object_keys("t")[0]).otherwise(F.col("t")).alias("tag"),
        F.when(mapped, F.map_values(F.from_json("t", "map<string,string>"))[0]).alias("value"),
    )


def by_tag(contracts: DataFrame, tag: str) -> DataFrame:
    """Registry rows that carry a tag."""
    hits = tagged(contracts).filter(F.col("tag") == tag).select(F.col("contract_id").alias("id")).distinct()
    return contracts.join(hits, ["id"], "left_semi")


def pii_columns(contracts: DataFrame) -> DataFrame:
    return tagged(contracts).filter(F.col("tag") == "pii").select("contract_id", F.col("value").alias("column_name"))
