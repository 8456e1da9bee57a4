"""Published agreement versions: hashes, reports, breaking changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractcheck.functions.numbers import ntz
from contractcheck.functions.type_trees import type_changes
from contractcheck.operators.ordered import with_prior

# Days of notice a breaking change needs.
NOTICE_DAYS = {"removed": 90, "type_changed": 60, "enum_changed": 30}


def publish(contracts: DataFrame, publisher: str, as_of: str, already: DataFrame | None = None) -> DataFrame:
    """Version-log rows for registry contracts; versions published before are skipped."""
    moment = ntz(as_of)
    rows = contracts.select(
        F.lower(F.concat_ws("_", "domain", "name")).alias("contract_id"),
        F.col("name").alias("contract_name"),
        "version",
        "domain",
        F.col("contract_json").alias("contract_content"),
        moment.alias("published_at"),
        F.lit(publisher).alias("publisher"),
        moment.alias("created_at"),
    )
    if already is None:
        return rows
    known = already.select("contract_id", "version").distinct()
    return rows.join(known, ["contract_id", "version"], "left_anti")


def version_number(version: Column) -> Column:
    """Text such as ``1.10`` as numbers, so that 1.10 comes after 1.9."""
    parts = F.split(version, r"\.")
    return F.transform(parts, lambda p: F.coalesce(p.try_cast("bigint"), F.lit(0)))


def latest_versions(log: DataFrame) -> DataFrame:
    """Per agreement: last publication, the text maximum of the version, and the
    version that is highest as a number."""
    return log.groupBy("contract_id").agg(
        F.max("published_at").alias("last_published_at"),
        F.max("version").alias("latest_version"),
        F.max_by("version", version_number(F.col("version"))).alias("highest_version"),
    )


def recent_publications(log: DataFrame, n: int = 100) -> DataFrame:
    return (
        log.select("contract_id", "contract_name", "version", "domain", "publisher", "published_at")
        .orderBy(F.desc("published_at"), "contract_id", "version")
        .limit(n)
    )


def publisher_activity(log: DataFrame) -> DataFrame:
    return (
        log.groupBy("publisher")
        .agg(
            F.count(F.lit(1)).alias("contracts_published"),
            F.min("published_at").alias("first_published"),
            F.max("published_at").alias("last_published"),
        )
        .orderBy(F.desc("contracts_published"), "publisher")
    )


def content_hashes(log: DataFrame) -> DataFrame:
    """Content hash per version, in version-history order."""
    return log.select(
        "contract_id", "version", F.sha2("contract_content", 256).alias("contract_hash"), "published_at"
    ).orderBy("contract_id", "published_at", "version")


def content_changes(log: DataFrame, tie_break: str = "version", slices: int | None = None) -> DataFrame:
    """Whether each version's content differs from the one published before it.

    Only the hash travels; the text is dropped before any shuffle.
    """
    order = ["published_at", tie_break]
    slim = log.select(
        "contract_id", "version", *[c for c in order if c != "version"],
        F.sha2("contract_content", 256).alias("contract_hash"),
    )
    # The greatest earlier (order, hash) is the row just before, and its last field
    # is the previous hash.
    place = F.struct(*order, "contract_hash")
    seen = with_prior(slim, ["contract_id"], order, maxima={"_before": place}, slices=slices)
    previous = F.col("_before.contract_hash")
    return seen.select(
        "contract_id",
        "version",
        "published_at",
        "contract_hash",
        previous.alias("previous_hash"),
        F.coalesce(previous != F.col("contract_hash"), F.lit(False)).alias("changed"),
    )


def _widened(old: Column, new: Column) -> Column:
    """A decimal that only gained digits."""
    def part(text: Column, i: int) -> Column:
        return F.regexp_extract(text, r"^decimal\((\d+),\s*(\d+)\)$", i).try_cast("int")

    grown = (part(new, 2) >= part(old, 2)) & (part(new, 1) - part(new, 2) >= part(old, 1) - part(old, 2))
    return F.coalesce(grown, F.lit(False))


def diff_versions(old: DataFrame, new: DataFrame) -> DataFrame:
    """``contract_id, column_name, change_type, breaking, notice_days`` between two
    sets of ``contract_id, column_name, data_type, enum_values_json`` rows."""
    keys = ["contract_id", "column_name"]

    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.select(
            *keys,
            F.lit(True).alias(f"_{tag}"),
            F.lower("data_type").alias(f"{tag}_type"),
            F.col("enum_values_json").alias(f"{tag}_enum"),
        )

    both = side(old, "old").join(side(new, "new"), keys, "full_outer")
    retyped = ~F.col("old_type").eqNullSafe(F.col("new_type"))
    change = (
        F.when(F.col("_new").isNull(), "removed")
        .when(F.col("_old").isNull(), "added")
        .when(retyped & _widened(F.col("old_type"), F.col("new_type")), "widened")
        .when(retyped, "type_changed")
        .when(~F.col("old_enum").eqNullSafe(F.col("new_enum")), "enum_changed")
    )
    notice = F.lit(0)
    for kind, days in NOTICE_DAYS.items():
        notice = F.when(F.col("change_type") == kind, F.lit(days)).otherwise(notice)
    return (
        both.withColumn("change_type", change)
        .filter(F.col("change_type").isNotNull())
        .select(
            *keys, "change_type", F.col("change_type").isin(*NOTICE_DAYS).alias("breaking"), notice.alias("notice_days")
        )
    )


def nested_type_changes(old: DataFrame, new: DataFrame, keys: Sequence[str] = ("contract_id",)) -> DataFrame:
    """``keys..., column_name, path, change_type, old_type, new_type, breaking, notice_days``
    between two sets of ``keys..., column_name, data_type`` rows, such as two versions or
    the declared and the real columns.

    Types are compared as trees: ``path`` is ``a.b`` for a field, ``a[]`` for the elements
    of an array, ``a{key}`` and ``a{value}`` for a map, and only the outermost change is
    told. Fields are matched by name, so another order is no change; upper and lower case
    are one. A column without a type on one side counts as retyped.
    """
    on = [*keys, "column_name"]

    def side(df: DataFrame, tag: str) -> DataFrame:
        # Blanks never matter in a type's text; without them equal types are equal text.
        return df.select(*on, F.lit(True).alias(f"_{tag}"), F.regexp_replace(F.lower("data_type"), r"\s+", "").alias(f"{tag}_type"))

    both = side(old, "old").join(side(new, "new"), on, "full_outer")
    whole = (
        F.when(F.col("_new").isNull(), "removed")
        .when(F.col("_old").isNull(), "added")
        .when(F.col("old_type").isNull() | F.col("new_type").isNull(), "type_changed")
    )
    differing = both.filter(whole.isin("removed", "added") | ~F.col("old_type").eqNullSafe(F.col("new_type")))
    flat = differing.filter(whole.isNotNull()).select(*on, F.col("column_name").alias("path"), whole.alias("change_type"), "old_type", "new_type")
    inside = differing.filter(whole.isNull()).select(*on, F.inline(type_changes("column_name", "old_type", "new_type")))
    notice = F.create_map(*[F.lit(x) for pair in NOTICE_DAYS.items() for x in pair])
    return flat.unionByName(inside).select(
        "*", F.col("change_type").isin(*NOTICE_DAYS).alias("breaking"), F.coalesce(notice[F.col("change_type")], F.lit(0)).alias("notice_days")
    )


def deprecation_calendar(contracts: DataFrame, as_of: str) -> DataFrame:
    """Announced removals with the days left, and whether the notice was kept."""
    path = "$.deprecation_policy.example"
    found = contracts.select(
        F.col("id").alias("contract_id"),
        F.get_json_object("contract_json", f"{path}.deprecated_column").alias("column_name"),
        F.get_json_object("contract_json", f"{path}.removal_date").try_cast("date").alias("removal_date"),
        F.get_json_object("contract_json", f"{path}.replacement").alias("replacement"),
    ).filter(F.col("column_name").isNotNull())
    left = F.datediff("removal_date", ntz(as_of).cast("date"))
    return found.withColumn("days_left", left).withColumn(
        "state",
        F.when(left.isNull(), "unknown")
        .when(left < 0, "due")
        .when(left < NOTICE_DAYS["removed"], "notice period")
        .otherwise("announced"),
    )
