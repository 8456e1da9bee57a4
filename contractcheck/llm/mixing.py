"""Mixing sources to target weights by capped water-filling.

Every source gets a share of the mix by its weight, but at most ``max_epochs``
times its own size; what a clamped source cannot take goes to the others by their
weights, until none is above its limit. With sources in the order of how soon they
are full, the water level is a running sum, so no rounds are needed.

A document is taken some whole times, and once more if its draw lies below its
source's cut. Draws are seeded hashes of id and text, so reruns agree. The cut is
found from sizes summed per source and draw (two levels of 4,096 steps), so that
the words taken meet the target as closely as one step allows, whatever the sizes.

DataFrame functions only. The list of sources, not of documents, is ordered in one
task. It is broadcast only if it has at most ``BROADCAST_SOURCES`` rows.

Defined results: null and empty texts have size 0 and are taken 0 words. A null
source is a source, the last one. Rows equal in id and text draw alike. An empty
table gives no rows; if all sizes are 0 so are the targets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contractcheck.functions.lineage import settled

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, SHARE, MAX_EPOCHS, SEED = (5, 2, 1), 1.5, 2, "mix-1"
BROADCAST_SOURCES = 100_000
STEPS = 4096


def word_count(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint")


def draw(id_col: str, text_col: str, seed: str = SEED) -> Column:
    """A number from 0 to 2**24 - 1 that depends on seed, id and text."""
    said = F.concat(F.lit(seed + "|"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("|"), F.coalesce(F.col(text_col), F.lit("")))
    return F.conv(F.substring(F.md5(said.cast("binary")), 1, 6), 16, 10).cast("int")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``source``, ``source_size`` to ``source``, ``source_size``, ``target``, by water-filling."""
    order = Window.orderBy(F.col("source").isNull(), "source")
    nth = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weighed = sizes.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (nth + 1).cast("int")))
    cap = (F.col("source_size") * max_epochs).cast("double")
    full = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), "source")
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    onward = full.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    levels = (
        weighed.withColumn("cap", cap)
        .withColumn("room", F.sum("source_size").over(every) * F.lit(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("open", F.sum("w").over(onward))
        .withColumn("clamped", F.col("w") * F.col("room") / F.col("open") >= F.col("cap"))
    )
    # The level is that of the first source that is not clamped; all after it are open too.
    at = F.min(F.when(~F.col("clamped"), F.struct("k", "room", "open"))).over(every)
    return (
        levels.withColumn("k", F.row_number().over(full))
        .withColumn("at", at)
        .select("source", "source_size", F.when(F.col("at").isNull() | (F.col("k") < F.col("at.k")), F.col("cap")).otherwise(F.col("w") * F.col("at.room") / F.col("at.open")).alias("target"))
    )


def plan(drawn: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Rows of ``source``, ``size``, ``draw`` to one per source: target, whole repetitions, ``cut``."""
    fine = settled(drawn.groupBy("source", "draw").agg(F.sum("size").alias("size")))
    sizes = fine.groupBy("source").agg(F.sum("size").alias("source_size"))
    aimed = settled(
        targets(sizes, weights, share, max_epochs)
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint"))
        .withColumn("extra", F.col("target") - F.col("whole") * F.col("source_size"))
    )
    small = aimed.count() <= BROADCAST_SOURCES

    def with_aim(df: DataFrame, aims: DataFrame) -> DataFrame:
        aims = aims.withColumnRenamed("source", "s")
        return df.join(F.broadcast(aims) if small else aims, F.col("source").eqNullSafe(F.col("s"))).drop("s")

    def first_over(df: DataFrame, level: str, base: str) -> DataFrame:
        """Per source the first step at which the running size reaches ``extra``."""
        running = Window.partitionBy("source").orderBy(level).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ended = df.withColumn("upto", F.col(base) + F.sum("size").over(running)).where("upto >= extra")
        return ended.groupBy("source").agg(F.min(F.struct(F.col(level), F.col("upto"), F.col("size"))).alias("f"))

    coarse = fine.groupBy("source", F.floor(F.col("draw") / STEPS).cast("int").alias("high")).agg(F.sum("size").alias("size"))
    coarse = with_aim(coarse, aimed.select("source", "extra")).withColumn("zero", F.lit(0).cast("bigint"))
    edge = first_over(coarse, "high", "zero").select("source", F.col("f.high").alias("high"), (F.col("f.upto") - F.col("f.size")).alias("under"))
    edge = settled(edge.join(aimed.select(F.col("source").alias("s"), "extra"), F.col("source").eqNullSafe(F.col("s"))).drop("s"))
    inner = with_aim(fine, edge).where(F.floor(F.col("draw") / STEPS) == F.col("high"))
    ends = first_over(inner, "draw", "under").join(aimed.select(F.col("source").alias("s"), "extra"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    missing = F.col("extra") - (F.col("f.upto") - F.col("f.size"))
    cuts = ends.select(F.col("source").alias("s"), (F.col("f.draw") + F.when(missing >= F.col("f.size") / 2, 1).otherwise(0)).cast("int").alias("cut"))
    return aimed.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left").select("source", "source_size", "target", "whole", F.coalesce("cut", F.lit(0)).alias("cut"))


def _planned(df: DataFrame, drawn: DataFrame, weights: tuple[int, ...], share: float, max_epochs: int) -> DataFrame:
    """``df`` (with ``__llm_source``, ``__llm_draw``) joined with its sources' plan; ``__llm_copies`` added."""
    each = settled(plan(drawn, weights, share, max_epochs))
    named = each.select(*[F.col(c).alias(f"__llm_{c}" if c != "source" else "__llm_s") for c in each.columns])
    named = F.broadcast(named) if each.count() <= BROADCAST_SOURCES else named
    joined = df.join(named, F.col("__llm_source").eqNullSafe(F.col("__llm_s")))
    return joined.withColumn("__llm_copies", F.col("__llm_whole") + (F.col("__llm_draw") < F.col("__llm_cut")).cast("bigint"))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """Per input row: id, ``size``, ``source_size``, ``target``, ``taken``. Texts are read once."""
    sized = settled(df.select(F.col(id_col).alias("__llm_id"), F.col(source_col).alias("__llm_source"), word_count(text_col).alias("__llm_size"), draw(id_col, text_col, seed).alias("__llm_draw")))
    drawn = sized.select(F.col("__llm_source").alias("source"), F.col("__llm_size").alias("size"), F.col("__llm_draw").alias("draw"))
    return _planned(sized, drawn, weights, share, max_epochs).select(
        F.col("__llm_id").alias(id_col), F.col("__llm_size").alias("size"), F.col("__llm_source_size").alias("source_size"), F.col("__llm_target").alias("target"), (F.col("__llm_size") * F.col("__llm_copies")).alias("taken")
    )


def mixed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The mix itself: the rows of ``df`` that are taken, with ``size`` and ``copies`` (times taken) added.

    A column of ``df`` with one of these names is replaced. Rows without words are left out.
    """
    drawn = df.select(F.col(source_col).alias("source"), word_count(text_col).alias("size"), draw(id_col, text_col, seed).alias("draw"))
    named = df.withColumn("__llm_source", F.col(source_col)).withColumn("__llm_draw", draw(id_col, text_col, seed)).withColumn("__llm_size", word_count(text_col))
    taken = _planned(named, drawn, weights, share, max_epochs).where("__llm_copies > 0 AND __llm_size > 0")
    own = [c for c in df.columns if c not in ("size", "copies")]
    return taken.select(*own, F.col("__llm_size").alias("size"), F.col("__llm_copies").alias("copies"))
