"""Document fingerprints from closed syncmers.

A run of ``K`` code points is an anchor if the smallest hash of its inner runs of ``S``
stands first or last among them. That depends on the run alone: whatever stands around
it, the same run is chosen in every text, and at least one of ``K - S`` neighbouring
runs is. An anchor is its place and a hash of the run, packed into one number; the
fingerprint lists each anchor's distance from the one before and its hash.

Two fingerprints are compared by position: neighbouring anchors form a link of both
hashes and their distance, and likeness is the Dice coefficient of the sets of links.
A shift of a whole passage keeps its links, a change touches those around it.

Because anchors are free of context, the anchors of a text whose end is replaced are
put together from those of both texts; only the ``K - 1`` runs across the seam are new.

DataFrame functions only. Long texts are looked at in pieces of ``PIECE`` code points
that overlap by ``K - 1``, so work and memory follow the length of the text.

Defined results: a null text is empty; the empty text has an empty fingerprint, and a
text shorter than ``K`` one anchor, the hash of it all. Two empty fingerprints are alike
(1), an empty and another one are not (0). The next document is the next one by falling
id, null ids last; rows of one id follow each other by falling hash of the text, so repeated rows are
each other's next. A single row is its own next. An empty table gives no rows. Only id
and text are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contractcheck.operators.ordered import slice_of

K, S, PIECE = 40, 8, 2048
#: Inner runs beside the last one; hashes are compared by doubling, so a power of two.
SPAN = K - S
HASH_BITS = 32


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def _packed(place: Column, key: Column) -> Column:
    return F.shiftleft(place.cast("bigint"), HASH_BITS).bitwiseOR(F.shiftrightunsigned(key, 64 - HASH_BITS))


def place(anchor: Column) -> Column:
    return F.shiftright(anchor, HASH_BITS)


def key(anchor: Column) -> Column:
    return anchor.bitwiseAND(F.lit((1 << HASH_BITS) - 1))


def _moved(anchors: Column, by: Column) -> Column:
    return F.transform(anchors, lambda a: a + F.shiftleft(by.cast("bigint"), HASH_BITS))


def _smallest(low: Column, step: int, use: Callable[[Column], Column]) -> Column:
    """``use`` of the minima over ``SPAN`` neighbours, by doubling, from those over ``step``."""
    if step == SPAN:
        return use(low)
    after = F.slice(low, step + 1, F.greatest(F.size(low) - step, F.lit(0)))
    return _let(F.zip_with(low, after, lambda x, y: F.least(x, y)), lambda wider: _smallest(wider, 2 * step, use))


def _runs(piece: Column) -> Column:
    """Anchors of all runs of ``K`` in a short text."""

    def chosen(h: Column, low: Column) -> Column:
        last = F.size(h) - SPAN
        starts = F.filter(
            F.when(last > 0, F.sequence(F.lit(0), last - 1)).otherwise(F.array().cast("array<int>")),
            lambda i: (F.get(h, i) <= F.get(low, i + 1)) | (F.get(h, i + SPAN) <= F.get(low, i)),
        )
        return F.transform(starts, lambda i: _packed(i, F.xxhash64(*[F.get(h, i + j) for j in range(0, K, S)])))

    inner = F.regexp_extract_all(piece, F.lit(f"(?s)(?=(.{{{S}}}+))."), 1)
    return _let(F.transform(inner, lambda x: F.xxhash64(x)), lambda h: _smallest(h, 1, lambda low: chosen(h, low)))


def run_anchors(text: Column) -> Column:
    """Packed anchors of all runs of ``K`` code points, by place."""
    pieces = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{1,{PIECE + K - 1}}}+)).{{1,{PIECE}}}+"), 1)
    return F.flatten(F.transform(pieces, lambda piece, i: _moved(_runs(piece), i * PIECE)))


def _short(text: Column) -> Column:
    return F.array(_packed(F.lit(0), F.xxhash64(text)))


def _or_short(anchors: Column, text: Column, n_chars: Column) -> Column:
    none = F.array().cast("array<bigint>")
    return F.when(n_chars >= K, anchors).when(n_chars > 0, _short(text)).otherwise(none)


def anchors_of(text: Column) -> Column:
    return _or_short(run_anchors(text), text, F.char_length(text))


def spliced(head: Column, head_anchors: Column, keep: Column, tail: Column, tail_anchors: Column, take: Column) -> Column:
    """Anchors of ``keep`` code points of one text and then ``take`` of another."""
    seam_at = F.greatest(keep - K + 1, F.lit(0))
    seam = F.concat(head.substr(seam_at + 1, keep - seam_at), tail.substr(F.lit(1), F.least(take, F.lit(K - 1))))
    before = F.filter(head_anchors, lambda a: place(a) <= keep - K)
    after = F.filter(tail_anchors, lambda a: place(a) <= take - K)
    return _or_short(F.concat(before, _moved(_runs(seam), seam_at), _moved(after, keep)), seam, keep + take)


def fingerprint(anchors: Column) -> Column:
    """Two hex digits of distance and eight of hash per anchor; distances never exceed ``SPAN``."""
    def item(a: Column, i: Column) -> Column:
        gap = place(a) - F.when(i > 0, place(F.get(anchors, i - 1))).otherwise(F.lit(0))
        return F.lower(F.lpad(F.hex(F.shiftleft(gap, HASH_BITS).bitwiseOR(key(a))), 10, "0"))

    return F.array_join(F.transform(anchors, item), "")


def links(anchors: Column) -> Column:
    """The set of links, and the first anchor, which alone is all a short text has."""
    def link(a: Column, i: Column) -> Column:
        before = F.get(anchors, i - 1)
        return F.when(i > 0, F.xxhash64(key(before), key(a), place(a) - place(before))).otherwise(F.xxhash64(key(a)))

    return F.array_distinct(F.transform(anchors, link))


def likeness(one: Column, other: Column) -> Column:
    """Dice coefficient of two sets of links."""
    both, size = F.size(F.array_intersect(one, other)), F.size(one) + F.size(other)
    return F.when(size == 0, 1.0).otherwise(2.0 * both / size)


def with_next(rows: DataFrame, order_by: list[str], derive: Callable[[DataFrame], DataFrame], slices: int | None = None) -> DataFrame:
    """``derive(rows)`` and, as ``next``, a struct of the next row by falling order; the first follows the last.

    The order is cut into slices by its first two columns, each of which is one task's window.
    The last row of each slice is looked up in a scan of its own, which derives nothing.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = rows.withColumn("_slice", slice_of(rows, order_by[:2], slices or 2 * tasks))
    whole = derive(numbered)
    columns = [c for c in whole.columns if c != "_slice"]
    order = Window.partitionBy("_slice").orderBy(*order_by)
    # Column by column: a struct would be made before the shuffle and travel beside its parts.
    lags = [F.lag(c).over(order).alias(f"_before_{c}") for c in columns]
    inside = whole.select("*", F.lag("_slice").over(order).isNull().alias("_first"), *lags)
    top = numbered.groupBy("_slice").agg(F.max(F.struct(*order_by)).alias("top"))
    ends = derive(top.select("_slice", "top.*")).select("_slice", F.struct(*columns).alias("_end"))
    # One row per slice: the end of the slice before, and for the first slice that of the last.
    around = Window.orderBy("_slice")
    last = F.max_by("_end", "_slice").over(Window.partitionBy())
    edges = ends.select("_slice", F.coalesce(F.lag("_end").over(around), last).alias("_edge"))
    before = F.struct(*[F.col(f"_before_{c}").alias(c) for c in columns])
    found = inside.join(edges, "_slice", "left")
    return found.select(*columns, F.when(F.col("_first"), F.col("_edge")).otherwise(before).alias("next"))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", slices: int | None = None) -> DataFrame:
    """Per row: its fingerprint, that of its text with the last third replaced by the next one's start, and likenesses."""
    texts = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = with_next(texts.select("id", F.xxhash64("text").alias("hash"), "text"), ["id", "hash", "text"], lambda d: d.withColumn("anchors", anchors_of(F.col("text"))), slices)
    n = F.char_length("text")
    sized = rows.withColumn("n_chars", n).withColumn("keep", n - F.floor(n / 3).cast("int"))
    cut = sized.withColumn("take", F.least(F.col("n_chars") - F.col("keep"), F.char_length("next.text")))
    edited = cut.withColumns(
        {
            "edited": F.concat(F.col("text").substr(F.lit(1), F.col("keep")), F.col("next.text").substr(F.lit(1), F.col("take"))),
            "edited_anchors": spliced(F.col("text"), F.col("anchors"), F.col("keep"), F.col("next.text"), F.col("next.anchors"), F.col("take")),
        }
    )
    linked = edited.withColumn("links", links(F.col("anchors")))
    return linked.select(
        F.col("id").alias(id_col),
        F.col("n_chars").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("anchors")).alias("fingerprint"),
        fingerprint(F.col("edited_anchors")).alias("edited_fingerprint"),
        likeness(F.col("links"), links(F.col("edited_anchors"))).alias("near_edited"),
        likeness(F.col("links"), links(F.col("next.anchors"))).alias("near_next"),
    )
