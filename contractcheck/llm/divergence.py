"""How far the sources of a language differ in their words, by count-level bitmaps.

A group is a source of a language; its smoothed share of a term depends on the term's
count in the group alone. So the terms are numbered, and for every (group, count) a bitset
of term numbers is stored. For two groups, the AND of a level of one with a level of the
other, counted, gives the number of terms with that pair of counts, and this times the
difference of the two shares is what those terms add. Terms that one or both lack come by
complement from the sizes of the levels and of the vocabulary.

Terms are numbered within blocks of about ``BLOCK_TERMS`` terms of one language whose
counts have the same magnitude, by falling count, so that equal counts share words of a
bitset; only words with a bit are stored. A block of at most 2 x ``TILE_SOURCES`` groups is
one task's work, whatever the vocabulary and the number of sources. Counting aggregates
before each shuffle, so a hot source sends no more than one row per term and task.

All arithmetic is on whole numbers. Defined results: null text, language and source are
empty strings, and these are values like others. Repeated rows count as often as they
occur. A group without terms still has its row in every pair; without kept terms all values
are 0. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contractcheck.functions.lineage import settled
from contractcheck.llm import words
from contractcheck.operators.lookups import default_salts, lookup_join

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: The same on bytes in which A-Z have become a-z.
TERM_BYTES = words.byte_table(bytes([*range(97, 123), *range(128, 256)]))
SLICE_BYTES = 4 << 20
MIN_DOCS, UNIT, SMOOTH, TOP = 30, 1_000_000_000, 5, 50
BLOCK_TERMS, TILE_SOURCES = 512, 64
BLOCK = ["lang", "magnitude", "block"]


def _counted(s: words.Slice, groups: np.ndarray) -> dict[str, np.ndarray]:
    """Terms of a slice per group: start and length of one occurrence in the lowered bytes, ``n`` and ``d``."""
    low = words.LOWER[s.buf]
    starts, ends = s.spans(TERM_BYTES, low)
    text = np.searchsorted(s.offsets, starts, "right") - 1
    _, first, same = np.unique(words.hash_spans(low, starts, ends), return_index=True, return_inverse=True)
    if not words.equal_spans(low, starts, ends, first[same]):
        _, first, same = np.unique([low[x:y].tobytes() for x, y in zip(starts, ends, strict=True)], return_index=True, return_inverse=True)
    n_terms = max(1, len(first))
    keys, n = np.unique(groups[text] * n_terms + same, return_counts=True)
    once = np.unique(text * n_terms + same)
    d = np.bincount(np.searchsorted(keys, groups[once // n_terms] * n_terms + once % n_terms), minlength=len(keys))
    at = first[keys % n_terms] if len(first) else keys
    return {"group": keys // n_terms, "start": starts[at], "length": (ends - starts)[at], "n": n, "d": d, "low": low}


def _strings(buf: np.ndarray, starts: np.ndarray, length: np.ndarray) -> pa.Array:
    ends = np.cumsum(length)
    inside = np.arange(int(length.sum())) - np.repeat(ends - length, length)
    offsets = np.concatenate(([0], ends)).astype(np.int32)
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(buf[np.repeat(starts, length) + inside]))


def _batches(batches):
    for batch in batches:
        names = [batch.column(i).dictionary_encode() for i in (0, 1)]
        codes = [c.indices.to_numpy().astype(np.int64) for c in names]
        width = max(1, len(names[1].dictionary))
        for s in words.slices(batch.column(2), SLICE_BYTES):
            found = _counted(s, (codes[0] * width + codes[1])[s.first : s.first + s.n])
            lang, source = (d.dictionary.take(pa.array(c)) for d, c in zip(names, np.divmod(found["group"], width), strict=True))
            terms = _strings(found["low"], found["start"], found["length"])
            yield pa.RecordBatch.from_arrays([lang, source, terms, pa.array(found["n"], pa.int64()), pa.array(found["d"], pa.int64())], ["lang", "source", "term", "n", "d"])


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``term``: occurrences ``n`` and number of rows ``d`` that hold the term.

    ``docs`` has ``lang``, ``source`` and ``text`` without nulls. Each task counts slices of
    its texts first, so that only sums travel.
    """
    part = docs.select("lang", "source", "text").mapInArrow(_batches, "lang string, source string, term string, n bigint, d bigint")
    return part.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))


def kept_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The counts of terms in at least ``min_docs`` rows of their language, with their ``total`` there."""
    everywhere = Window.partitionBy("lang", "term")
    counted = term_counts(docs).withColumn("total", F.sum("n").over(everywhere)).withColumn("rows", F.sum("d").over(everywhere))
    return counted.filter(F.col("rows") >= min_docs).select("lang", "source", "term", "n", "total")


def share(n: Column, size: Column, terms: Column) -> Column:
    """The smoothed share of a term with ``n`` occurrences in parts of ``UNIT``, rounded down, and 1."""
    top = (n + SMOOTH).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    base = (size + SMOOTH * terms).cast("decimal(20,0)")
    quotient = F.call_function("div", top, F.when(base > 0, base))
    return F.coalesce(quotient + 1, F.lit(1)).cast("bigint")


def group_sizes(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Every group: its ``size`` in kept terms, its language's ``lang_size`` and number of ``terms``."""
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    vocabulary = kept.groupBy("lang", "term").agg(F.max("total").alias("total")).groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("lang_size"))
    none = {"size": 0, "lang_size": 0, "terms": 0}
    return docs.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(vocabulary, ["lang"], "left").fillna(none)


def numbered(kept: DataFrame) -> DataFrame:
    """Every kept term's ``magnitude``, ``block`` and number ``at`` in the block."""
    terms = kept.groupBy("lang", "term").agg(F.max("total").alias("total")).withColumn("magnitude", F.length(F.bin("total")))
    blocks = terms.groupBy("lang", "magnitude").agg(F.ceil(F.count(F.lit(1)) / BLOCK_TERMS).alias("blocks"))
    placed = lookup_join(terms, blocks, ["lang", "magnitude"], "inner", default_salts(terms), ["term"]).withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")))
    order = Window.partitionBy(*BLOCK).orderBy(F.desc("total"), "term")
    return placed.select("lang", "term", "magnitude", "block", (F.row_number().over(order) - 1).alias("at"))


def levels(kept: DataFrame, places: DataFrame, groups: DataFrame) -> DataFrame:
    """The bitsets: one row per block, group, count and non-empty ``word`` of 64 term numbers."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("at") % 64)
    stored = kept.join(places, ["lang", "term"]).groupBy(*BLOCK, "source", "n", F.floor(F.col("at") / 64).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits"))
    return stored.join(groups.select("lang", "source", "size", "terms", "tile", "tiles"), ["lang", "source"])


def _pair_sums(key, rows):
    """Sums of one block over the pairs of two tiles' groups (of one tile: each pair once)."""
    first, second = key[-2].as_py(), key[-1].as_py()
    columns = {c: rows.column(c).to_numpy() for c in ("word", "bits", "p", "n_terms", "tile")}
    source = np.array(rows.column("source").to_pylist(), dtype=object)
    empty = columns["word"] < 0
    names, which = np.unique(source[empty], return_index=True)
    tiles, nothing = columns["tile"][empty][which], columns["p"][empty][which]
    in_block, n = int(columns["n_terms"][empty][0]), len(names)
    owner = np.searchsorted(names, source)
    order = np.lexsort((owner, columns["word"]))[empty.sum() :]
    owner, word, p = owner[order], columns["word"][order], columns["p"][order]
    bits = columns["bits"][order].view(np.uint64)
    size = np.bitwise_count(bits).astype(np.int64)

    held = np.bincount(owner, weights=size, minlength=n).astype(np.int64)
    one_lacks = np.zeros((n, n), np.int64)
    for b in range(n):
        np.add.at(one_lacks[:, b], owner, size * np.abs(p - nothing[b]))
    both_lack = np.abs(nothing[:, None] - nothing[None, :])
    total = one_lacks + one_lacks.T + (in_block - held[:, None] - held[None, :]) * both_lack

    edges = np.flatnonzero(np.diff(word, prepend=-1, append=-2)) if len(word) else np.zeros(1, int)
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        them, starts = np.unique(owner[lo:hi], return_index=True)
        for a, x, y in zip(them, starts, [*starts[1:], hi - lo], strict=True):
            mine = slice(lo + x, lo + y)
            joint = np.bitwise_count(bits[mine, None] & bits[None, lo:hi]).astype(np.int64)
            f = np.abs(p[mine, None] - p[None, lo:hi])
            f -= np.abs(p[mine, None] - nothing[None, owner[lo:hi]])
            f -= np.abs(nothing[a] - p[None, lo:hi])
            f += both_lack[a][owner[lo:hi]][None, :]
            total[a, them] += np.add.reduceat((joint * f).sum(axis=0), starts)

    a, b = np.nonzero((tiles[:, None] == first) & (tiles[None, :] == second))
    once = (a < b) if first == second else np.ones(len(a), bool)
    a, b = a[once], b[once]
    done = {"lang": [key[0].as_py()] * len(a), "source": list(names[a]), "item": list(names[b]), "value": total[a, b]}
    return pa.table(done, pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())]))


def pair_divergence(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``item``, ``value``: summed differences of shares, both ways round."""
    tiles = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / TILE_SOURCES).cast("int").alias("tiles"))
    tiled = groups.join(tiles, ["lang"]).withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int"))
    places = numbered(kept)
    blocks = places.groupBy(*BLOCK).agg(F.count(F.lit(1)).alias("n_terms"))
    # A block without terms, so that pairs of a language without kept terms get their 0.
    no_terms = groups.select("lang").distinct().select("lang", F.lit(0).alias("magnitude"), F.lit(0).cast("bigint").alias("block"), F.lit(0).cast("bigint").alias("n_terms"))
    columns = [*BLOCK, "source", "n", "word", "bits", "size", "terms", "tile", "tiles", "n_terms"]
    zeros = (
        blocks.unionByName(no_terms)
        .join(tiled, ["lang"])
        .withColumns({"n": F.lit(0).cast("bigint"), "word": F.lit(-1), "bits": F.lit(0).cast("bigint")})
        .select(columns)
    )
    stored = levels(kept, places, tiled).withColumn("n_terms", F.lit(0).cast("bigint")).select(columns)
    rows = stored.unionByName(zeros).withColumn("p", share(F.col("n"), F.col("size"), F.col("terms")))
    others = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    dealt = (
        rows.select(*BLOCK, "source", "word", "bits", "p", "n_terms", "tile", others.alias("other"))
        .withColumns({"tile_a": F.least("tile", "other"), "tile_b": F.greatest("tile", "other")})
        .drop("other")
    )
    schema = "lang string, source string, item string, value bigint"
    sums = dealt.groupBy(*BLOCK, "tile_a", "tile_b").applyInArrow(_pair_sums, schema).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))
    return sums.select("lang", "value", F.inline(both)).select("lang", "source", "item", "value")


def term_divergence(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``item``, ``value``: terms that a group uses more than its language does."""
    rows = kept.join(groups, ["lang", "source"])
    p = share(F.col("n"), F.col("size"), F.col("terms"))
    q = share(F.col("total"), F.col("lang_size"), F.col("terms"))
    return rows.select("lang", "source", F.col("term").alias("item"), (p - q).alias("value")).filter(F.col("value") > 0)


def ranked(rows: DataFrame, part: str, top: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    placed = rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return placed if top is None else placed.filter(F.col("rank") <= top)


def source_divergence(df: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """Per group: its distance from each other source of the language, and its ``top`` overused terms."""
    names = {"lang": lang_col, "source": source_col, "text": text_col}
    docs = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(k) for k, c in names.items()])
    kept = settled(kept_counts(docs, min_docs))
    groups = settled(group_sizes(docs, kept))
    pairs = ranked(pair_divergence(kept, groups), "pair")
    return pairs.unionByName(ranked(term_divergence(kept, groups), "term", top))
