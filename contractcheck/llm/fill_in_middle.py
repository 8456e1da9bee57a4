"""Fill-in-the-middle texts by one counted-quantifier match per row.

A unit is a pattern that tiles a text from left to right, by default one code point.
``regexp_count`` gives a text's number of units. Two hash values of the row's id choose
two cuts, and a pattern made for the row, ``(unit{a}+)(unit{b-a}+)(unit*+)``, captures
prefix, middle and suffix in one match; its replacement writes the output. All counted
quantifiers are possessive: they run as loops, keep no state to go back to, and so need
no stack however long the text is. Units are counted in blocks first, so that the list of
matches stays short.

Defined results: a null text is empty. Empty texts and texts with a sentinel inside stay
``plain``, and so does a share of the others. A null id hashes like the empty string. Rows
with equal ids are cut by the same draws. Columns of the input that have a name of the
result are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CODE_POINT = r"(?s:.)"
LINE = r"(?:[^\n]*+\n|[^\n]++)"
BLOCK = 1024


@dataclass(frozen=True)
class Layout:
    """Sentinels, and how often which form is written (percent)."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    plain_from: int = 90
    spm_below: int = 20

    @property
    def marks(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def unit_count(text: Column, unit: str = CODE_POINT) -> Column:
    """How many units the text has: whole blocks first, then the units after them."""
    block = f"(?:{unit}){{{BLOCK}}}+"
    rest = F.regexp_replace(text, f"\\A(?:{block})*+", "")
    return F.regexp_count(text, F.lit(block)).cast("bigint") * BLOCK + F.regexp_count(rest, F.lit(unit))


def draws(id_col: str, seed: str) -> list[Column]:
    """Four unsigned 32-bit numbers from the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]


def _literal(mark: str) -> str:
    """The mark as replacement text."""
    return re.sub(r"([\\$])", r"\\\1", mark)


def _three_parts(first: Column, second: Column, unit: str) -> Column:
    """The row's pattern: prefix, middle and suffix as its three groups."""
    def counted(n: Column) -> list[Column]:
        return [F.lit(f"((?:{unit}){{"), n.cast("string"), F.lit("}+)")]

    return F.concat(F.lit(r"\A"), *counted(first), *counted(second - first), F.lit(f"((?:{unit})*+)\\z"))


def fill_in_middle(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = CODE_POINT, layout: Layout = Layout(), seed: str = "1") -> DataFrame:
    """``df`` with ``n``, ``form``, ``prefix_units``, ``middle_units`` and ``output``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    h1, h2, h3, h4 = draws(id_col, seed)
    marked = text.contains(layout.prefix) | text.contains(layout.suffix) | text.contains(layout.middle)
    plain = (F.col("n") == 0) | marked | (h3 % 100 >= layout.plain_from)
    form = F.when(plain, "plain").when(h4 % 100 < layout.spm_below, "spm").otherwise("psm")
    cut = F.col("form") != "plain"
    first, second = F.least(h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)), F.greatest(h1 % (F.col("n") + 1), h2 % (F.col("n") + 1))
    p, s, m = (_literal(mark) for mark in layout.marks)
    order = F.when(F.col("form") == "spm", f"{s}$3{p}$1{m}$2").otherwise(f"{p}$1{s}$3{m}$2")
    written = F.regexp_replace(text, _three_parts(F.col("prefix_units"), F.col("prefix_units") + F.col("middle_units"), unit), order)
    return (
        df.withColumn("n", unit_count(text, unit))
        .withColumn("form", form)
        .withColumn("prefix_units", F.when(cut, first))
        .withColumn("middle_units", F.when(cut, second - first))
        .withColumn("output", F.when(cut, written).otherwise(text))
    )


def restored(output: Column, form: Column, layout: Layout = Layout()) -> Column:
    """The text that an output was made of; no part holds a mark, so the first one found is the one written."""
    p, s, m = (re.escape(mark) for mark in layout.marks)
    psm = F.regexp_replace(output, f"(?s)\\A{p}(.*?){s}(.*?){m}(.*+)\\z", "$1$3$2")
    spm = F.regexp_replace(output, f"(?s)\\A{s}(.*?){p}(.*?){m}(.*+)\\z", "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fim_digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document, with hashes in the place of the texts."""
    done = fill_in_middle(df.select(id_col, text_col), id_col, text_col)
    return done.select(
        id_col,
        "n",
        "form",
        F.col("prefix_units").alias("prefix_chars"),
        F.col("middle_units").alias("middle_chars"),
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )
