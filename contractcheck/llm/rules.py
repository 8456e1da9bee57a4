"""Quality rules as a ledger: every rule is evaluated once, policies come later.

A ledger row holds the measurements of a text and ``bits``, where bit ``i`` says
that rule ``i`` fails. A policy is a named, versioned set of rules; applying one
and asking what each rule alone removes are bitwise operations on ``bits``, with
no second look at any text.

Defined results: a null or empty text has no words, all measurements are 0 and
the rule ``few_words`` fails. Every input row gives one row; repeated rows give
repeated results; other columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractcheck.llm.words import NOT_BLANK, byte_table, hash_spans, map_columns, slices

SYMBOLS = byte_table(b"#*$%&|<>")
UPPER = byte_table(bytes(range(65, 91)))
LETTER = byte_table(bytes([*range(65, 91), *range(97, 123)]))

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_letters", "longest_word")

#: Rules in the order of their bits. New rules are added at the end only, so that old ledgers stay readable.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "many_symbols": "10 * n_symbols > 5 * n_words",
    "duplicate_lines": "10 * n_dup_lines > 3 * n_lines",
    "shouting": "10 * n_upper > 6 * n_letters",
    "long_words": "word_chars > 15 * n_words",
    "short_words": "10 * word_chars < 15 * n_words",
    "endless_word": "longest_word > 1000",
}

#: A text is kept if none of the rules of the policy fails.
POLICIES: dict[str, tuple[str, ...]] = {
    "base-1": ("few_words", "repeated_words"),
    "web-1": ("few_words", "repeated_words", "many_symbols", "shouting"),
    "web-2": ("few_words", "repeated_words", "many_symbols", "shouting", "duplicate_lines", "long_words", "short_words", "endless_word"),
}


def repeated_ngram_words(hashes: np.ndarray, per_text: np.ndarray, size: int = 3) -> np.ndarray:
    """Per text, the words inside windows of ``size`` words that occur twice or more in it."""
    n_texts, n = len(per_text) - 1, len(hashes)
    if n < size:
        return np.zeros(n_texts, dtype=np.int64)
    owner = np.repeat(np.arange(n_texts), np.diff(per_text))
    whole = owner[: n - size + 1] == owner[size - 1 :]
    at = np.flatnonzero(whole)
    key = np.zeros(len(at), dtype=np.uint64)
    for k in range(size):
        key = key * np.uint64(0x9E3779B97F4A7C15) + hashes[at + k]
    key += owner[at].astype(np.uint64) * np.uint64(0xD1342543DE82EF95)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(at), dtype=bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    covered = np.zeros(n, dtype=bool)
    for k in range(size):
        covered[at[twice] + k] = True
    return np.bincount(owner[covered], minlength=n_texts).astype(np.int64)


def measure_slice(s) -> dict[str, np.ndarray]:
    """All measurements of the texts of a slice."""
    starts, ends = s.spans(NOT_BLANK)
    per_text = s.per_text(starts)
    n_words = np.diff(per_text)
    characters = NOT_BLANK[s.buf] & ((s.buf & 0xC0) != 0x80)
    hashes = hash_spans(s.buf, starts, ends)

    breaks = np.flatnonzero(s.buf == 10)
    line_starts = np.sort(np.concatenate((s.offsets[:-1], breaks + 1)))
    line_ends = np.concatenate((line_starts[1:] - 1, [len(s.buf) - 1])) if len(line_starts) else line_starts
    owner = np.searchsorted(s.offsets, line_starts, "right") - 1
    first_word = np.searchsorted(starts, line_starts)
    has_word = np.append(starts, len(s.buf))[first_word] < line_ends
    line_starts, line_ends, owner = line_starts[has_word], line_ends[has_word], owner[has_word]
    lines = hash_spans(s.buf, line_starts, line_ends) + owner.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)
    later = np.ones(len(lines), dtype=bool)
    later[np.unique(lines, return_index=True)[1]] = False

    lengths = np.append(ends - starts, 0)
    longest = np.where(n_words > 0, np.maximum.reduceat(lengths, np.minimum(per_text[:-1], len(starts))), 0)
    return {
        "n_words": n_words,
        "word_chars": s.count(characters),
        "n_symbols": s.count(SYMBOLS[s.buf]),
        "n_lines": np.bincount(owner, minlength=s.n),
        "n_dup_lines": np.bincount(owner[later], minlength=s.n),
        "n_repeat_words": repeated_ngram_words(hashes, per_text),
        "n_upper": s.count(UPPER[s.buf]),
        "n_letters": s.count(LETTER[s.buf]),
        "longest_word": longest,
    }


def measures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id and :data:`MEASURES`, all of them whole numbers."""

    def make(ids, texts):
        parts = [measure_slice(s) for s in slices(texts)]
        return {id_col: ids} | {m: pa.array(np.concatenate([p[m] for p in parts]).astype(np.int64)) for m in MEASURES}

    kind = df.schema[id_col].dataType.simpleString()
    return map_columns(df, [id_col, text_col], make, f"`{id_col}` {kind}, " + ", ".join(f"{m} bigint" for m in MEASURES))


def ledger(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: dict[str, str] | None = None) -> DataFrame:
    """Measurements and ``bits`` (bigint), bit ``i`` set where rule ``i`` fails."""
    rules = rules or RULES
    bits = F.lit(0).cast("bigint")
    for i, condition in enumerate(rules.values()):
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return measures(df, id_col, text_col).withColumn("bits", bits)


def policy_mask(policy: str | tuple[str, ...], rules: dict[str, str] | None = None) -> int:
    names = list(rules or RULES)
    chosen = POLICIES[policy] if isinstance(policy, str) else policy
    return sum(1 << names.index(r) for r in chosen)


def kept_under(policy: str | tuple[str, ...], bits: str = "bits") -> Column:
    """True where no rule of the policy fails."""
    return F.col(bits).bitwiseAND(F.lit(policy_mask(policy)).cast("bigint")) == 0


def ablation(ledger_rows: DataFrame, policies: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Per policy and rule: texts that fail it, and those that it alone removes.

    Columns ``policy``, ``rule``, ``n_docs``, ``n_removed`` (by the whole policy),
    ``n_failed`` (by the rule) and ``n_only`` (kept if the rule were dropped). The
    ledger is counted per bit pattern first, at most 2 to the number of rules rows.
    An empty ledger gives no rows.
    """
    policies = policies or POLICIES
    names = list(RULES)
    entries = [(p, r, policy_mask(chosen), 1 << names.index(r)) for p, chosen in policies.items() for r in chosen]
    patterns = ledger_rows.groupBy("bits").agg(F.count("*").alias("n"))
    listed = F.array(*[F.struct(F.lit(p).alias("policy"), F.lit(r).alias("rule"), F.lit(m).cast("bigint").alias("mask"), F.lit(b).cast("bigint").alias("bit")) for p, r, m, b in entries])
    each = patterns.select("bits", "n", F.explode(listed).alias("e")).select("bits", "n", "e.*")
    failed = F.col("bits").bitwiseAND(F.col("mask"))

    def total(condition):
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    return each.groupBy("policy", "rule").agg(
        F.sum("n").alias("n_docs"),
        total(failed != 0).alias("n_removed"),
        total(failed.bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        total(failed == F.col("bit")).alias("n_only"),
    )
