"""Source divergence against sums over all terms in Python."""

import random
import re
import string
from collections import Counter, defaultdict

import pytest

from contractcheck.llm import divergence

SCHEMA = "doc_id bigint, text string, lang string, source string"


def by_hand(rows, min_docs, top):
    docs = [(lang or "", source or "", re.findall(divergence.TERM, (text or "").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)))) for _, text, lang, source in rows]
    held, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, words in docs:
        held[lang].update(set(words))
        counts[lang, source].update(words)
    kept = {lang: sorted(t for t, d in held[lang].items() if d >= min_docs) for lang, _, _ in docs}
    out = set()

    def shares(c, lang):
        size = sum(c[t] for t in kept[lang])
        return {t: 1 + 10**9 * (c[t] + 5) // (size + 5 * len(kept[lang])) for t in kept[lang]}

    p = {g: shares(c, g[0]) for g, c in counts.items()} | {(lang, s): shares(Counter(), lang) for lang, s, w in docs if (lang, s) not in counts}
    q = {lang: shares(sum((c for g, c in counts.items() if g[0] == lang), Counter()), lang) for lang in kept}
    for g in p:
        far = [(sum(abs(p[g][t] - p[o][t]) for t in kept[g[0]]), o[1]) for o in p if o[0] == g[0] and o != g]
        over = [(p[g][t] - q[g[0]][t], t) for t in kept[g[0]] if counts[g][t] > 0 and p[g][t] > q[g[0]][t]]
        for part, found in (("pair", far), ("term", over)):
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            out |= {(*g, part, item, value, i + 1) for i, (value, item) in enumerate(found) if part == "pair" or i < top}
    return out


def corpus(n, sources, seed):
    rng = random.Random(seed)
    words = ["The", "the", "élan", "Élan", "漢字", "x9y", "don't", *[f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(150)]]
    weights = [1 / (1 + i) for i in range(len(words))]
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else rng.choice(sources)
        text = " ".join(rng.choices(words, weights, k=rng.randrange(0, 40))) if i % 17 else None
        rows.append((i % 50, text, rng.choice(["en", "en", "de", None, ""]), source))
    return rows + [(1, None, "xx", "alone"), (2, "9 9", "xx", "digits"), (3, "rare", "yy", "one")]


@pytest.mark.parametrize(("block_terms", "tile"), [(2048, 64), (16, 2), (100, 1)])
def test_equal_to_sums_over_terms(spark, monkeypatch, block_terms, tile):
    monkeypatch.setattr(divergence, "BLOCK_TERMS", block_terms)
    monkeypatch.setattr(divergence, "TILE_SOURCES", tile)
    rows = corpus(400, ["a", "b", "c", None, "d", "Z"], block_terms)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'own' as n", "'own' as term")
    got = [tuple(r) for r in divergence.source_divergence(df, min_docs=4, top=7).collect()]
    assert len(got) == len(set(got))
    assert set(got) == by_hand(rows, 4, 7)


def test_empty_tables_and_no_kept_terms(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert divergence.source_divergence(empty).count() == 0
    rows = [(i, "few words", "en", s) for i, s in enumerate("abc")]
    got = {tuple(r) for r in divergence.source_divergence(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == by_hand(rows, 30, 50) and len(got) == 6 and all(r[4] == 0 for r in got)


def test_large_counts_stay_exact(spark):
    from pyspark.sql import functions as F

    n, size = 9 * 10**15, 9 * 10**17
    got = spark.range(1).select(divergence.share(F.lit(n), F.lit(size), F.lit(10**7)).alias("p")).first().p
    assert got == 1 + 10**9 * (n + 5) // (size + 5 * 10**7)


def test_equal_hashes_do_not_merge_terms(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(divergence.words, "hash_spans", lambda buf, starts, ends: np.zeros(len(starts), np.uint64))
    for s in divergence.words.slices(divergence.pa.array(["b a B", "", "a", None])):
        found = divergence._counted(s, np.array([0, 1, 1, 0]))
        terms = divergence._strings(found["low"], found["start"], found["length"]).to_pylist()
        assert list(zip(found["group"], terms, found["n"], found["d"], strict=True)) == [(0, "a", 1, 1), (0, "b", 2, 1), (1, "a", 1, 1)]
