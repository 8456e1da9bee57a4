"""Closed syncmers, seams and neighbours against Python over whole texts."""

import hashlib
import random

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from contractcheck.llm import fingerprints as fp

SCHEMA = "doc_id bigint, text string"
MASK = (1 << 64) - 1


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def of_text(t):
    return xxhash.xxh64(t.encode(), seed=42).intdigest()


def of_numbers(*xs):
    h = 42
    for x in xs:
        h = xxhash.xxh64((x & MASK).to_bytes(8, "little"), seed=h).intdigest()
    return h


def anchors(text):
    n, K, S = len(text), fp.K, fp.S
    if n < K:
        return [of_text(text) >> 32] if text else []
    h = [of_text(text[i : i + S]) for i in range(n - S + 1)]
    out = []
    for i in range(n - K + 1):
        inner = [signed(x) for x in h[i : i + K - S + 1]]
        if min(inner) in (inner[0], inner[-1]):
            out.append(i << 32 | of_numbers(*[h[i + j] for j in range(0, K, S)]) >> 32)
    return out


def printed(found):
    places = [a >> 32 for a in found]
    return "".join(f"{p - q:02x}{a & 0xFFFFFFFF:08x}" for a, p, q in zip(found, places, [0, *places], strict=False))


def linked(found):
    out = {of_numbers(found[0] & 0xFFFFFFFF)} if found else set()
    low = 0xFFFFFFFF
    return out | {of_numbers(a & low, b & low, (b >> 32) - (a >> 32)) for a, b in zip(found, found[1:], strict=False)}


def alike(one, other):
    a, b = linked(one), linked(other)
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 1.0


def by_hand(rows):
    rows = [(i, t or "") for i, t in rows]
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, signed(of_text(r[1])), r[1].encode()), reverse=True)
    out = []
    for (i, t), (_, u) in zip(order, [*order[1:], *order[:1]], strict=True):
        cut = len(t) // 3
        edited = t[: len(t) - cut] + u[:cut]
        a, b = anchors(t), anchors(edited)
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), printed(a), printed(b), alike(a, b), alike(a, anchors(u))))
    return sorted(out, key=repr)


def taken(df, **options):
    return sorted((tuple(r) for r in fp.fingerprints(df, **options).collect()), key=repr)


def prose(rng, n, letters="abcdefgh  \n"):
    return "".join(rng.choices(letters, k=n))


@pytest.mark.parametrize("slices", [2, 7, 40])
def test_equal_to_python(spark, slices):
    rng = random.Random(slices)
    rows = [(i * 3, prose(rng, rng.choice([0, 1, 20, 38, 39, 40, 41, 60, 118, 119, 120, 121, 500]))) for i in range(60)]
    rows += [(5, "é漢😀" * 30), (7, None), (None, "no id " * 20), (None, "no id either " * 9), (9, "twice " * 30), (9, "twice " * 30), (9, "x"), (200, "a" * 300)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'own' as anchors", "'own' as _slice", "'own' as n_chars", "'own' as text2")
    assert taken(df, slices=slices) == by_hand(rows)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab \né😀"), max_size=150), min_size=5, max_size=25))
def test_any_text(spark, texts):
    rows = list(enumerate(texts))
    assert taken(spark.createDataFrame(rows, SCHEMA), slices=3) == by_hand(rows)


def test_pieces_leave_no_mark(spark):
    rng = random.Random(1)
    sizes = [fp.PIECE + d for d in (-1, 0, 1, fp.K - 1, fp.K)] + [5 * fp.PIECE + 3, 20_000]
    texts = [prose(rng, n, "abc é😀") for n in sizes]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], SCHEMA).select("doc_id", fp.anchors_of(F.col("text"))).collect()
    assert {r[0]: r[1] for r in got} == {i: anchors(t) for i, t in enumerate(texts)}


def test_some_anchor_in_every_stretch_and_none_lost_by_a_shift(spark):
    rng = random.Random(2)
    text = prose(rng, 3000)
    moved = "new start " + text
    a, b = (r[0] for r in spark.createDataFrame([(1, text), (2, moved)], SCHEMA).orderBy("doc_id").select(fp.anchors_of(F.col("text"))).collect())
    places = [x >> 32 for x in a]
    assert max(q - p for p, q in zip(places, places[1:], strict=False)) <= fp.SPAN and places[0] <= fp.SPAN
    assert {x + (10 << 32) for x in a} <= set(b)
    assert alike(a, b) > 0.95


def test_one_row_and_none(spark):
    rows = [(1, "only one " * 20)]
    assert taken(spark.createDataFrame(rows, SCHEMA)) == by_hand(rows)
    assert taken(spark.createDataFrame([], SCHEMA)) == []
    assert taken(spark.createDataFrame([(1, ""), (2, None)], SCHEMA)) == by_hand([(1, ""), (2, None)])


def test_hot_id_is_cut(spark):
    rows = [(None, f"text number {i} " * 3) for i in range(300)] + [(i, f"other {i}") for i in range(100)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert taken(df, slices=10) == by_hand(rows)
    hashed = df.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))
    sizes = hashed.groupBy(fp.slice_of(hashed, ["id", "hash"], 10)).count()
    assert sizes.agg(F.max("count")).first()[0] < 3 * 400 / 10
