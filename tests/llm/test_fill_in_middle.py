"""Fill-in-the-middle against slicing in Python, and the exact way back."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from contractcheck.llm import fill_in_middle as fim

SCHEMA = "doc_id bigint, text string"


def by_hand(doc_id, text, layout=fim.Layout(), seed="1"):
    text = text or ""
    n, x = len(text), hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in layout.marks) or h[2] % 100 >= layout.plain_from:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < layout.spm_below:
        return n, "spm", a, b - a, layout.suffix + s + layout.prefix + p + layout.middle + m
    return n, "psm", a, b - a, layout.prefix + p + layout.suffix + s + layout.middle + m


def taken(df, **options):
    from pyspark.sql import functions as F

    layout = options.get("layout", fim.Layout())
    done = fim.fill_in_middle(df, **options).withColumn("back", fim.restored(F.col("output"), F.col("form"), layout))
    return done.collect()


TEXTS = st.text(st.sampled_from("ab \n\r\t$\\<PSM>é漢😀́"), max_size=40) | st.text(st.characters(codec="utf-8"), max_size=40)


@settings(max_examples=8, deadline=None)
@given(st.lists(TEXTS, min_size=20, max_size=60))
def test_equal_to_slicing(spark, texts):
    rows = taken(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], SCHEMA))
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n, r.form, r.prefix_units, r.middle_units, r.output) == by_hand(r.doc_id, r.text)
        assert r.back == r.text


def test_cases(spark):
    long = "ab😀\n" * 300_000
    given_rows = [(1, None), (2, ""), (3, "x<S>y"), (4, long), (4, long), (None, "null id"), (5, "$1\\Q$2"), (6, "<P"), (7, "a" * fim.BLOCK), (8, "é" * (2 * fim.BLOCK + 1))]
    df = spark.createDataFrame([(*r, "own") for r in given_rows], SCHEMA + ", n string")
    for r in taken(df):
        assert (r.n, r.form, r.prefix_units, r.middle_units, r.output) == by_hand(r.doc_id, r.text)
        assert r.back == (r.text or "")
    digests = fim.fim_digests(df).collect()
    assert len(digests) == len(given_rows)
    assert all(r.restored_sha256 == hashlib.sha256((t or "").encode()).hexdigest() for r, (_, t) in zip(digests, given_rows, strict=True))
    assert fim.fim_digests(df.limit(0)).count() == 0


@pytest.mark.parametrize("layout", [fim.Layout("$1", "\\2", "(.)", plain_from=100, spm_below=50), fim.Layout(plain_from=100, spm_below=100)])
def test_other_marks(spark, layout):
    df = spark.createDataFrame([(i, "one two " * i) for i in range(40)], SCHEMA)
    for r in taken(df, layout=layout):
        assert (r.n, r.form, r.prefix_units, r.middle_units, r.output) == by_hand(r.doc_id, r.text, layout)
        assert r.back == r.text


def test_lines_as_units(spark):
    df = spark.createDataFrame([(i, "".join(f"line {k}\n" for k in range(i)) + "end") for i in range(1, 60)], SCHEMA)
    for r in taken(df, unit=fim.LINE, layout=fim.Layout(plain_from=100)):
        lines = r.text.splitlines(keepends=True)
        assert r.n == len(lines) and r.back == r.text
        _, _, a, m, _ = by_hand(r.doc_id, "x" * len(lines), fim.Layout(plain_from=100))
        assert (r.prefix_units, r.middle_units) == (a, m)
        assert "".join(lines[a : a + m]) in r.output
