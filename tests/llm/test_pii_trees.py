"""What the trees of the personal data operator select, and why."""

import pytest
from pyspark.sql import functions as F

from contractcheck.llm import pii


def selected(df, trees):
    return {
        (r["doc_id"], r["e"]["kind"], r["t"][r["e"]["start"] : r["e"]["end"]]): r["e"]["score"]
        for r in pii.find_spans(df, text_col="t", trees=trees).join(df, "doc_id").select("doc_id", "t", F.explode("extra").alias("e")).collect()
    }


@pytest.fixture(scope="module")
def taught(spark):
    """Trees from worked examples alone."""
    return pii.train(spark.createDataFrame([], "text string"))


def test_features_hold_no_label(spark):
    """Equal form and surroundings give equal levels, whatever the check digits say."""
    df = spark.createDataFrame([(1, "pay 4539578763621486 now"), (2, "pay 4539578763621487 now"), (3, "at 10.20.30.40 on"), (4, "at 10.20.30.999 on")], "doc_id int, t string")
    rows = {r["doc_id"]: r["p"] for r in pii._proposals(pii._found(df, "t")).select("doc_id", F.element_at("proposals", 1).alias("p")).collect()}
    levels = {i: [p[f] for f in pii.FEATURES] for i, p in rows.items()}
    assert levels[1] == levels[2]
    assert [rows[i]["checked"] for i in (1, 2, 3, 4)] == [True, False, True, False]


def test_examples_held_back(spark, taught):
    """Trees of one half judge the examples of the other half: precision and recall of what the score selects."""
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(pii.examples())], "doc_id int, gen string, t string, said string, label boolean, half int")
    for k in (0, 1):
        held = df.where(F.col("half") == 1 - k)
        got = selected(held, [taught[k]])
        wanted = {(r["doc_id"], r["gen"], r["said"]): r["label"] for r in held.collect()}
        based = {(r["doc_id"], s["start"]) for r in pii.find_spans(held, text_col="t", trees=taught).collect() for s in r["base"]}
        right = sum(wanted.get(key, False) for key in got)
        assert right / len([key for key in got if key in wanted]) >= pii.PRECISION
        assert right + len(based) >= 0.9 * sum(wanted.values())


def test_thresholds_alone_select(spark, taught):
    texts = ["commit 3f2a9c1b7de84f60a5c2e19b8d7f6a5b4c3d2e1f of today", "token = 3f2a9c1b7de84f60a5c2e19b8d7f6a5b4c3d2e1f of today", "see 212-555-0187 or 2024-01-15 10:22"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, t string")
    got = selected(df, taught)
    assert {key[:2] for key in got} == {(1, "secret"), (2, "number")} and (2, "number", "212-555-0187") in got
    shut = [pii.Trees(t.start, t.splits, [2.0] * len(pii.GENERATORS)) for t in taught]
    assert selected(df, shut) == {}
    open_ = [pii.Trees(t.start, t.splits, [0.0] * len(pii.GENERATORS)) for t in taught]
    assert len(selected(df, open_)) == 4 and min(got.values()) > max(s for key, s in selected(df, open_).items() if key not in got)


def test_a_large_corpus_does_not_drown_the_examples(spark):
    """Confirmed and refuted cards by the hundred leave the verdicts on secrets and contacts as they are."""
    cards = [(i, f"card {4539578763621486 + 7 * i} end") for i in range(3000)]
    df = spark.createDataFrame(cards + [(-1, "secret: 9aGk20xkQ7LmN02pRtVwY55aB"), (-2, "ask joe [at] example [dot] com")], "doc_id int, t string")
    got = selected(df, pii.train(df, "t"))
    assert {key[:2] for key in got if key[0] < 0} == {(-1, "secret"), (-2, "contact")}
    assert not [key for key in got if key[0] >= 0]  # nine of ten fail the check digit
