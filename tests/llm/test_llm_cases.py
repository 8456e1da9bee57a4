"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing names, hot groups."""

import itertools

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from contractcheck.llm import chat, decontaminate, licences, mixing, ngram_join, pii, quality_model, rules, token_counts, toxicity, words
from contractcheck.llm.workload import TOKENIZER

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
PROSE = " ".join(f"word{i} plain text{i % 7} goes" for i in range(60))
ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
ROWS = [
    (1, PROSE, "en", "a", 10),
    (1, PROSE, "en", "a", 10),
    (2, None, None, None, None),
    (None, "", "en", None, 0),
    (None, PROSE + " more", "en", "b", 5),
    (3, "x" * 200_000, "en", "b", 200_000),
    (4, "mail me at joe@example.org or +1 (415) 555-2671, card 4111 1111 1111 1111, from 10.0.0.1. " + PROSE[:900], "en", "c", 9),
    (5, "Start. " + ITEM.upper() + " end. " + PROSE[:1200], "en", "c", 9),
    (6, "\n\n \t", "de", "", 4),
    (7, "Licensed under the Apache License, Version 2.0.\nother line", "de", "a", 4),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, ITEM), (2, None), (None, "rare short item"), (3, "")], "item_id bigint, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0), (4, 1), (4, 0), (None, 1), (7, None)], "doc_id bigint, toxic int")


def clash(df):
    from pyspark.sql import functions as F

    for c in ("t", "size", "draw", "copies", "set_key", "bands", "base", "extra", "proposals", "n_words", "score", "c", "s"):
        df = df.withColumn(c, F.lit("own"))
    return df


def run_all(docs, items, labels):
    import public_tokenizers

    model = toxicity.train(docs, labels)
    return {
        "pii": pii.find_spans(docs),
        "join": ngram_join.jaccard_join(docs),
        "quality": quality_model.quality(docs),
        "mix": mixing.mix(docs),
        "tokens": token_counts.token_counts(docs, public_tokenizers.path(TOKENIZER)),
        "toxicity": toxicity.toxicity(docs, model),
        "contamination": decontaminate.contamination(docs, items),
        "licences": licences.licences(docs),
        "rules": rules.ledger(docs),
    }


def test_every_operator_returns_every_row(docs, items, labels):
    for name, out in run_all(clash(docs), items, labels).items():
        got = out.collect()
        assert len(got) == len(ROWS), name
        assert sorted((r["doc_id"] for r in got), key=str) == sorted((r[0] for r in ROWS), key=str), name


def test_empty_tables(spark, docs, items, labels):
    for name, out in run_all(docs.limit(0), items.limit(0), labels.limit(0)).items():
        assert out.collect() == [], name
    assert {r["n_hit"] for r in decontaminate.contamination(docs, items.limit(0)).collect()} == {0}
    talk = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.chat_turns(talk).collect() == []
    for name, stage in corpus_pipeline.STAGES:
        if name != "benchmark_decontamination":
            assert stage(spark, docs.limit(0), "").collect() == [], name


def test_stages_keep_columns(spark, docs, items, tmp_path):
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    wide = clash(docs)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, wide, str(tmp_path))
        if name != "mixing":
            assert out.dtypes == wide.dtypes, name
        out.collect()


def test_join_cases(docs):
    got = ngram_join.jaccard_join(docs).collect()
    by = {(r["doc_id"], r["n_links"], r["class_id"]) for r in got}
    assert (1, 2, 1) in by and (None, 2, 1) in by
    assert (2, 0, 2) in by and (6, 0, 6) in by and (None, 0, None) in by
    left = ngram_join.one_per_group(docs).collect()
    assert sum((r["text"] or "").startswith("word0") for r in left) == 1
    assert len(left) == len(ROWS) - 2


def brute_groups(texts):
    sets = []
    for t in texts:
        w = t.lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    label = list(range(len(texts)))
    links = [0] * len(texts)
    for a, b in itertools.combinations(range(len(texts)), 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
            x, y = label[a], label[b]
            label = [min(x, y) if v in (x, y) else v for v in label]
    return label, links


@pytest.mark.parametrize("block", [4, 512])
def test_large_group_in_blocks(spark, block):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for _ in range(60):
        own = list(base)
        own[int(rng.integers(0, 100))] = f"n{rng.integers(0, 40)}"
        own[int(rng.integers(0, 100))] = f"n{rng.integers(0, 40)}"
        texts.append(" ".join(own))
    texts += texts[:5] * 4 + [" ".join(f"z{k}_{i}" for i in range(50)) for k in range(5)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = {r["doc_id"]: r for r in ngram_join.jaccard_join(df, block=block, recall=0.99999).collect()}
    label, links = brute_groups(texts)
    assert [got[i]["n_links"] for i in range(len(texts))] == links
    assert [got[i]["class_id"] for i in range(len(texts))] == label


def test_components_of_a_chain(spark):
    edges = [(bytes([i]), bytes([i + 1])) for i in range(30)] + [(b"\xc8", b"\xc9")]
    out = {bytes(r["node"]): bytes(r["label"]) for r in ngram_join.components(spark.createDataFrame(edges, "a binary, b binary")).collect()}
    assert {out[bytes([i])] for i in range(31)} == {b"\x00"} and out[b"\xc9"] == b"\xc8"


def test_mix_meets_targets(spark):
    rows = [(i, "w " * (1 + i % 50), ["a", "b", "c", None, "d"][i % 5 if i % 3 else 0]) for i in range(4000)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    source = {r[0]: r[2] for r in rows}
    total = {}
    for r in out:
        t = total.setdefault(source[r["doc_id"]], [0, r["target"], r["source_size"], 0])
        t[0] += r["taken"]
        t[3] += r["size"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    for taken, target, source_size, size in total.values():
        assert source_size == size and target <= 2 * size and abs(taken - target) <= 50
    assert abs(sum(t[1] for t in total.values()) - 1.5 * sum(r["size"] for r in out)) < 1e-6
    again = mixing.mix(spark.createDataFrame(rows[::-1], "doc_id bigint, text string, source string")).collect()
    assert {(r["doc_id"], r["taken"]) for r in out} == {(r["doc_id"], r["taken"]) for r in again}


def naive_hits(doc, items, size=10):
    hit, names = set(), set()
    for name, item in items:
        k = min(size, len(item))
        for p in range(len(item) - k + 1) if k else ():
            for q in range(len(doc) - k + 1):
                if doc[q : q + k] == item[p : p + k]:
                    hit |= set(range(q, q + k))
                    names.add(name)
    return len(hit), names


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=9), min_size=1, max_size=5), st.lists(st.lists(st.sampled_from("abcd"), max_size=40), min_size=1, max_size=4), st.integers(1, 5), st.integers(1, 9))
def test_automaton_finds_all_windows(items, docs, size, lane):
    old, decontaminate.LANE = decontaminate.LANE, lane
    try:
        own = decontaminate.Matcher([(str(i), " ".join(x)) for i, x in enumerate(items)], size)
        for s in words.slices(pa.array([" ".join(d) for d in docs])):
            n_words, found = own.scan(s)
            for i, d in enumerate(docs):
                runs, n, names = found.get(i, ((), 0, set()))
                assert (n, names) == naive_hits(d, [(str(k), x) for k, x in enumerate(items)], size)
                assert n_words[i] == len(d)
    finally:
        decontaminate.LANE = old


def test_benchmark_passages_are_cut(spark, docs, items):
    out = {r["doc_id"]: r for r in decontaminate.decontaminated(docs, items, length_col="n_chars").collect() if r["doc_id"]}
    assert "ALPHA" not in out[5]["text"] and out[5]["text"].startswith("Start. ") and out[5]["n_chars"] == len(out[5]["text"])
    assert out[4]["n_chars"] == 9 and out[2]["text"] is None
    again = decontaminate.contamination(spark.createDataFrame(list(out.values()), SCHEMA), items)
    assert again.where("n_hit > 0").count() == 0
    whole = spark.createDataFrame([(9, ITEM)], "doc_id bigint, text string")
    assert decontaminate.decontaminated(whole, items).count() == 0


def test_redaction(docs):
    out = {r["doc_id"]: r for r in pii.redacted(docs, length_col="n_chars").collect() if r["doc_id"]}
    assert out[4]["text"].startswith("mail me at [EMAIL] or [PHONE], card [CARD], from [IP]. ")
    assert out[4]["n_chars"] == len(out[4]["text"])
    assert out[2]["text"] is None and out[1]["text"] == PROSE and out[3]["text"] == "x" * 200_000


def test_long_runs_take_linear_time(spark):
    texts = ["a" * 100_000, "1" * 100_000, "1 " * 50_000, "1." * 50_000, "a@" * 25_000, "a@b.c_d@e.f " * 5000, "+1 " * 50_000, "é" * 10 + "10.0.0.1 " * 3000]
    out = pii.find_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    sizes = {r["doc_id"]: len(r["base"]) for r in out}
    assert sizes[5] == 10_000 and sizes[7] == 3000 and sizes[0] == 0
    assert [r["base"][0]["start"] for r in out if r["doc_id"] == 7] == [10]


def test_trees_learn_and_calibrate():
    counts = [((1, d, 1, 1, 0, 0, 0, c), 50, 50 if d == 4 else 0) for d in range(6) for c in range(6)]
    fitted = pii.calibrate(pii.boost(counts), counts)
    assert fitted.score(counts[24][0]) > 0.9 > 0.5 > fitted.score(counts[0][0])
    assert fitted.thresholds[0] == 2.0 and fitted.score(counts[0][0]) < fitted.thresholds[1] <= fitted.score(counts[24][0])


def test_licence_found(docs):
    out = {r["doc_id"]: r for r in licences.licences(docs).collect() if r["doc_id"]}
    assert (out[7]["licence"], out[7]["dice"], out[7]["n_passages"]) == ("Apache-2.0", 1.0, 2)  # its line, and the whole short text
    assert out[2]["licence"] is None and out[2]["n_passages"] == 0


def test_chat_cases(spark):
    rows = [
        (1, 0, "x", "User: hello?"), (1, 1, None, "Assistant: hi <|im_end|> there"), (1, 1, None, "Assistant: again"), (1, None, "user", None),
        (None, 0, "user", "a"), (None, 1, "assistant", "b" * 500), (2, 0, "system", "### System: rules"),
    ]
    rows += [(3, i // 1500, "user" if i % 2 else "assistant", f"User: m{i}" if i % 2 else f"Assistant: m{i}") for i in range(7000)]
    out = chat.chat_turns(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()
    assert len(out) == len(rows)
    first = {r["turn"]: r for r in out if r["conv_id"] == 1}
    assert first[0]["rendered"] == "<|im_start|>user\nhello?<|im_end|>\n"
    joined = "".join(r["rendered"] for r in sorted((r for r in out if r["conv_id"] == 1 and r["turn"] == 1), key=lambda r: "im_start" not in r["rendered"]))
    assert joined.count("<|im_start|>assistant") == 1 and joined.count("<|im_end|>\n") == 1
    assert [r["role"] for r in out if r["conv_id"] == 2] == ["system"]
    marked = [(r["role"], r["rendered"]) for r in out if r["conv_id"] == 3]
    assert sum(r == "user" for r, _ in marked) == 3500


def test_band_plan_reaches_recall():
    for threshold, recall in itertools.product((0.5, 0.8, 0.9), (0.9, 0.99, 0.999)):
        bands, rows = ngram_join.band_plan(threshold, recall)
        assert 1 - (1 - threshold**rows) ** bands >= recall


def test_slices_hold_whole_texts():
    texts = ["a b", None, "", "é ü" * 1000, "tail"]
    found = [s.text(i).decode() for s in words.slices(pa.array(texts), 100) for i in range(s.n)]
    assert found == [t or "" for t in texts]
    large = [s.text(i).decode() for s in words.slices(pa.array(texts, pa.large_string())[1:], 100) for i in range(s.n)]
    assert large == found[1:]


TALK = "conv_id bigint, turn bigint, role string, text string"


def test_several_speakers_in_one_text(spark):
    rows = [(1, 0, None, "User: hi\nAssistant: hello\nmore of it\nUser: thanks"), (2, 0, "user", "short?"), (2, 1, "assistant", "first\nsecond\nthird")]
    out = chat.chat_turns(spark.createDataFrame(rows, TALK)).collect()
    said = [(r["line"], r["role"], r["rendered"]) for r in sorted(out, key=lambda r: r["line"]) if r["conv_id"] == 1]
    assert said == [
        (0, "user", "<|im_start|>user\nhi<|im_end|>\n"),
        (1, "assistant", "<|im_start|>assistant\nhello\nmore of it<|im_end|>\n"),
        (3, "user", "<|im_start|>user\nthanks<|im_end|>\n"),
    ]
    assert [r["turn"] for r in out if r["conv_id"] == 2 and r["line"] == 0] == [0, 1] and sum(r["conv_id"] == 2 for r in out) == 2


def test_chat_counts_do_not_depend_on_segments(spark, monkeypatch):
    rows = [(1, i, "user" if i % 3 else "assistant", f"m{i}") for i in range(40)] + [(None, i % 3, "system" if i % 7 else "user", f"n{i}") for i in range(60)]
    df = spark.createDataFrame(rows, TALK)

    def counted():
        return chat.estimate(chat.messages(df, "conv_id", "turn", "text", "role"))

    whole = counted()
    monkeypatch.setattr(chat, "TURNS", 4)
    monkeypatch.setattr(chat, "LIMIT", 5)
    parts = counted()
    assert np.allclose(whole.first, parts.first) and np.allclose(whole.after, parts.after)


def test_what_base_formats_miss_is_redacted(spark):
    extra = [x for i in range(30) for x in (f"({400 + i}) 555-{2600 + i}", f"{300 + i}-555-{1600 + i}", f"joe{i} [at] example [dot] com", f"41555526{10 + i}", f"mary{i}@localhost")]
    told = ["filler text " + ("phone: " if x.isdigit() else "email: " if "mary" in x else "see ") + x + " end" for x in extra]
    told += [f"on 2024-01-15 10:22 or 15.01.2024 in 2019 2020 2021 or 1234567890 of {i}" for i in range(30)]
    out = [r["text"] for r in pii.redacted(spark.createDataFrame(list(enumerate(told)), "doc_id bigint, text string")).collect()]
    assert not [t for t in out if any(x in t for x in extra)]
    assert sum("[NUMBER]" in t for t in out) == 90 and sum("[CONTACT]" in t for t in out) == 60
    assert sum("on 2024-01-15 10:22 or 15.01.2024 in 2019 2020 2021 or 1234567890 of" in t for t in out) == 30


def test_a_secret_does_not_depend_on_the_size_of_the_table(spark):
    leaked = "api key = Zx81kQ7LmN02pRtVwY55aB"

    def found(texts):
        out = pii.redacted(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
        return {r["text"] for r in out.where("doc_id < 3").collect()}

    alone, copies = found([leaked]), found([leaked] * 300 + [f"see Qw{i}ertyuiopas{i}dfghjkl and more" for i in range(3)])
    assert alone == copies == {"api key = [SECRET]"}


def test_notices_inside_longer_texts(spark):
    told = {
        "Copyright (c) 2020 Acme. All rights reserved.": "All-rights-reserved",
        "see all rights reserved and so on for a long line of other words that follow here": "All-rights-reserved",
        "Copyright 2020 Foo. Licensed under the Apache License, Version 2.0. See LICENSE for details.": "Apache-2.0",
        "Copyright 2019 Foo\n" + licences.NOTICES["GPL-3.0-long"][1].replace(" under ", "\nunder ").replace(" Free ", "\nFree "): "GPL-3.0-long",
        ("some words before it. " * 20 + licences.NOTICES["Apache-2.0-long"][1] + " and words after it " * 20): "Apache-2.0-long",
        "nothing of that kind is said here, all rights are reserved elsewhere": None,
    }
    out = {r["text"]: r for r in licences.licences(spark.createDataFrame([(t,) for t in told], "text string"), "text").collect()}
    assert {t: r["licence"] for t, r in out.items()} == told
    assert [out[t]["n_passages"] for t in told] == [1, 1, 1, 1, 1, 0]


def test_licence_versions_and_terms_agree(spark):
    told = {
        "This work is licensed under a Creative Commons Attribution 4.0 International License.": "CC-BY-4.0-long",
        "Licensed under CC BY-ND 4.0.": "CC-BY-ND-4.0",
        "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
        "This work is licensed under the GNU General Public License, version 7.": None,
        licences.NOTICES["GPL-2.0-long"][1]: "GPL-2.0-long",
        "// SPDX-License-Identifier: LGPL-2.1-only": "LGPL-2.1-only-spdx",
        licences.NOTICES["ISC"][1]: "ISC",
        licences.NOTICES["MIT-full"][1]: "MIT-full",
        licences.NOTICES["BSD-2-Clause-long"][1]: "BSD-2-Clause-long",
    }
    out = {r["text"]: r for r in licences.licences(spark.createDataFrame([(t,) for t in told], "text string"), "text").collect()}
    assert {t: r["licence"] for t, r in out.items()} == told
    every = licences.licences(spark.createDataFrame(list((n, t) for n, (_, t) in licences.NOTICES.items()), "name string, text string"), "name").collect()
    assert {r["name"]: r["licence"] for r in every} == {n: n for n in licences.NOTICES}
