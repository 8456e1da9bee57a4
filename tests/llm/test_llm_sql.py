"""Operators against their SQL, and against brute force where SQL can't say it."""

import hashlib
import os
import re

import compare
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from contractcheck.llm import chat, quality_model, token_counts, toxicity, workload

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


@pytest.mark.parametrize("name", sorted(workload.ORACLES))
def test_same_rows_as_sql(spark, name):
    duck = compare.connect(SF_DIR)
    df = workload.QUERIES[name](spark, SF_DIR)
    columns, got = compare.spark_rows(df)
    wanted_columns, wanted = compare.oracle_rows(duck, workload.ORACLES[name])
    assert columns == wanted_columns
    assert got == wanted
    assert compare.type_differences(df, duck, workload.ORACLES[name]) == {}


def test_pii_contract(spark):
    texts = {r["doc_id"]: r["text"] for r in workload.documents(spark, SF_DIR).collect()}
    for r in workload.pii_spans(spark, SF_DIR).collect():
        want = base_spans(texts[r["doc_id"]])
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in BASE] == [sum(s[0] == k for s in want) for k in BASE]
        assert set(filter(None, said.split(","))) <= set(r["spans"].split(","))


def test_token_counts(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path(workload.TOKENIZER))
    texts = {r["doc_id"]: r["text"] for r in workload.documents(spark, SF_DIR).collect()}
    for r in workload.tokens(spark, SF_DIR).collect():
        n = len(library.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(texts[r["doc_id"]].encode()), n > 512)


def test_tokens_of_odd_texts():
    from tokenizers import Tokenizer

    path = public_tokenizers.path(workload.TOKENIZER)
    library, counts = Tokenizer.from_file(path), token_counts.Counts(path)
    odd = ["", " ", "  x", "a\n\n b \t", "<|endoftext|>", "a<|endoftext|> b<|endoftext|>", "don't we'll 'S", "\x00\x1c\x85\xa0x", "日本語 テスト", "😀 á ﷺ", "Ԙ՘x", "x" * 5000, "7" * 300 + " 8", " 　  a", "﻿!?'s"]
    for c in range(1, 0x3000, 7):
        odd.append(f"a{chr(c)}1{chr(c)} {chr(c)}!{chr(c)} ")
    for text in odd:
        assert counts.count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)
    assert len(counts.whole) > 40_000


def area_under_curve(scores, labels):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(1, len(scores) + 1)
    pos = labels.sum()
    return (ranks[labels > 0].sum() - pos * (pos + 1) / 2) / (pos * (len(labels) - pos))


ACCURACY_DIR = os.environ.get("ACCURACY_SF_DIR", "/root/testdata/sf0.1")


def test_toxicity_is_learned(spark):
    labels = workload.documents(spark, ACCURACY_DIR, "labels").select("doc_id", "toxic")
    rows = workload.toxic(spark, ACCURACY_DIR).join(labels, "doc_id").where("held_out").collect()
    score, label = np.array([r["score"] for r in rows]), np.array([r["toxic"] for r in rows])
    predicted = np.array([r["predicted"] for r in rows])
    told = (predicted == 1) & (label == 1)
    print("toxicity", len(rows), area_under_curve(score, label), (predicted == label).mean(), told.sum() / label.sum(), told.sum() / max(1, predicted.sum()))
    assert area_under_curve(score, label) > 0.85
    assert (predicted == label).mean() > 0.93


def test_quality_without_labels_agrees_with_labels(spark):
    labels = workload.documents(spark, ACCURACY_DIR, "labels").select("doc_id", "quality")
    rows = workload.quality(spark, ACCURACY_DIR).join(labels, "doc_id").collect()
    score, label = np.array([r["score"] for r in rows]), np.array([r["quality"] for r in rows])
    keep = np.array([r["keep"] for r in rows])
    print("quality", len(rows), area_under_curve(score, label), "kept good", keep[label == 1].mean(), "kept bad", keep[label == 0].mean())
    assert area_under_curve(score, label) > 0.95
    assert keep[label == 1].mean() > 0.97 and keep[label == 0].mean() < 0.2


def test_em_recovers_labellers():
    rng = np.random.default_rng(1)
    good = rng.random(50_000) < 0.85
    k = len(quality_model.LABELLERS)
    knows, wrong = np.linspace(0.15, 0.7, k), np.linspace(0.03, 0.002, k)
    votes = np.where(rng.random((len(good), k)) < np.where(good[:, None], wrong, knows), 1, 2)
    patterns, at, counts = np.unique(quality_model.pattern(votes), return_inverse=True, return_counts=True)
    posterior, table, share = quality_model.expectation_maximisation(patterns, counts.astype(float), belief=0.001, false_alarms=0.05)
    assert abs(share - 0.85) < 0.02
    assert np.abs(table[:, 0, 1] - knows).max() < 0.05 and np.abs(table[:, 1, 1] - wrong).max() < 0.02
    assert ((posterior[at] > 0.5) == good).mean() > 0.95


def test_roles_beat_the_largest_class(spark):
    d = "/root/testdata/sf0.01"
    held = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 5 == 0
    truth = workload.documents(spark, d, "conversations").select("conv_id", "turn", F.col("role").alias("truth"))
    rows = workload.chat_format(spark, d).join(truth, ["conv_id", "turn"]).where(held).collect()
    right = np.mean([r["role"] == r["truth"] for r in rows])
    print("roles", len(rows), right)
    assert right > 0.9


def test_toxic_sentences_are_located():
    texts = ["Fine day here. Quiet words follow now."] * 60 + ["Some words here. You absolute moron there. More words."] * 20
    model = toxicity.fit(texts, np.array([0] * 60 + [1] * 20))
    strong = {b for b, w in zip(model.buckets, model.weights, strict=True) if w > 1}
    assert strong


def test_chunked_viterbi_is_one_long_viterbi():
    rng = np.random.default_rng(5)
    n = len(chat.ROLES)
    own = chat.Hmm(np.log(rng.dirichlet(np.ones(n))), np.log(rng.dirichlet(np.ones(n), n)), [np.log(rng.dirichlet(np.ones(k), n)) for k in chat.LEVELS])
    codes = rng.integers(0, np.prod(chat.LEVELS), 200)
    seen = own.emissions(codes)
    score, back = own.first + seen[0], []
    for row in seen[1:]:
        step = score[:, None] + own.after
        back.append(step.argmax(axis=0))
        score = step.max(axis=0) + row
    path = [int(score.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    cuts = [0, 1, 17, 18, 90, 200]
    pieces = [seen[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    ends = chat.chunk_ends(own, [chat.best_paths(own, p) for p in pieces])
    joined = [r for p, (a, b) in zip(pieces, ends, strict=True) for r in chat.fixed_path(own, p, a, b)]
    assert joined == path[::-1]


def test_texts_in_any_script_take_the_shortcut():
    from tokenizers import Tokenizer

    path = public_tokenizers.path(workload.TOKENIZER)
    library, counts = Tokenizer.from_file(path), token_counts.Counts(path)
    asked, encode = [], counts.encode
    counts.encode = lambda texts: asked.extend(texts) or encode(texts)
    told = ["plain words 😀 and more", "שלום the world <|endoftext|> مرحبا  x", "हिन्दी words\n\n ไทย a\u0301 e\u0301\u0302 ", "👩‍👩‍👧 it's 12 ﷺ\u0378 \U000e0001 z", " \u3000😀\x85\u2028 "]
    for text in told:
        assert counts.count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)
    assert not set(asked) & set(told) and " words" not in asked
