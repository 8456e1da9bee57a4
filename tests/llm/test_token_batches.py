"""Token counts of whole batches against the library, text by text."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from contractcheck.llm import token_counts
from contractcheck.llm.workload import TOKENIZER

PATH = public_tokenizers.path(TOKENIZER)
PARTS = ["don't", "'s", "'ll", "'LL", " 've", "''s", "it's", "'", " ", "  ", "\n", "\r\n", "\t", " ", "　", "a", "Zürich", "漢字", "é", "²", "½", "12", "3.5", "…", "—", "😀", "́", "ا", "\0", "<|endoftext|>", "<|endof", "_", "x1y", "re", "'re", "'d.", "\x1c", " "]
TEXTS = st.one_of(st.none(), st.lists(st.sampled_from(PARTS), max_size=14).map("".join), st.text(st.characters(codec="utf-8"), max_size=25))


@pytest.fixture(scope="module")
def counts():
    return token_counts.Counts(PATH)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def wanted(library, texts):
    return [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@settings(max_examples=400, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=12))
def test_equal_to_the_library(counts, library, texts):
    assert counts.column(pa.array(texts, pa.string())).tolist() == wanted(library, texts)


def test_slices_and_long_texts(counts, library, monkeypatch):
    monkeypatch.setattr(token_counts, "SLICE_BYTES", 64)
    texts = ["".join(PARTS[i % 7 :: 1 + i % 5]) * (1 + i % 3) for i in range(80)] + ["word " * 50_000, "", None, "a" * 5_000]
    assert counts.column(pa.array(texts, pa.large_string())).tolist() == wanted(library, texts)
    assert counts.column(pa.array(texts, pa.string())[3:9]).tolist() == wanted(library, texts[3:9])


def test_equal_hashes_and_a_full_memo(counts, library, monkeypatch):
    monkeypatch.setattr(token_counts, "hash_spans", lambda points, starts, ends: np.zeros(len(starts), np.uint64))
    monkeypatch.setattr(token_counts, "MEMO_ENTRIES", 3)
    texts = ["one two three unlikelyword", "don't unlikelyword qqqzzzx", " two  one"]
    assert counts.column(pa.array(texts)).tolist() == wanted(library, texts)


def test_pre_tokens_equal_the_pattern(counts):
    import regex

    pattern = regex.compile(token_counts.PATTERN)
    for text in ["it's 'tis 'S  x", "a'b'll ''ve\n\n y", "  \n", "1a²'s", "x 're'd"]:
        points = np.array([ord(c) for c in f" {text} "], dtype=np.uint32)
        kinds = counts.classes[points]
        kinds[[0, -1]] = token_counts.BORDER
        starts, ends = token_counts.pre_tokens(points, kinds)
        got = [text[a - 1 : b - 1] for a, b in sorted(zip(starts.tolist(), ends.tolist(), strict=True))]
        assert got == pattern.findall(text)
