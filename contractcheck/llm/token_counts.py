"""Token counts with a whole-token shortcut.

A byte-level BPE first cuts a text into pre-tokens and merges inside each of
them. Most pre-tokens of real text are vocabulary strings that the merges turn
into exactly one token. Which ones do is proven offline: every vocabulary string
is given to the tokenizer by itself, and those that come back as one token form
the shortcut set. Pre-tokens in that set count one each; only the others are merged.

Texts are worked on in slices of about ``SLICE_BYTES``. The code points of a slice
become classes (letter, digit, blank, other), the borders of their runs become
pre-tokens, and equal pre-tokens are found by hash and compared code point by code
point. So each distinct pre-token is looked up once per slice, and all that are not
known yet are merged in one call.

The classes come from the ``regex`` module. Letters that its Unicode tables and the
tokenizer's know differently all lie outside :data:`KNOWN`; a text with any character
outside, or with a special string inside, is cut by the tokenizer's own pre-tokenizer
instead, and its pre-tokens take the same way.

Defined results: a null or empty text has 0 tokens. Special strings inside a text
count as the one token that the library makes of them. No text is cut short.
"""

from __future__ import annotations

import os
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contractcheck.llm.words import Slice, equal_spans, hash_spans, map_columns, slices

#: Fixed: the pre-token pattern of the byte-level tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Ranges in which both sides' character classes were compared one by one (see the tests).
KNOWN = "\u0001-ɏͰ-ϿЀ-ԯḀ-ỿ -⁯₠-₿℀-⅏←-⯿　-ヿ一-鿿가-힣"
#: Longest pre-token kept in the memo, and how many; the memo starts anew beyond that.
MEMO_CHARS, MEMO_ENTRIES = 64, 200_000
SLICE_BYTES = 1 << 21
#: Classes of code points: letter, digit, other, blank, outside KNOWN, between two texts.
LETTER, DIGIT, OTHER, BLANK, STRANGE, BORDER = range(6)
#: Fixed: the letters after an apostrophe that make a pre-token of their own.
ENDINGS = ("s", "t", "m", "d", "re", "ve", "ll")


def classes() -> np.ndarray:
    """The class of every code point."""
    import regex

    table = np.full(0x110000, STRANGE, dtype=np.uint8)
    plane = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)]))
    for kind, pattern in ((OTHER, f"[{KNOWN}]"), (LETTER, r"\p{L}"), (DIGIT, r"\p{N}"), (BLANK, r"\s")):
        members = np.array([ord(c) for c in regex.findall(pattern, plane)])
        table[members if kind == OTHER else members[table[members] != STRANGE]] = kind
    return table


def pre_tokens(points: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pre-tokens of known texts that borders separate.

    Runs of one class are pre-tokens. The last of several blanks stands alone, a single
    space belongs to the run after it, and an apostrophe takes a known ending from the
    letters after it if no space stands before it.
    """
    edge = np.flatnonzero(np.diff(kinds, prepend=kinds[:1] ^ 1, append=kinds[-1:] ^ 1))
    start, end = edge[:-1].copy(), edge[1:].copy()
    kind = kinds[start]
    after = np.append(kind[1:], BORDER)
    followed = (kind == BLANK) & (after != BORDER)
    gives = followed & (points[end - 1] == 32)
    alone = followed & ~gives & (end - start > 1)
    single = end[alone] - 1
    end -= gives | alone
    took = np.append(False, gives[:-1])
    start[1:] -= gives[:-1]

    quote = np.flatnonzero((kind == OTHER) & ~took & (end - start == 1) & (points[start] == 39) & (after == LETTER))
    letters = quote + 1
    take = np.zeros(len(quote), dtype=np.int64)
    for ending in ENDINGS:
        fits = end[letters] - start[letters] >= len(ending)
        for k, c in enumerate(ending):
            fits &= points[np.minimum(start[letters] + k, len(points) - 1)] == ord(c)
        take[fits] = len(ending)
    end[quote] += take
    start[letters] += take
    real = (kind != BORDER) & (end > start)
    return np.concatenate((start[real], single)), np.concatenate((end[real], single + 1))


class Counts:
    """Counts the tokens of texts, for one tokenizer file."""

    def __init__(self, path: str):
        # A task has one core; the library's own threads would only wait for it.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = sorted((t.content for t in added.values()), key=len, reverse=True)
        self.cut = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.pieces = regex.compile(PATTERN)
        self.classes = classes()
        self.whole = self.prove()
        self.memo: dict[str, int] = dict.fromkeys(self.whole, 1)

    def prove(self) -> list[str]:
        """Vocabulary strings that are one pre-token and encode alone as one token."""
        ids = [i for i in self.tokenizer.get_vocab().values()]
        texts = [t for t in self.tokenizer.decode_batch([[i] for i in ids], skip_special_tokens=False) if "�" not in t]
        texts = [t for t in texts if t and t not in self.special and self.pieces.fullmatch(t)]
        return [t for t, e in zip(texts, self.encode(texts), strict=True) if e == 1]

    def encode(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def lengths(self, pieces: list[str]) -> list[int]:
        """Tokens of each of some distinct pre-tokens."""
        memo = self.memo
        found = [memo.get(p, 0) for p in pieces]
        rest = [i for i, n in enumerate(found) if not n]
        if rest:
            for i, n in zip(rest, self.encode([pieces[i] for i in rest]), strict=True):
                found[i] = n
                if len(pieces[i]) <= MEMO_CHARS:
                    memo[pieces[i]] = n
            if len(memo) > MEMO_ENTRIES + len(self.whole):
                self.memo = dict.fromkeys(self.whole, 1)
        return found

    def strange(self, text: str) -> int:
        """A text that the tokenizer's own pre-tokenizer has to cut."""
        parts = self.cut.split(text) if self.cut is not None else [text]
        cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
        pieces = Counter(part[a:b] for part in parts if part for _, (a, b) in cut(part))
        return len(parts) - 1 + sum(n * k for n, k in zip(self.lengths(list(pieces)), pieces.values(), strict=True))

    def of_slice(self, s: Slice) -> np.ndarray:
        """The number of tokens of every text of a slice."""
        said = s.buf.tobytes().decode()
        points = np.frombuffer(said.encode("utf-32-le"), dtype=np.uint32)
        before = np.concatenate(([0], np.cumsum((s.buf & 0xC0) != 0x80)))
        first = before[s.offsets]
        kinds = self.classes[points]
        kinds[first - 1] = BORDER
        odd = np.zeros(s.n, dtype=bool)
        odd[np.searchsorted(first, np.flatnonzero(kinds == STRANGE), "right") - 1] = True
        for special in self.special:
            at = said.find(special)
            while at >= 0:
                odd[np.searchsorted(first, at, "right") - 1] = True
                at = said.find(special, at + 1)
        out = np.zeros(s.n, dtype=np.int64)
        starts, ends = pre_tokens(points, kinds)
        owner = np.searchsorted(first, starts, "right") - 1
        if odd.any():
            keep = ~odd[owner]
            starts, ends, owner = starts[keep], ends[keep], owner[keep]
            for i in np.flatnonzero(odd):
                out[i] = self.strange(said[first[i] : first[i + 1] - 1])
        if len(starts):
            _, one, same = np.unique(hash_spans(points, starts, ends), return_index=True, return_inverse=True)
            if equal_spans(points, starts, ends, one[same]):
                pieces = [said[a:b] for a, b in zip(starts[one].tolist(), ends[one].tolist(), strict=True)]
            else:
                every = Counter(said[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True))
                pieces, number = list(every), {p: i for i, p in enumerate(every)}
                same = np.array([number[said[a:b]] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
            n = np.array(self.lengths(pieces), dtype=np.int64)
            out += np.bincount(owner, weights=n[same], minlength=s.n).astype(np.int64)
        return out

    def column(self, texts: pa.Array) -> np.ndarray:
        return np.concatenate([self.of_slice(s) for s in slices(texts, SLICE_BYTES)])

    def count(self, text: str | None) -> int:
        return int(self.column(pa.array([text], pa.string()))[0])


@lru_cache(maxsize=4)
def counts_for(path: str) -> Counts:
    """One per Python worker; the proof takes a second."""
    return Counts(path)


def token_counts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """Per input row: id, ``n_bytes``, ``n_tokens``, ``over_limit``.

    ``path`` is the tokenizer file, to be found at the same place on every
    executor. Other columns of the input are not read.
    """

    def make(ids, n_bytes, texts):
        counts = counts_for(path)
        return {id_col: ids, "n_bytes": n_bytes, "n_tokens": pa.array(counts.column(texts), pa.int64())}

    kind = df.schema[id_col].dataType.simpleString()
    sized = df.select(F.col(id_col), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint").alias("n_bytes"), F.col(text_col))
    out = map_columns(sized, list(sized.columns), make, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
