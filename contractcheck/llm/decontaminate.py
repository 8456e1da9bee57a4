"""Benchmark decontamination with a generalised suffix automaton.

All test items go into one automaton over words. Training texts are streamed
through it; at every word it gives the length of the longest item passage that
ends there. A word is hit if it lies inside an occurrence of a window: ``size``
consecutive words of an item, or a whole item that is shorter.

Texts are cut into short lanes that advance together, one word of every lane per
step. A lane starts ``size - 1`` words early, so that every length up to ``size``
is the one an unbroken walk would give. Positions that the automaton reports are
then compared word by word with the items, which also names the items.

Defined results: null and empty texts have no words and no hits; null and empty
items have no windows; an item's null id reads as an empty string; items with one
id count as one. Repeated rows give repeated results. The automaton is built on
the driver and sent to the executors, so the items' text must stay below
``max_item_bytes``; a larger benchmark raises an error instead of losing items.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contractcheck.llm.words import LETTERS, LOWER, hash_spans, map_columns, slices

WINDOW = 10
LANE = 96
MAX_ITEM_BYTES = 256 << 20


class Automaton:
    """Suffix automaton of many word sequences; state 0 is the empty passage."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """A state for the shorter passages of ``q`` that end in the one reached from ``p``."""
        if self.length[q] == self.length[p] + 1:
            return q
        twin = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = twin
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = twin
            p = self.link[p]
        return twin

    def extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            return self._split(last, c, self.next[last][c])
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, c, self.next[p][c])
        return new

    def add(self, words: list[int]) -> None:
        last = 0
        for c in words:
            last = self.extend(last, c)

    def find(self, words: list[int]) -> int:
        state = 0
        for c in words:
            state = self.next[state][c]
        return state


def _words(texts: list[str | None]) -> list[tuple[list[bytes], np.ndarray]]:
    """Normalised words of each text with their hashes."""
    out = []
    for s in slices(pa.array(texts, pa.string())):
        low = LOWER[s.buf]
        starts, ends = s.spans(LETTERS, low)
        hashes, at = hash_spans(low, starts, ends), s.per_text(starts)
        for i in range(s.n):
            a, b = at[i], at[i + 1]
            out.append(([low[x:y].tobytes() for x, y in zip(starts[a:b], ends[a:b], strict=True)], hashes[a:b]))
    return out


class Matcher:
    """The automaton of a benchmark as arrays, and its windows for the exact check."""

    def __init__(self, items: list[tuple[str, str | None]], size: int = WINDOW):
        self.size = size
        self.windows: dict[bytes, set[str]] = defaultdict(set)
        self.short: set[int] = set()
        sequences = []
        for (name, _), (words, hashes) in zip(items, _words([t for _, t in items]), strict=True):
            k = min(size, len(words))
            if k:
                sequences.append((hashes, k))
                if k < size:
                    self.short.add(k)
                for i in range(len(words) - k + 1):
                    self.windows[b" ".join(words[i : i + k])].add(name)
        self.vocabulary = np.unique(np.concatenate([h for h, _ in sequences])) if sequences else np.zeros(0, np.uint64)
        automaton, v = Automaton(), len(self.vocabulary)
        coded = [(np.searchsorted(self.vocabulary, h).tolist(), k) for h, k in sequences]
        for words, _ in coded:
            automaton.add(words)
        n = len(automaton.next)
        self.link = np.maximum(np.array(automaton.link, dtype=np.int64), 0)
        self.length = np.array(automaton.length, dtype=np.int64)
        self.root = np.zeros(v, dtype=np.int64)
        for c, to in automaton.next[0].items():
            self.root[c] = to
        moves = sorted((s * v + c, to) for s in range(1, n) for c, to in automaton.next[s].items())
        self.keys = np.array([k for k, _ in moves] + [np.iinfo(np.int64).max], dtype=np.int64)
        self.to = np.array([t for _, t in moves] + [0], dtype=np.int64)
        # A short item ends where its state is reached with its length, and in all states below its own.
        none = np.iinfo(np.int64).max
        self.short_here = np.full(n, none, dtype=np.int64)
        for words, k in coded:
            if k < size:
                s = automaton.find(words)
                self.short_here[s] = min(self.short_here[s], k)
        self.short_above = np.zeros(n, dtype=bool)
        for s in np.argsort(self.length, kind="stable")[1:]:
            up = self.link[s]
            self.short_above[s] = self.short_above[up] or self.short_here[up] < none
        self.seen = np.zeros(1 << 16, dtype=bool)
        self.seen[(self.vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        """Vocabulary numbers of words, -1 for words of no item."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        at = np.flatnonzero(self.seen[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        found = np.searchsorted(self.vocabulary, hashes[at])
        same = self.vocabulary[np.minimum(found, len(self.vocabulary) - 1)] == hashes[at]
        out[at[same]] = found[same]
        return out

    def ends(self, codes: np.ndarray, per_text: np.ndarray) -> np.ndarray:
        """True at words where a window ends, as the automaton sees it."""
        out, warm = np.zeros(len(codes), dtype=bool), self.size - 1
        n_words = np.diff(per_text)
        lanes = -(-n_words // LANE)
        owner = np.repeat(np.arange(len(n_words)), lanes)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        counted = per_text[owner] + nth * LANE
        start = np.maximum(counted - warm, per_text[owner])
        stop = np.minimum(counted + LANE, per_text[owner + 1])
        order = np.argsort(start - stop, kind="stable")
        start, stop, counted = start[order], stop[order], counted[order]
        left = stop - start
        state, length = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        v = len(self.vocabulary)
        for step in range(int(left[0]) if len(left) else 0):
            n = int(np.searchsorted(-left, -step, "left"))
            c = codes[start[:n] + step]
            lost = c < 0
            state[:n][lost] = 0
            length[:n][lost] = 0
            open_ = np.flatnonzero(~lost)
            while len(open_):
                s, w = state[open_], c[open_]
                at_root = s == 0
                r = open_[at_root]
                to = self.root[w[at_root]]
                state[r] = to
                length[r] = to > 0
                open_, s, w = open_[~at_root], s[~at_root], w[~at_root]
                key = s * v + w
                at = np.searchsorted(self.keys, key)
                hit = self.keys[at] == key
                state[open_[hit]] = self.to[at[hit]]
                length[open_[hit]] += 1
                open_ = open_[~hit]
                state[open_] = self.link[s[~hit]]
                length[open_] = self.length[state[open_]]
            end = length[:n] >= self.size
            if self.short:
                end |= self.short_above[state[:n]] | (length[:n] >= self.short_here[state[:n]])
            found = np.flatnonzero(end)
            at = start[found] + step
            out[at[at >= counted[found]]] = True
        return out

    def scan(self, s) -> tuple[np.ndarray, dict[int, tuple[list[tuple[int, int]], int, set[str]]]]:
        """Words per text; for texts with hits: byte spans in the slice, words hit, items."""
        low = LOWER[s.buf]
        starts, ends = s.spans(LETTERS, low)
        at = s.per_text(starts)
        n_words = np.diff(at)
        if not len(self.vocabulary) or not len(starts):
            return n_words, {}
        reported = np.flatnonzero(self.ends(self.codes(hash_spans(low, starts, ends)), at))
        hit, items = np.zeros(len(starts), dtype=bool), defaultdict(set)
        owner = np.searchsorted(at, reported, "right") - 1
        sizes = sorted(self.short | {self.size})
        for e, i in zip(reported.tolist(), owner.tolist(), strict=True):
            first = at[i]
            words = [low[starts[x] : ends[x]].tobytes() for x in range(max(first, e - self.size + 1), e + 1)]
            for k in sizes:
                if k <= len(words) and (names := self.windows.get(b" ".join(words[-k:]))):
                    hit[e - k + 1 : e + 1] = True
                    items[i] |= names
        found = {}
        for i, names in items.items():
            own = np.concatenate(([False], hit[at[i] : at[i + 1]], [False]))
            edges = np.flatnonzero(own[1:] != own[:-1]) + at[i]
            runs = [(int(starts[a]), int(ends[b - 1])) for a, b in zip(edges[0::2], edges[1::2], strict=True)]
            found[i] = (runs, int(own.sum()), names)
        return n_words, found


def matcher(benchmark: DataFrame, size: int = WINDOW, id_col: str = "item_id", text_col: str = "text", max_item_bytes: int = MAX_ITEM_BYTES) -> Matcher:
    """Read the items, after their size was checked, and build the automaton."""
    n_bytes = benchmark.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
    if n_bytes > max_item_bytes:
        raise ValueError(f"the items have {n_bytes} bytes, more than max_item_bytes={max_item_bytes}")
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"), F.col(text_col).alias("t")).distinct().collect()
    return Matcher(sorted((r["i"], r["t"]) for r in rows if r["t"] is not None), size)


def contamination(df: DataFrame, benchmark: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per input row: id, ``n_words``, ``n_hit``, ``items`` (their ids, sorted) and ``spans``.

    ``spans`` are the runs of hit words, as code point positions, end exclusive.
    """
    shared = df.sparkSession.sparkContext.broadcast(matcher(benchmark, size, item_id_col, item_text_col))
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def make(ids, texts):
        own, n_words, n_hit, items, spans = shared.value, [], [], [], []
        for s in slices(texts):
            words, found = own.scan(s)
            n_words.append(words)
            for i in range(s.n):
                runs, n, names = found.get(i, ((), 0, ()))
                n_hit.append(n)
                items.append(sorted(names))
                if runs:
                    lead = np.concatenate(([0], np.cumsum((s.buf & 0xC0) != 0x80)))
                    base = lead[s.offsets[i]]
                    spans.append([{"start": int(lead[a] - base), "end": int(lead[b] - base)} for a, b in runs])
                else:
                    spans.append([])
        return {
            id_col: ids,
            "n_words": pa.array(np.concatenate(n_words), pa.int64()),
            "n_hit": pa.array(n_hit, pa.int64()),
            "items": pa.array(items, pa.list_(pa.string())),
            "spans": pa.array(spans, pa.list_(span)),
        }

    kind = df.schema[id_col].dataType.simpleString()
    return map_columns(df, [id_col, text_col], make, f"`{id_col}` {kind}, n_words bigint, n_hit bigint, items array<string>, spans array<struct<start:bigint,end:bigint>>")


def clean(own: Matcher, texts: list[str | None], min_span: int, max_share: float) -> list[str | None]:
    """Texts without their hit spans; None for those to be dropped.

    A run of at least ``min_span`` hit words is cut out. Cutting can bring two
    halves of an item together, so a changed text is looked at again. A text
    with a hit share above ``max_share`` is dropped, one that was null stays null.
    """
    out = list(texts)
    todo = list(range(len(texts)))
    first = True
    while todo:
        again, at = [], 0
        for s in slices(pa.array([out[i] for i in todo], pa.large_string())):
            n_words, found = own.scan(s)
            for i, (runs, n_hit, _) in found.items():
                place = todo[at + i]
                if first and n_hit > max_share * int(n_words[i]):
                    out[place] = None
                    continue
                low, keep, last = LOWER[s.buf], [], int(s.offsets[i])
                for a, b in runs:
                    x, _ = s_words(low[a:b])
                    if x >= min_span:
                        keep.append(s.buf[last:a].tobytes())
                        last = b
                if keep:
                    keep.append(s.buf[last : s.offsets[i + 1] - 1].tobytes())
                    out[place] = b"".join(keep).decode("utf-8")
                    again.append(place)
            at += s.n
        todo, first = again, False
    return out


def s_words(low: np.ndarray) -> tuple[int, np.ndarray]:
    """Number of words in normalised bytes."""
    inside = np.concatenate(([False], LETTERS[low]))
    begins = inside[1:] & ~inside[:-1]
    return int(begins.sum()), begins


def decontaminated(df: DataFrame, benchmark: DataFrame, size: int = WINDOW, min_span: int = 1, max_share: float = 0.5, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """The rows of ``df``, with all their columns, without benchmark passages.

    Runs of ``min_span`` or more hit words are cut out of the text; rows where more
    than ``max_share`` of the words are hit are left out. ``length_col``, if given,
    gets the new number of characters where the text has changed.
    """
    shared = df.sparkSession.sparkContext.broadcast(matcher(benchmark, size))
    names = df.columns
    t = names.index(text_col)

    def run(batches):
        own = shared.value
        for batch in batches:
            texts = batch.column(t)
            touched, at = [], 0
            for s in slices(texts):
                _, found = own.scan(s)
                touched += [at + i for i in found]
                at += s.n
            if touched:
                old = [texts[i].as_py() for i in touched]
                new = clean(own, old, min_span, max_share)
                keep = np.ones(batch.num_rows, dtype=bool)
                keep[[i for i, x in zip(touched, new, strict=True) if x is None]] = False
                columns = {f.name: batch.column(k) for k, f in enumerate(batch.schema)}
                order = np.arange(batch.num_rows)
                order[touched] = batch.num_rows + np.arange(len(touched))
                columns[text_col] = pa.concat_arrays([texts, pa.array(new, texts.type)]).take(pa.array(order))
                if length_col is not None:
                    sizes = columns[length_col]
                    columns[length_col] = pa.concat_arrays([sizes, pa.array([None if x is None else len(x) for x in new], sizes.type)]).take(pa.array(order))
                batch = pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns)).filter(pa.array(keep))
            yield batch

    return df.mapInArrow(run, df.schema)
