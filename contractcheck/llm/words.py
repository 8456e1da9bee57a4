"""Word, shingle and line positions of Arrow text columns, for whole batches at once.

Texts are looked at as UTF-8 bytes. All separators are ASCII, so a word never
starts or ends inside a code point. Hashes are 64 bits wide and depend on the
bytes alone: they are equal on every executor and on every run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACE = 32
SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = {"p": _powers(_BASE, 2 * SLICE_BYTES), "q": _powers(_BASE_INVERSE, 2 * SLICE_BYTES)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n <= len(_POWERS["p"]):
        return _POWERS["p"][:n], _POWERS["q"][:n]
    return _powers(_BASE, n), _powers(_BASE_INVERSE, n)


def byte_table(chars: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(chars)] = True
    return table


#: Bytes of words that white space ends: everything but space and \t to \r.
NOT_BLANK = ~byte_table(b" \t\n\x0b\x0c\r")
#: Bytes of words made of ASCII letters, digits and all characters beyond ASCII.
LETTERS = byte_table(bytes([*range(48, 58), *range(97, 123), *range(128, 256)]))
#: A-Z to a-z, all else unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; different numbers stay different."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Slice:
    """Some consecutive texts: bytes with a blank before, between and after them.

    Text ``i`` lies at ``buf[offsets[i]:offsets[i + 1] - 1]``.
    """

    first: int
    buf: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.buf[self.offsets[i] : self.offsets[i + 1] - 1].tobytes()

    def spans(self, member: np.ndarray, buf: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the maximal runs of member bytes; no run crosses texts."""
        inside = member[self.buf if buf is None else buf]
        inside[0] = False
        inside[self.offsets - 1] = False
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        return edges[0::2], edges[1::2]

    def per_text(self, starts: np.ndarray) -> np.ndarray:
        """Offsets into ``starts``: those of text ``i`` are ``[out[i], out[i + 1])``."""
        return np.searchsorted(starts, self.offsets)

    def count(self, flags: np.ndarray) -> np.ndarray:
        """Bytes of each text that have the flag."""
        total = np.concatenate(([0], np.cumsum(flags)))
        return total[self.offsets[1:] - 1] - total[self.offsets[:-1]]


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span's bytes."""
    p, q = _power_tables(len(buf) + 1)
    total = np.empty(len(buf) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * p[: len(buf)], out=total[1:])
    return mix((total[ends] - total[starts]) * q[starts])


def equal_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, like: np.ndarray) -> bool:
    """Whether every span equals span ``like``: equal hashes alone would not prove it."""
    length = ends - starts
    if (length != length[like]).any():
        return False
    inside = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    return bool((buf[np.repeat(starts, length) + inside] == buf[np.repeat(starts[like], length) + inside]).all())


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a text column into slices of whole texts; nulls are empty texts.

    A slice has about ``limit`` bytes; a longer text makes a slice of its own.
    """
    if column.null_count:
        column = column.fill_null("")
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.large_string())
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    at = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
        own = at[lo : hi + 1] - at[lo]
        n = hi - lo
        buf = np.full(int(own[-1]) + n + 1, SPACE, dtype=np.uint8)
        owner = np.repeat(np.arange(n), np.diff(own))
        buf[np.arange(int(own[-1])) + owner + 1] = raw[at[lo] : at[hi]]
        yield Slice(lo, buf, own + np.arange(n + 1) + 1)
        lo = hi


def shingle_hashes(hashes: np.ndarray, per_text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``size`` consecutive words and their offsets per text.

    A text with some words, but fewer than ``size``, has one shingle of all its words.
    """
    n_words = np.diff(per_text)
    weights = mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)
    n_shingles = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
    at = np.concatenate(([0], np.cumsum(n_shingles)))
    owner = np.repeat(np.arange(len(n_words)), n_shingles)
    first = per_text[owner] + np.arange(int(at[-1])) - at[owner]
    padded = np.concatenate((hashes, np.zeros(size, np.uint64)))
    total = np.zeros(len(first), dtype=np.uint64)
    for k in range(size):
        part = padded[first + k] * weights[k]
        total += np.where(k < n_words[owner], part, np.uint64(0)) if (n_words < size).any() else part
    return mix(total), at


def map_columns(df, columns: list[str], make, schema: str):
    """``make`` turns each batch's Arrow columns into the columns of ``schema``."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                done = make(*[batch.column(i) for i in range(batch.num_columns)])
                yield pa.RecordBatch.from_arrays(list(done.values()), list(done))

    return df.select(*columns).mapInArrow(run, schema)


def filter_rows(df, text_col: str, keep):
    """The rows of ``df``, all columns unchanged, for which ``keep(slice)`` is true."""
    names = df.columns

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                flags = np.concatenate([keep(s) for s in slices(batch.column(names.index(text_col)))])
                yield batch.filter(pa.array(flags))

    return df.mapInArrow(run, df.schema)
