"""Arrow-batch text kernels: words and hashed word n-grams as numpy arrays.

A text column arrives in a task as Arrow buffers (one byte array plus offsets);
the kernels work on those bytes directly, so no Python string is made per word.
Texts are handled in blocks of at most ``BLOCK`` bytes (a longer text forms a block
of its own), which bounds the memory of a task by the longest text.

UTF-8 bytes of 0x80 and above never occur inside an ASCII character, so every
byte-class rule here equals the same rule on characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 19

#: Separators of the word rule ``[^\x20\x09-\x0D]+``.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: The word rule ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z became a-z.
ALNUM_WORD = np.zeros(256, bool)
ALNUM_WORD[0x30:0x3A] = ALNUM_WORD[0x41:0x5B] = ALNUM_WORD[0x61:0x7B] = ALNUM_WORD[0x80:] = True

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[0x41:0x5B] = _BYTE[0x61:0x7B]
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the hash base and of its inverse modulo 2**64."""
    global _powers
    if len(_powers[0]) >= n:
        return _powers
    size = max(n, BLOCK + 1)
    tables = []
    for base in (_BASE, _BASE_INV):
        t = np.full(size, base, np.uint64)
        t[0] = 1
        tables.append(np.cumprod(t, dtype=np.uint64))
    if size <= 4 * BLOCK:  # keep the usual size only, not that of one very long text
        _powers = tuple(tables)
    return tuple(tables)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


class Texts:
    """A run of texts: their bytes, and where each begins (``starts`` has one more entry)."""

    def __init__(self, first: int, data: np.ndarray, starts: np.ndarray):
        self.first, self.data, self.starts = first, data, starts

    def __len__(self) -> int:
        return len(self.starts) - 1


def blocks(column: pa.Array, block: int = BLOCK) -> Iterator[Texts]:
    """Cut a string or binary column into runs of whole texts; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    everything = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    at = 0
    while at < n:
        end = max(int(np.searchsorted(starts, starts[at] + block, "right")) - 1, at + 1)
        yield Texts(at, everything[starts[at] : starts[end]], starts[at : end + 1] - starts[at])
        at = end


def runs(texts: Texts, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of the byte class ``member`` within each text: begin, end, index of the text."""
    inside = member[texts.data]
    if not len(inside):
        none = np.empty(0, np.int64)
        return none, none, none
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    edges = texts.starts[1:-1]
    edges = edges[edges < len(inside)]
    before[edges] = False
    begin = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    edges = edges[edges > 0]
    after[edges - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    return begin, end, np.searchsorted(texts.starts, begin, "right") - 1


class Hasher:
    """Hashes of any byte ranges of one block of texts, from one prefix sum."""

    def __init__(self, data: np.ndarray, lower: bool = False):
        self.power, self.inverse = _power_tables(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((_BYTE_LOWER if lower else _BYTE)[data] * self.power[: len(data)], out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[begin]) * self.inverse[begin]
        return mix(h + (end - begin).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def words(texts: Texts, member: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word and the index of its text, in order."""
    begin, end, owner = runs(texts, member)
    return Hasher(texts.data, lower).of(begin, end), owner


def grams(h: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n consecutive words within a text, and the index of their text."""
    if len(h) < n:
        return h[:0], owner[:0]
    out = h[: len(h) - n + 1].copy()
    for k in range(1, n):
        out = mix(out * np.uint64(0x9FB21C651E98DF25)) + h[k : len(h) - n + 1 + k]
    whole = owner[: len(owner) - n + 1] == owner[n - 1 :]
    return mix(out[whole] + np.uint64(n)), owner[: len(owner) - n + 1][whole]


def shingle_sets(texts: Texts, k: int, member: np.ndarray = NOT_SPACE, lower: bool = True) -> list[np.ndarray]:
    """Per text: sorted distinct hashes of its k-word shingles.

    A text of fewer than k words has its whole word sequence as one shingle; a text
    without words has none.
    """
    h, owner = words(texts, member, lower)
    n_words = np.bincount(owner, minlength=len(texts))
    s, of = grams(h, owner, k)
    cut = np.searchsorted(of, np.arange(len(texts) + 1))
    out = [np.unique(s[a:b]) for a, b in zip(cut[:-1], cut[1:])]
    short = np.flatnonzero((n_words > 0) & (n_words < k))
    first = np.searchsorted(owner, short)
    for t, f in zip(short.tolist(), first.tolist()):
        n = int(n_words[t])
        out[t] = grams(h[f : f + n], owner[f : f + n], n)[0]
    return out
