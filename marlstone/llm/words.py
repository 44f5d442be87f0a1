"""Words, lines and their hashes for whole Arrow batches in numpy, without a Python object per word.

A word is a maximal run of bytes other than space and \\x09-\\x0D of the UTF-8 text. Null texts are empty.
Word hashes are polynomial over 2**64 with a final mixing step, so equal words have equal hashes on every machine.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
#: Texts are handled in slices of about so many bytes (one text at least), which bounds the memory of the arrays here.
SLICE_BYTES = 1 << 20


def spaces() -> np.ndarray:
    lut = np.zeros(256, bool)
    lut[[0x20, *range(0x09, 0x0E)]] = True
    return lut


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**n modulo 2**64; kept up to a few slices' length."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        size = max(n + n // 4, 1 << 16)
        have = np.empty(size + 1, np.uint64)
        have[0] = 1
        have[1:] = base & (2**64 - 1)
        have = np.multiply.accumulate(have)
        if size <= 4 * SLICE_BYTES:
            _powers[base] = have
    return have


def tidied(out: Iterator) -> Iterator:
    """What a task returns. When it is through, what it has freed goes back to the system: Python's workers are used
    again for other tasks, and would keep it beside Spark's own memory."""
    yield from out
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


@dataclass
class Texts:
    """Some consecutive texts of a batch: their bytes, the n+1 offsets, and where the first stands in the batch."""

    data: np.ndarray
    offsets: np.ndarray
    first: int

    def __len__(self) -> int:
        return len(self.offsets) - 1


def slices(column: pa.Array | pa.ChunkedArray, most: int = SLICE_BYTES) -> Iterator[Texts]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    _, at, raw = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        j = min(j, n)
        yield Texts(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], i)
        i = j


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of each maximal run of `inside`; no run crosses from one text to the next."""
    n = len(inside)
    if not n:
        e = np.zeros(0, np.int64)
        return e, e, e
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    edges = offsets[:-1][offsets[:-1] < n]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[edges[edges > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def prefix(data: np.ndarray) -> np.ndarray:
    """Sums of byte * BASE**position before each position."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data))[: len(data)], out=out[1:])
    return out


def hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A mixed 64-bit hash of each byte range."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    return mix((sums[ends] - sums[starts]) * powers(INVERSE, len(sums))[starts] + (ends - starts).astype(np.uint64))


def words(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, text and hash of each word."""
    starts, ends, doc = runs(~spaces()[t.data], t.offsets)
    return starts, ends, doc, hashes(prefix(t.data), starts, ends)


def windows(word_hash: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word and hash of each window of n words inside one text."""
    if len(word_hash) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(doc[: len(doc) - n + 1] == doc[n - 1 :])
    h = np.zeros(len(at), np.uint64)
    for k in range(n):
        h = h * np.uint64(0xD6E8FEB86659FD93) + word_hash[at + k]
    return at, mix(h)


def shingles(word_hash: np.ndarray, doc: np.ndarray, n_docs: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of each shingle of n words, in order of the texts; a text of 1 to n-1 words has one, of all its words."""
    at, h = windows(word_hash, doc, n)
    owner = doc[at]
    count = np.bincount(doc, minlength=n_docs)
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        first = np.searchsorted(doc, short)
        extra = np.zeros(len(short), np.uint64)
        for k in range(n - 1):
            has = k < count[short]
            extra[has] = extra[has] * np.uint64(0xD6E8FEB86659FD93) + word_hash[first[has] + k]
        h = np.concatenate([h, mix(extra + count[short].astype(np.uint64))])
        owner = np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        h, owner = h[order], owner[order]
    return h, owner
