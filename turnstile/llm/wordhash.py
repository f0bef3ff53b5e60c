"""Word hashes of Arrow string batches, computed on whole buffers with numpy.

Words are maximal runs of bytes other than space and 9..13; a batch becomes one
array of 64-bit word hashes and the word offsets of its texts.  Sequences of words
are hashed by polynomials, whose prefix sums give any range in one step.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
#: odd multipliers (any odd numbers with well-spread bits do)
BYTE_BASE = U(0x9E3779B97F4A7C15)
WORD_BASE = U(0xD6E8FEB86659FD93)
SECOND_BASE = U(0xA0761D6478BD642F)
MIX_A, MIX_B = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: bytes with A-Z lower-cased
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
#: bytes hashed at a time, which bounds the arrays a task holds
SLICE_BYTES = 4 << 20
#: bytes whose word hashes are computed at once (small, to stay in a core's cache)
HASH_BYTES = 1 << 16


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = (x ^ (x >> U(30))) * MIX_A
    x = (x ^ (x >> U(27))) * MIX_B
    return x ^ (x >> U(31))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**n at least; tables are kept per process and grow by doubling."""
    known = _POWERS.get(int(base))
    if known is None or len(known) <= n:
        out = np.full(max(1 << 16, 1 << int(n).bit_length()) + 1, base, U)
        out[0] = 1
        known = _POWERS[int(base)] = np.cumprod(out, dtype=U)
    return known


def inverse(base: np.uint64) -> np.uint64:
    """The inverse of an odd number modulo 2**64."""
    return U(pow(int(base), -1, 1 << 64))


class Prefix:
    """Polynomial hashes of ranges of a 64-bit array."""

    def __init__(self, values: np.ndarray, base: np.uint64 = WORD_BASE):
        n = len(values)
        self.sums = np.zeros(n + 1, U)
        np.cumsum(values * powers(base, n)[:n], out=self.sums[1:], dtype=U)
        self.back = powers(inverse(base), n)

    def hashes(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Mixed hashes of values[start:stop]; equal content and length, equal hash."""
        raw = (self.sums[stop] - self.sums[start]) * self.back[start]
        return mixed(raw + (stop - start).astype(U) * MIX_B)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null texts are empty."""
    column = column.cast(pa.large_string()).fill_null("") if column.null_count else column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def word_spans(raw: np.ndarray, offsets: np.ndarray,
               space: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop) bytes of every word, and the word offsets of the texts; ``space``: which bytes separate.

    Texts stand next to each other, so a word also starts where a text does.
    """
    solid = ~space[raw]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    at = offsets[:-1][np.diff(offsets) > 0]
    begins[at] = solid[at]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:]
    last = offsets[1:][np.diff(offsets) > 0] - 1
    ends[last] = solid[last]
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, stop, np.searchsorted(start, offsets)


def word_hashes(raw: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words; long inputs are hashed in slices that end between words."""
    out = np.empty(len(start), U)
    lo = 0
    while lo < len(start):
        hi = max(lo + 1, int(np.searchsorted(stop, start[lo] + HASH_BYTES)))
        base = start[lo]
        part = raw[base:stop[hi - 1]].astype(U) + U(1)
        out[lo:hi] = Prefix(part, BYTE_BASE).hashes(start[lo:hi] - base, stop[lo:hi] - base)
        lo = hi
    return out


def hashed_texts(column: pa.Array, space: np.ndarray = IS_SPACE, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, word offsets of the texts) of a string column; ``lower``: A-Z count as a-z."""
    raw, offsets = text_buffers(column)
    if lower:
        raw = LOWER[raw]
    start, stop, at = word_spans(raw, offsets, space)
    return word_hashes(raw, start, stop), at


def owners(offsets: np.ndarray) -> np.ndarray:
    """Which text each word belongs to."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES):
    """Parts of a batch of about ``limit`` text bytes (one longer text is a part of its own)."""
    lengths = np.diff(text_buffers(batch.column(column))[1])
    lo, size = 0, 0
    for i, n in enumerate(lengths):
        if i > lo and size + n > limit:
            yield batch.slice(lo, i - lo)
            lo, size = i, 0
        size += n
    if lo < batch.num_rows:
        yield batch.slice(lo)
