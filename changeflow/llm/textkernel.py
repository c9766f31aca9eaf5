r"""Words and shingles of whole Arrow batches as numpy arrays.

Words are runs of ``[^\x20\x09-\x0D]`` in UTF-8.  Their hashes have 64 bits
and depend on all bytes, so equal hashes stand for equal words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: Bytes of text that are worked on at once; one longer text is one piece.
PIECE_BYTES = 2_000_000
_C1, _C2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
KEEP = np.array([(1 << 8 * i) - 1 for i in range(8)] + [2**64 - 1], dtype=np.uint64)


def released(run: Callable) -> Callable:
    """A partition function that gives its free memory back at the end: a
    worker is kept for other tasks and would hold on to it."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass

    return wrapped


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose values look random."""
    x = (x ^ (x >> np.uint64(30))) * _C1
    x = (x ^ (x >> np.uint64(27))) * _C2
    return x ^ (x >> np.uint64(31))


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column and the offsets of its rows (a null counts as an empty text); nothing is copied."""
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, kind)[texts.offset : texts.offset + n + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), offsets


def pieces(texts: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of rows with up to ``limit`` bytes.

    A null counts as an empty text.  The bytes are a copy with 8 zeros behind.
    """
    n, at = len(texts), 0
    data, offsets = raw(texts)
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        size = offsets[end] - offsets[at]
        buf = np.zeros(size + 8, np.uint8)
        buf[:size] = data[offsets[at] : offsets[end]]
        yield at, end, buf, offsets[at : end + 1] - offsets[at]
        at = end


def spans(buf: np.ndarray, offsets: np.ndarray, outside: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and per text the number of the first word
    (one more entry: the number of words).  ``outside``: bytes between words."""
    n = int(offsets[-1])
    inside = ~outside[buf[:n]]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True  # words end with their text
    start, stop = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:n]
    stop[:-1] &= ~inside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(start), np.flatnonzero(stop) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, 8 bytes a step."""
    lanes = np.ndarray((len(buf) - 7,), "<u8", buf, strides=(1,))
    left = ends - starts
    h = mix(left.astype(np.uint64) * _GOLD + np.uint64(seed))
    which, at = np.arange(len(starts)), starts
    while len(which):
        lane = lanes[at] & KEEP[np.minimum(left, 8)]
        h[which] = mix(h[which] ^ (lane * _GOLD + np.uint64(1)))
        more = left > 8
        which, at, left = which[more], at[more] + 8, left[more] - 8
    return h


def shingles(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``width`` words of each text, and per text the
    number of the first; a text of fewer words (but one at least) has one,
    of all its words."""
    counts = np.diff(first)
    made = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    begin = np.concatenate([[0], np.cumsum(made)])
    out = np.zeros(begin[-1], np.uint64)
    # the word that each shingle starts with
    at = np.arange(begin[-1]) - np.repeat(begin[:-1], made) + np.repeat(first[:-1], made)
    full = np.repeat(counts >= width, made)
    if full.any():
        h = np.full(int(full.sum()), width, np.uint64) * _GOLD
        for k in range(width):
            h = mix(h ^ words[at[full] + k]) + _GOLD
        out[full] = h
    for i in np.flatnonzero((counts > 0) & (counts < width)):
        h = np.full(1, counts[i], np.uint64) * _GOLD
        for w in words[first[i] : first[i + 1]]:
            h = mix(h ^ w) + _GOLD
        out[begin[i]] = h[0]
    return out, begin


def distinct(values: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct values of each text, and per text the first's number."""
    which = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    order = np.lexsort((values, which))
    values = values[order]  # texts stay in place, their values are sorted
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (which[1:] != which[:-1])
    return values[new], np.concatenate([[0], np.cumsum(np.bincount(which[new], minlength=len(begin) - 1))])
