"""Word boundaries and word hashes of whole batches of text, vectorised over bytes.

A word is a run of ASCII letters and digits and of any non-ASCII characters; A-Z are
lower-cased. In UTF-8 every byte of a non-ASCII character is above 0x7F, so bytes decide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 500_000  # bytes hashed at a time

IS_WORD = np.zeros(256, bool)
IS_WORD[0x80:] = IS_WORD[0x30:0x3A] = IS_WORD[0x41:0x5B] = IS_WORD[0x61:0x7B] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_BASE = 0x9E3779B97F4A7C15
_POWERS = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]
_BYTES = np.random.Generator(np.random.PCG64(20)).integers(0, 1 << 63, 256, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> list[np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, cached for one process."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and where each text begins (nulls are empty)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def find_words(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, byte after the last, and text number of every word."""
    if not len(raw):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = IS_WORD[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[at] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(at, starts, "right") - 1


def hash_words(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, of its lower-cased bytes alone."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        low = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, low + PIECE, "right")))
        values = _BYTES[LOWER[raw[low : ends[j - 1]]]]
        powers, inverse = _powers(max(PIECE, len(values)))
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * powers[: len(values)], out=sums[1:])
        a, b = starts[i:j] - low, ends[i:j] - low
        out[i:j] = mixed((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64))
        i = j
    return out


def hash_shingles(words: np.ndarray, doc: np.ndarray, n_docs: int, width: int):
    """Hashes of ``width`` consecutive words; a text of fewer words, but not none, is one shingle.

    Gives the hash and the text number of each shingle, texts in order.
    """
    counts = np.bincount(doc, minlength=n_docs)
    firsts = np.cumsum(counts) - counts
    within = np.arange(len(words)) - firsts[doc]
    begins = np.flatnonzero((within + width <= counts[doc]) | ((within == 0) & (counts[doc] < width)))
    total = np.zeros(len(begins), np.uint64)
    for k in range(width):
        place = np.minimum(begins + k, len(words) - 1)
        there = (doc[place] == doc[begins]) & (begins + k < len(words))
        total = mixed(total * np.uint64(_BASE) + np.where(there, words[place], np.uint64(k)))
    return total, doc[begins]
