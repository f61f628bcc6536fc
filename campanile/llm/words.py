"""Words of many texts at once, as numpy arrays.

A word is a maximal run of characters other than space and ``\\x09``-``\\x0D``.  Texts are
laid end to end in one byte buffer, so the cost per word is a few vector operations and
no Python object is made for it.  Word hashes are polynomials over the bytes with 64-bit
coefficients, mixed at the end; equal words have equal hashes, different words collide
with a probability near 2**-64.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_ONE = np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: Bytes that are hashed at once, or a single longer word.
CHUNK = 1 << 17
_INVERSE = pow(int(_BASE), -1, 1 << 64)
_TABLES: dict[int, np.ndarray] = {}


def _powers(base: int, count: int) -> np.ndarray:
    """``base ** 0 .. count - 1`` modulo 2**64."""
    if len(_TABLES.get(base, ())) < count:
        # The next power of two: a table is as large as the largest batch met so far.
        steps = np.full(max(1 << 12, 1 << (count - 1).bit_length()), base, np.uint64)
        steps[0] = 1
        _TABLES[base] = np.cumprod(steps, dtype=np.uint64)
    return _TABLES[base]


@dataclass
class Words:
    """``start[i]:end[i]`` are word ``i``'s bytes in ``data``; text ``t`` has the words ``first[t]:first[t + 1]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, start: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash of each word, or of each given byte range without white space, in ascending order."""
        start, end = (self.start if start is None else start), (self.end if end is None else end)
        out = np.empty(len(start), np.uint64)
        at = 0
        while at < len(start):
            # A run of words of about ``CHUNK`` bytes at a time, so long texts don't need long tables.
            low = start[at]
            upto = max(at + 1, int(np.searchsorted(end, low + CHUNK, "right")))
            terms = self.data[low:end[upto - 1]].astype(np.uint64)
            terms += _ONE
            # Weights follow the place in the run; the power of the start is divided out again.
            terms *= _powers(int(_BASE), len(terms))[: len(terms)]
            total = np.zeros(len(terms) + 1, np.uint64)
            np.cumsum(terms, out=total[1:])
            first, last = start[at:upto] - low, end[at:upto] - low
            back = _powers(_INVERSE, len(terms))[first]
            out[at:upto] = mix((total[last] - total[first]) * back ^ (last - first).astype(np.uint64))
            at = upto
        return out


def split_words(texts: list[str | None], lower: bool = False) -> Words:
    """Words of each text; a null text has none.  ``lower`` folds A-Z only."""
    parts, sizes = [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        encoded = (text or "").encode("utf-8", "surrogatepass")
        parts.append(encoded)
        sizes[i] = len(encoded) + 1
    data = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
    if lower:
        data = _LOWER[data]
    space = _SPACE[data]
    edge = np.diff(np.concatenate([[True], space]).view(np.int8))
    start = np.flatnonzero(edge == -1)
    end = np.flatnonzero(edge[1:] == 1) + 1 if len(data) else start
    if len(end) < len(start):
        end = np.append(end, len(data))
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    return Words(data, start, end, np.searchsorted(start, bounds))


def shingles(words: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words and the text of each, in text order.

    A text with fewer words, but at least one, gives the whole sequence as one shingle.
    """
    hashes, counts = words.hashes(), words.counts
    made = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    text = np.repeat(np.arange(len(counts)), made)
    at = np.arange(len(text)) + np.repeat(words.first[:-1] - np.cumsum(made) + made, made)
    length = np.minimum(counts, size)[text]
    hashes = np.concatenate([hashes, np.zeros(size, np.uint64)])
    total = length.astype(np.uint64)
    for k in range(size):
        term = hashes[at + k] * _powers(int(_BASE), size)[k]
        total += term if k == 0 else np.where(length > k, term, np.uint64(0))
    return mix(total), text


def batches(blocks, weight: int = 1 << 20):
    """Arrow batches cut so that one holds about ``weight`` text bytes, or a single row."""
    for block in blocks:
        start, size = 0, block.nbytes
        step = max(1, int(block.num_rows * weight / max(size, 1)))
        while start < block.num_rows:
            yield block.slice(start, step)
            start += step
