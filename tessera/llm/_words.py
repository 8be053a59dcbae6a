"""Words of a batch of texts: distinct-word caches and vectorised word hashes.

These run inside a Spark task on one Arrow batch at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd

# an odd multiplier has an inverse modulo 2^64
_BASE = 0x9E3779B97F4A7C15
_HASHED_AT_ONCE = 1 << 18


def batches_of(frames: Iterable[pd.DataFrame], column: str, max_chars: int) -> Iterator[pd.DataFrame]:
    """The frames cut so that one piece holds about ``max_chars`` characters of text, one row at least."""
    for frame in frames:
        if not len(frame):
            continue
        sizes = np.array([len(t) if isinstance(t, str) else 0 for t in frame[column]], dtype=np.int64)
        part = (np.cumsum(sizes) - sizes) // max_chars
        for _, piece in frame.groupby(part, sort=False):
            yield piece


def joined_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of the ranges ``starts[i] .. starts[i] + lengths[i]``, one after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total, dtype=np.int64)


@lru_cache(maxsize=1)
def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up = np.full(n + 1, _BASE, np.uint64)
        up[0] = 1
        down = np.full(n + 1, pow(_BASE, -1, 1 << 64), np.uint64)
        down[0] = 1
        return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n + 1 powers of the base and of its inverse modulo 2^64."""
    up, down = _power_table(1 << max(19, n.bit_length()))
    return up[:n + 1], down[:n + 1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a fixed one-to-one map)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SYMBOL = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the sub-sequences ``values[s:e]``; equal contents have equal hashes.

    ``values`` are bytes, or 64-bit values that are well spread already.  Ranges in ascending order are hashed a
    piece of the values at a time: a hash does not depend on where its range lies."""
    if not len(values):
        return np.zeros(len(starts), np.uint64)
    if len(values) > _HASHED_AT_ONCE and not (starts[1:] < starts[:-1]).any():
        out = np.empty(len(starts), np.uint64)
        cuts = np.flatnonzero(np.diff(starts // _HASHED_AT_ONCE)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(starts)], strict=True):
            if a < b:
                low, high = starts[a], ends[a:b].max()
                out[a:b] = _hashes_within(values[low:high], starts[a:b] - low, ends[a:b] - low)
        return out
    return _hashes_within(values, starts, ends)


def _hashes_within(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    spread = _SYMBOL[values] if values.dtype == np.uint8 else values
    up, down = _powers(len(values))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(spread * up[:-1], dtype=np.uint64)])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(_BASE))


def text_bytes(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of the texts one after the other, each followed by one zero byte, and where each begins."""
    parts = [(t or "").encode() if isinstance(t, str) else b"" for t in texts]
    lengths = np.array([len(p) + 1 for p in parts], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    data = np.frombuffer(b"\0".join(parts) + b"\0" if parts else b"", dtype=np.uint8)
    return data, starts


# A-Z lower-cased, all other bytes as they are
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def cut_documents(cuts: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of documents laid out as by ``text_bytes``: each begins where
    ``cuts`` holds and at the start of a document.  Starts, ends, and the
    number of words of each document."""
    if len(cuts):
        cuts[starts[:-1]] = True
        cuts[starts[1:] - 1] = True  # the zero byte after a document
    at = np.flatnonzero(cuts)
    closing = np.isin(at, starts[1:] - 1, assume_unique=True)
    ends = np.append(at[1:], len(cuts))
    document = np.searchsorted(starts, at, side="right") - 1
    return at[~closing], ends[~closing], np.bincount(document[~closing], minlength=len(starts) - 1)


def word_ranges(data: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the maximal runs of bytes for which the 256-entry table ``is_word`` holds."""
    inside = np.concatenate([[False], is_word[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]


class WordCodes:
    """Codes of words, computed once for each distinct word and kept up to ``max_words``.

    ``encode`` takes the words as ranges of a byte array.  Equal words are
    found by 64-bit hashes of their bytes; ``encode_words`` gets the new ones
    and returns their codes as one flat array and the number of codes of each.
    """

    def __init__(self, encode_words: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], dtype,
                 max_words: int = 600_000):
        self._encode, self._dtype, self._max = encode_words, dtype, max_words
        self._clear()

    def _clear(self):
        self._hash = np.empty(0, np.uint64)  # sorted
        self._slot = np.empty(0, np.int64)
        self._flat = np.empty(0, self._dtype)
        self._start = np.empty(0, np.int64)
        self._length = np.empty(0, np.int64)

    def _add(self, hashes: np.ndarray, words: list[bytes]):
        flat, lengths = self._encode(words)
        at = np.searchsorted(self._hash, hashes)
        self._hash = np.insert(self._hash, at, hashes)
        self._slot = np.insert(self._slot, at, len(self._start) + np.arange(len(words)))
        self._start = np.concatenate([self._start, len(self._flat) + np.cumsum(lengths) - lengths])
        self._flat = np.concatenate([self._flat, flat.astype(self._dtype)])
        self._length = np.concatenate([self._length, lengths])

    def encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
               counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all words as one flat array, and the number of codes of
        each document; ``counts`` holds the words of each document."""
        distinct, first, inverse = np.unique(range_hashes(data, starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(self._hash, distinct)
        known = at < len(self._hash)
        known[known] = self._hash[at[known]] == distinct[known]
        new = np.flatnonzero(~known)
        if len(self._hash) + len(new) > self._max:
            self._clear()
            new = np.arange(len(distinct))
        if len(new):
            raw = data.tobytes()
            at = first[new]
            self._add(distinct[new], [raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
        slots = self._slot[np.searchsorted(self._hash, distinct)][inverse]
        lengths = self._length[slots]
        total = np.concatenate([[0], np.cumsum(lengths)])
        bounds = np.concatenate([[0], np.cumsum(counts)])
        return self._flat[joined_ranges(self._start[slots], lengths)], np.diff(total[bounds])
