"""Word shingles of whole texts as 64-bit hashes, for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tidemark.llm.flat import mixed

_ODD, _AT_ONCE = 0xD6E8FEB86659FD93, 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64)


def _powers(base: int, size: int) -> np.ndarray:
    factors = np.full(size + 1, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


_UP, _DOWN = _powers(_ODD, _AT_ONCE), _powers(pow(_ODD, -1, 1 << 64), _AT_ONCE)


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the place of each text's first word among them (one more entry for the end).

    Words are runs of bytes other than white space, A-Z lower-cased. The sum of byte values times powers of an odd
    number is taken over all bytes once; a word's part of it, brought back by the inverse power, is its hash.
    """
    up, down = (_UP, _DOWN) if len(data) <= _AT_ONCE else (_powers(_ODD, len(data)), _powers(pow(_ODD, -1, 1 << 64), len(data)))
    space = _SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = True
    before = np.concatenate([[True], space[:-1]]) if len(data) else np.zeros(0, bool)
    first = np.flatnonzero(~space & (before | edge[:-1]))
    after = np.concatenate([space[1:], [True]]) if len(data) else np.zeros(0, bool)
    last = np.flatnonzero(~space & (after | edge[1:])) + 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_LETTER[_LOWER[data]] * up[: len(data)], dtype=np.uint64)])
    words = mixed((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))
    return words, np.searchsorted(first, starts)


def shingle_sets(data: np.ndarray, starts: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of ``size`` words of each text.

    A text of fewer words has its whole sequence of words as one shingle, a text without words none.
    """
    begin = 0
    while begin < len(starts) - 1:
        end = max(begin + 1, int(np.searchsorted(starts, starts[begin] + _AT_ONCE, "right")) - 1)
        part = data[starts[begin] : starts[end]]
        words, at = word_hashes(part, starts[begin : end + 1] - starts[begin])
        count = max(0, len(words) - size + 1)
        rolled = np.zeros(count, np.uint64)
        for i in range(size):
            rolled = mixed(rolled + words[i : i + count] + np.uint64(i))
        for a, b in zip(at[:-1], at[1:], strict=True):
            if b - a >= size:
                yield np.unique(rolled[a : b - size + 1])
            elif b > a:
                short = np.zeros(1, np.uint64)
                for i, word in enumerate(words[a:b]):
                    short = mixed(short + word + np.uint64(i))
                yield mixed(short + np.uint64(1000 + b - a))
            else:
                yield np.zeros(0, np.uint64)
        begin = end
