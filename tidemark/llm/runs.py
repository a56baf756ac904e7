"""Maximal repetitions of many sequences at once by internal pattern matching, on arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Factors:
    """Sorted suffixes of all sequences, and for each power of two the classes of equal factors of that length.

    ``ranks[k][i]`` numbers the class of the 2^k symbols from place i (equal numbers: equal factors of one sequence);
    ``blocks[k - 1]`` are the places aligned to 2^k whose class has several members, with the first place of the class among the
    sorted suffixes and its size. ``order`` are the sorted suffixes that share two symbols with another one, and
    ``before`` counts those up to each place of the whole order.
    """

    ranks: list[np.ndarray]
    blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    order: np.ndarray
    before: np.ndarray


def _classes(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorting order of the keys, and per sorted place the first place of its class and the class's size."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    sizes = np.diff(np.append(first, len(keys)))
    return order, np.repeat(first, sizes), np.repeat(sizes, sizes)


def sorted_factors(symbols: np.ndarray, starts: np.ndarray) -> Factors:
    """Prefix doubling over all sequences: only places whose class has several members are sorted again.

    Sequence s has the symbols from starts[s] to starts[s + 1]. The same symbol in two sequences is two symbols, so nothing
    matches across sequences, and a factor cut off by the end of its sequence matches nothing.
    """
    total = len(symbols)
    lengths = np.diff(starts)
    ends = np.repeat(starts[1:], lengths)
    local = np.arange(total) - np.repeat(starts[:-1], lengths)
    width = int(symbols.max(initial=0)) + 1
    order, first, sizes = _classes(np.repeat(np.arange(len(lengths)), lengths) * width + symbols)
    rank = np.empty(total, np.int32)
    rank[order] = first
    active = order[sizes > 1]
    ranks, blocks, level, twice = [rank], [], 0, np.zeros(0, np.int64)
    while len(active):
        size = 1 << level
        after = active + size
        follow = np.where(after < ends[active], rank[np.minimum(after, total - 1)].astype(np.int64) + 1, 0)
        again, first, sizes = _classes(rank[active].astype(np.int64) * (total + 1) + follow)
        active = active[again]
        # Members of an old class stay together: the new class begins as far behind the old one as it does here.
        old = rank[active]
        heads = np.flatnonzero(np.concatenate([[True], old[1:] != old[:-1]]))
        base = np.repeat(heads, np.diff(np.append(heads, len(old))))
        rank = rank.copy()
        rank[active] = old + (first - base)
        several = sizes > 1
        active, sizes = active[several], sizes[several]
        level += 1
        ranks.append(rank)
        aligned = (local[active] & ((1 << level) - 1)) == 0
        here = active[aligned]
        blocks.append((here, rank[here].astype(np.int64), sizes[aligned]))
        if level == 1:
            twice = active
    suffixes = np.empty(total, np.int64)
    suffixes[rank] = np.arange(total)
    member = np.zeros(total, bool)
    member[twice] = True
    picked = member[suffixes]
    return Factors(ranks, blocks, suffixes[picked], np.concatenate([[0], np.cumsum(picked)]))


class WaveletMatrix:
    """Numbers in bit planes, most significant first; each plane is stably parted by its bit before the next.

    Bits are packed into 64-bit words with the count of ones before each word, so a plane takes 1.5 bits a number.
    """

    def __init__(self, values: np.ndarray) -> None:
        self.size, self.planes = len(values), []
        for bit in range(max(1, int(values.max(initial=0)).bit_length()) - 1, -1, -1):
            ones = (values >> bit & 1).astype(bool)
            padded = np.zeros((len(ones) // 64 + 1) * 64, bool)
            padded[: len(ones)] = ones
            words = np.packbits(padded, bitorder="little").view("<u8")
            counts = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            zeros = len(ones) - int(counts[-1])
            self.planes.append((bit, words, counts, zeros))
            values = np.concatenate([values[~ones], values[ones]])

    @staticmethod
    def _ones(plane: tuple, place: np.ndarray) -> np.ndarray:
        _, words, counts, _ = plane
        word = place >> 6
        below = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
        return counts[word] + np.bitwise_count(words[word] & below)

    def count_below(self, low: np.ndarray, high: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many numbers at places low..high-1 are smaller than ``limit``, which must be one of the numbers' width."""
        found = np.zeros(len(low), np.int64)
        for plane in self.planes:
            ones_low, ones_high = self._ones(plane, low), self._ones(plane, high)
            zeros_low, zeros_high = low - ones_low, high - ones_high
            up = (limit >> plane[0] & 1).astype(bool)
            found += np.where(up, zeros_high - zeros_low, 0)
            low = np.where(up, plane[3] + ones_low, zeros_low)
            high = np.where(up, plane[3] + ones_high, zeros_high)
        return found

    def smallest(self, low: np.ndarray, high: np.ndarray, skipped: np.ndarray) -> np.ndarray:
        """The number at places low..high-1 that has ``skipped`` smaller ones there."""
        found = np.zeros(len(low), np.int64)
        for plane in self.planes:
            ones_low, ones_high = self._ones(plane, low), self._ones(plane, high)
            zeros_low, zeros_high = low - ones_low, high - ones_high
            there = zeros_high - zeros_low
            up = skipped >= there
            found |= up.astype(np.int64) << plane[0]
            skipped = skipped - np.where(up, there, 0)
            low = np.where(up, plane[3] + ones_low, zeros_low)
            high = np.where(up, plane[3] + ones_high, zeros_high)
        return found

    def neighbours(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next smaller and next greater number than ``value`` at places low..high-1, which hold it; -1 for none."""
        rank = self.count_below(low, high, value)
        before, after = np.full(len(low), -1, np.int64), np.full(len(low), -1, np.int64)
        has = np.flatnonzero(rank > 0)
        before[has] = self.smallest(low[has], high[has], rank[has] - 1)
        has = np.flatnonzero(rank + 1 < high - low)
        after[has] = self.smallest(low[has], high[has], rank[has] + 1)
        return before, after


def _common(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """Length of the longest common extension of places a < b: to the right (step 1) or to the left of them (step -1)."""
    total, length = len(ranks[0]), np.zeros(len(a), np.int64)
    a, b = a.copy(), b.copy()
    for level in range(len(ranks) - 1, -1, -1):
        size = 1 << level
        if step > 0:
            inside = b < total
            x, y = np.minimum(a, total - 1), np.minimum(b, total - 1)
        else:
            inside = a >= size
            x, y = np.maximum(a - size, 0), np.maximum(b - size, 0)
        moved = np.where(inside & (ranks[level][x] == ranks[level][y]), size, 0)
        length += moved
        a += step * moved
        b += step * moved
    return length


def periodic_stretches(symbols: np.ndarray, starts: np.ndarray, least: int, times: int) -> tuple[np.ndarray, ...]:
    """(sequence, start, length, period) of all maximal stretches of at least ``least`` symbols and ``times`` periods.

    ``times`` must be 4 at least. A stretch of period q holds an aligned block of 2^k symbols, q <= 2^k < 2q, in its first
    half. The block is no shorter than the period, so its nearest occurrence, to the right or (if the block lies further
    than q inside) to the left, is exactly q away. Occurrences no further away than the block is long form a progression, of
    which the range successor and predecessor in the block's class of sorted suffixes are the first members. Blocks of two
    serve both periods 1 and 2. Each candidate is extended both ways; a multiple of the period gives the same stretch, of
    which the smallest period stays.
    """
    nothing = tuple(np.zeros(0, np.int64) for _ in range(4))
    if not len(symbols):
        return nothing
    factors = sorted_factors(symbols, starts)
    if not factors.blocks or not len(factors.order):
        return nothing
    begin = np.repeat(starts[:-1], np.diff(starts))
    wavelet = WaveletMatrix(factors.order - begin[factors.order])
    places, periods = [], []
    for level, (at, first, sizes) in enumerate(factors.blocks, start=1):
        if not len(at):
            continue
        low = factors.before[first]
        local = at - begin[at]
        for other in wavelet.neighbours(low, low + sizes, local):
            away = np.abs(other - local)
            fits = (other >= 0) & (away <= 1 << level) & ((away > 1 << (level - 1)) | (level == 1))
            places.append(at[fits])
            periods.append(away[fits])
    at, period = np.concatenate(places), np.concatenate(periods)
    # The nearest occurrence to the left gives the same pair of places one period earlier.
    seen = np.unique(np.stack([at, period], axis=1), axis=0)
    at, period = seen[:, 0], seen[:, 1]
    left, right = _both_ways(factors.ranks, begin, at, period)
    start, end = at - left, at + right
    long = end - start >= np.maximum(least, times * period)
    found = np.stack([start[long], end[long], period[long]], axis=1)
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    start, end, period = found[new].T
    sequence = np.searchsorted(starts, start, "right") - 1
    order = np.lexsort((period, start))
    return sequence[order], (start - begin[start])[order], (end - start)[order], period[order]


def _both_ways(ranks: list[np.ndarray], begin: np.ndarray, at: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far the period holds to the left of each place, and to the right of it (the period itself included).

    A place whose partner one period on lies outside its sequence is moved one period back first.
    """
    total = len(begin)
    ahead = at + period
    outside = (ahead >= total) | (begin[np.minimum(ahead, total - 1)] != begin[at])
    back = np.where(outside, period, 0)
    here = at - back
    left = _common(ranks, here, here + period, -1) + back
    right = _common(ranks, here, here + period, 1) + period - back
    return left, right
