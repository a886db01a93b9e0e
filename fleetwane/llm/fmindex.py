"""A compressed full-text index of sequences of numbers: the Burrows-Wheeler transform in a wavelet matrix.

Many patterns are searched backward at once; every step is a few NumPy operations over all
searches. Suffixes are sorted by their first ``DEPTH`` symbols only, which is enough for
patterns up to that length.
"""

from __future__ import annotations

import numpy as np

DEPTH = 64

_U = np.uint64


class _Bits:
    """A bit vector with constant-time rank."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(_U)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def ones(self, upto: np.ndarray) -> np.ndarray:
        block = upto >> 6
        mask = (_U(1) << (upto & 63).astype(_U)) - _U(1)
        return self.before[block] + np.bitwise_count(self.words[block] & mask)


class Wavelet:
    """A wavelet matrix: rank of any symbol in a sequence, one bit vector per bit of the symbols."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        current = symbols
        for bit in range(bits - 1, -1, -1):
            ones = (current >> bit) & 1
            zeros = int(len(ones) - ones.sum())
            self.levels.append((bit, _Bits(ones), zeros))
            current = np.concatenate((current[ones == 0], current[ones == 1]))

    def rank(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often ``symbol`` occurs before ``low`` and before ``high``, up to a common offset per symbol."""
        for bit, bits, zeros in self.levels:
            one = ((symbol >> bit) & 1).astype(bool)
            low_ones, high_ones = bits.ones(low), bits.ones(high)
            low = np.where(one, zeros + low_ones, low - low_ones)
            high = np.where(one, zeros + high_ones, high - high_ones)
        return low, high


class Index:
    """The index of a text whose symbols are 0 (a separator) and 1 to ``size``."""

    def __init__(self, text: np.ndarray):
        n = len(text)
        order = _sorted_suffixes(text)
        self.n = n
        transform = text[order - 1]
        bits = max(1, int(text.max()).bit_length()) if n else 1
        self.wavelet = Wavelet(transform, bits)
        counts = np.bincount(text, minlength=1)
        self.start = np.concatenate(([0], np.cumsum(counts)))[:-1]
        # where a symbol's occurrences begin in the last level of the matrix
        every = np.arange(len(counts))
        self.offset, _ = self.wavelet.rank(every, np.zeros(len(counts), np.int64), np.zeros(len(counts), np.int64))
        self.counts = counts

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals after ``symbol`` is put in front of the patterns with intervals [low, high)."""
        a, b = self.wavelet.rank(symbol, low, high)
        shift = self.start[symbol] - self.offset[symbol]
        return a + shift, b + shift


def _sorted_suffixes(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes, sorted by their first DEPTH symbols (those cut off count as separators)."""
    n, rank, length = len(text), text.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while length < DEPTH:
        behind = np.concatenate((rank[length:], np.zeros(min(length, n), np.int64)))[:n]
        key = rank * (int(rank.max(initial=0)) + int(behind.max(initial=0)) + 2) + behind
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        length *= 2
    return order


def repeated_windows(index: Index, text: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Whether the window of ``size`` symbols at each place of the text occurs twice or more in the indexed text.

    Only windows within [start, end) of the asked sequences are looked at. Each sequence is
    matched from its end to its front while the match occurs twice; when it no longer does,
    the match loses its last symbol and starts again. A symbol that occurs once is jumped over.
    """
    out = np.zeros(len(text), bool)
    end, left = ends.copy(), ends.copy()
    low, high = np.zeros(len(starts), np.int64), np.full(len(starts), index.n)
    active = np.flatnonzero(ends - starts >= size)
    while len(active):
        at = left[active] - 1
        symbol = text[at]
        a, b = index.extend(symbol, low[active], high[active])
        good = b - a >= 2
        ok = active[good]
        low[ok], high[ok], left[ok] = a[good], b[good], at[good]
        long = ok[end[ok] - left[ok] >= size]
        out[left[long]] = True
        full = long[end[long] - left[long] >= DEPTH]
        end[full] = left[full] + size - 1  # the next window to decide ends here
        bad, bad_at = active[~good], at[~good]
        single = index.counts[text[bad_at]] < 2
        end[bad] = np.where(single, bad_at, end[bad] - 1)
        again = np.concatenate((full, bad))
        left[again], low[again], high[again] = end[again], 0, index.n
        # a sequence is done when no window is left before its end
        done = (left[active] <= starts[active]) | (end[active] - starts[active] < size)
        active = active[~done]
    return out
