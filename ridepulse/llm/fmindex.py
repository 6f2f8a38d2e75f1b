"""A compressed full-text index of word numbers: the Burrows-Wheeler transform in a wavelet tree.

Everything is numpy over whole arrays, so a backward search step runs for all streamed patterns at once.
"""

from __future__ import annotations

import numpy as np

from ridepulse.llm.common import ranges


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Start positions in the order of their next ``depth`` symbols (at least), by rank doubling.

    Searches of patterns of up to ``depth`` symbols need no finer order. The text ends with symbol 0.
    """
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    span = 1
    while span < depth:
        nxt = np.zeros(n, np.int64)
        nxt[:n - span] = rank[span:] + 1
        key = rank * (n + 2) + nxt
        order = np.argsort(key, kind="stable")
        step = np.empty(n, np.int64)
        step[0] = 0
        step[1:] = key[order][1:] != key[order][:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(step)
        span *= 2
        if rank[order[-1]] == n - 1:
            break
    return np.argsort(rank, kind="stable")


#: Masks of the bits below each place of a word.
_LOW_BITS = (np.uint64(1) << np.arange(64, dtype=np.uint64)) - np.uint64(1)


class BitRank:
    """Bits packed in 64-bit words with a running count per word: two bits for each bit of text."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        packed = np.packbits(bits, bitorder="little")
        self.words = np.frombuffer(np.pad(packed, (0, -len(packed) % 8 + 8)).tobytes(), "<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))
        self.zeros = n - int(self.before[-1])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Set bits before each position."""
        word = at >> 6
        mask = _LOW_BITS[at & 63]
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class FMIndex:
    """Backward search over ``text`` (symbols 1..m, 0 between and after the indexed pieces)."""

    def __init__(self, text: np.ndarray, depth: int):
        self.order = suffix_order(text, depth)
        transformed = text[self.order - 1]  # the symbol before each suffix
        self.levels = max(1, int(text.max()).bit_length())
        counts = np.bincount(text, minlength=(1 << self.levels) + 1)
        self.starts = np.concatenate(([0], np.cumsum(counts)))
        self.bits: list[BitRank] = []
        row = transformed
        for level in range(self.levels - 1, -1, -1):
            bit = (row >> level & 1).astype(bool)
            self.bits.append(BitRank(bit))
            row = np.concatenate([row[~bit], row[bit]])  # stable: zeros first
        # Where each symbol's run begins on the last level.
        begin = np.zeros(1 << self.levels, np.int64)
        for k, level in enumerate(range(self.levels - 1, -1, -1)):
            symbols = np.arange(1 << self.levels)
            one = symbols >> level & 1
            ones = self.bits[k].ones(begin)
            begin = np.where(one == 1, self.bits[k].zeros + ones, begin - ones)
        self.begin = begin

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs in the transform before each position."""
        place = at
        for k, level in enumerate(range(self.levels - 1, -1, -1)):
            ones = self.bits[k].ones(place)
            place = np.where(symbol >> level & 1 == 1, self.bits[k].zeros + ones, place - ones)
        return place - self.begin[symbol]

    def extend(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray):
        """Intervals of symbol + pattern from the intervals of the patterns."""
        base = self.starts[symbol]
        both = self.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        return base + both[:len(low)], base + both[len(low):]

    def repeats(self, text: np.ndarray, first: np.ndarray, last: np.ndarray, width: int):
        """Windows of ``width`` symbols that occur at least twice, with their intervals.

        Streams the pieces of ``text``: piece i has the window starts ``first[i]`` .. ``last[i]``; long pieces are
        streamed from several places at once. Every window is matched backwards from its last symbol. Where a suffix of k < width symbols already occurs once only, so does
        every window that holds it, and the piece goes on behind the windows that do.
        Returns (window start, interval low, interval high).
        """
        out = [], [], []
        parts = (last - first) // 16 + 1
        at = np.repeat(first, parts) + 16 * ranges(np.zeros(len(parts), np.int64), parts)
        stop = np.minimum(at + 15, np.repeat(last, parts))
        while len(at):
            low, high = np.zeros(len(at), np.int64), np.full(len(at), len(self.order), np.int64)
            live, skip = np.arange(len(at)), np.ones(len(at), np.int64)
            for k in range(1, width + 1):
                low, high = self.extend(low, high, text[at[live] + width - k])
                more = high - low > 1
                skip[live[~more]] = width - k + 1
                low, high, live = low[more], high[more], live[more]
                if not len(live):
                    break
            for have, new in zip(out, (at[live], low, high), strict=True):
                have.append(new)
            at = at + skip
            at, stop = at[at <= stop], stop[at <= stop]
        return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)
