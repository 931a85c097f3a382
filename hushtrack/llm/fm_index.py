"""A searchable index of word sequences: backward search through wavelet-tree ranks.

Numpy code for one shard of bounded size. A shard is a list of sequences of words, each ended by a
separator that is unlike all others. Its suffixes are sorted by doubling, the words before them make
the Burrows-Wheeler transform, and a wavelet matrix answers ranks on it. Positions in the text are kept
for every ``SAMPLE``-th word only; others are found by stepping back to the nearest kept one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Words and separators in a shard, at most: three numbers below this fit in one sort key of 64 bits.
MOST = 1 << 20
#: Distance of the words whose positions are kept.
SAMPLE = 16
_BITS = np.uint64(20)
_LOW = np.uint64(MOST - 1)


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order. No symbol past the first suffix that ends must be shared: the last
    symbol of every sequence is its own."""
    n = len(symbols)
    at = np.arange(n, dtype=np.uint64)
    rank = np.zeros(n, np.uint64)

    def settle(keys: np.ndarray) -> np.ndarray:
        """Rank rows by their sorted keys (rank so far, next rank, start); returns the starts still tied."""
        keys.sort()
        start, pair, head = keys & _LOW, keys >> _BITS, keys >> (_BITS + _BITS)
        here = np.arange(len(keys), dtype=np.uint64)
        new_pair = np.r_[True, pair[1:] != pair[:-1]]
        new_head = np.r_[True, head[1:] != head[:-1]]
        first_pair = np.maximum.accumulate(np.where(new_pair, here, 0))
        first_head = np.maximum.accumulate(np.where(new_head, here, 0))
        rank[start] = head + (first_pair - first_head)
        tied = ~(new_pair & np.r_[new_pair[1:], True])
        return start[tied]

    left = settle((symbols.astype(np.uint64) << _BITS) | at)
    step = 1
    while len(left):
        # A tied suffix shares its first ``step`` words with another one, so none of them is a separator.
        left = settle((rank[left] << (_BITS + _BITS)) | (rank[left + np.uint64(step)] << _BITS) | left)
        step *= 2
    order = np.empty(n, np.int64)
    order[rank.astype(np.int64)] = np.arange(n)
    return order


@dataclass
class Bits:
    """Bits with counts of ones before any place."""

    words: np.ndarray
    before: np.ndarray

    @staticmethod
    def of(bits: np.ndarray) -> Bits:
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, np.uint64)
        words.view(np.uint8)[: len(packed)] = packed
        counts = np.bitwise_count(words).astype(np.int64)
        return Bits(words, (np.cumsum(counts) - counts).astype(np.int32))

    def rank(self, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


@dataclass
class FMIndex:
    """Index of sequences whose words are numbers from 1 to ``size``; 0 is a separator."""

    size: int
    #: Rows whose suffix starts with a smaller symbol, and the same less the symbol's place in the last level.
    first: np.ndarray
    shift: np.ndarray
    levels: list[tuple[Bits, int]]
    marked: Bits
    kept: np.ndarray
    rows: int

    @staticmethod
    def of(words: np.ndarray, offsets: np.ndarray, separators: np.ndarray, size: int, sample: int = SAMPLE) -> FMIndex:
        """``words`` with a 0 at each of ``separators``; ``offsets`` counts words from each sequence's start."""
        n = len(words)
        symbols = words.astype(np.int64) + (len(separators) - 1)
        symbols[separators] = np.arange(len(separators))
        order = suffix_order(symbols)
        before = words[order - 1].astype(np.int64)  # the word before the first one is the last separator
        counts = np.bincount(words, minlength=size + 1)
        first = np.cumsum(counts) - counts
        depth = max(1, int(size).bit_length())
        levels, left = [], before
        for bit in range(depth - 1, -1, -1):
            ones = (left >> bit) & 1 == 1
            levels.append((Bits.of(ones), int(n - np.count_nonzero(ones))))
            left = np.concatenate([left[~ones], left[ones]])
        symbol = np.arange(size + 1)
        backwards = sum(((symbol >> k) & 1) << (depth - 1 - k) for k in range(depth))
        placed = np.argsort(backwards, kind="stable")
        base = np.empty(size + 1, np.int64)
        base[placed] = np.cumsum(counts[placed]) - counts[placed]
        keep = (offsets[order] % sample == 0) & (words[order] > 0)
        return FMIndex(size, first, first - base, levels, Bits.of(keep), order[keep].astype(np.int32), n)

    def parts(self) -> tuple:
        """What the index consists of, without classes; see :meth:`whole`."""
        levels = [(b.words, b.before, zeros) for b, zeros in self.levels]
        return self.size, self.first, self.shift, levels, (self.marked.words, self.marked.before), self.kept, self.rows

    @staticmethod
    def whole(parts: tuple) -> FMIndex:
        size, first, shift, levels, marked, kept, rows = parts
        return FMIndex(size, first, shift, [(Bits(w, b), zeros) for w, b, zeros in levels], Bits(*marked), kept, rows)

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Row of the suffix that begins with the symbol and goes on as those before ``at``."""
        for k, (bits, zeros) in enumerate(self.levels):
            ones = bits.rank(at)
            at = np.where((symbols >> (len(self.levels) - 1 - k)) & 1 == 1, zeros + ones, at - ones)
        return at + self.shift[symbols]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last (exclusive) row of the suffixes that begin with each pattern.

        Patterns are rows of symbols, short ones filled up with 0 on the left.
        """
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.rows)
        for symbols in patterns.T[::-1]:
            live = np.flatnonzero((symbols > 0) & (low < high))
            if len(live):
                both = self._down(np.tile(symbols[live], 2), np.concatenate([low[live], high[live]]))
                low[live], high[live] = both[: len(live)], both[len(live) :]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the text of the suffixes in these rows, which must begin with words."""
        found = np.empty(len(rows), np.int64)
        who, at, steps = np.arange(len(rows)), rows.astype(np.int64), 0
        while len(who):
            kept = self.marked.get(at)
            found[who[kept]] = self.kept[self.marked.rank(at[kept])] + steps
            who, at = who[~kept], at[~kept]
            here, symbols = at, np.zeros(len(at), np.int64)
            for bits, zeros in self.levels:
                one, ones = bits.get(here), bits.rank(here)
                symbols = symbols * 2 + one
                here = np.where(one, zeros + ones, here - ones)
            at = here + self.shift[symbols]
            steps += 1
        return found
