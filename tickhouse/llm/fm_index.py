"""A compressed FM-index over a sequence of numbers, searched many streams at a time."""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Ranks over a sequence of symbols below 2^bits: a packed bit row per level."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.n, self.bits = len(symbols), bits
        self.words: list[np.ndarray] = []
        self.before: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in range(bits - 1, -1, -1):
            row = ((symbols >> level) & 1).astype(np.uint8)
            packed = np.packbits(row, bitorder="little")
            words = np.zeros(self.n // 64 + 1, np.uint64)
            words.view(np.uint8)[:len(packed)] = packed
            counts = np.zeros(len(words) + 1, np.int64)
            np.cumsum(np.bitwise_count(words), out=counts[1:])
            self.words.append(words)
            self.before.append(counts)
            self.zeros.append(self.n - int(row.sum()))
            symbols = np.concatenate([symbols[row == 0], symbols[row == 1]])

    def descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where position ``at`` comes to lie on the way to each symbol's own run;
        the difference to position 0 is the symbol's count before ``at``."""
        for k in range(self.bits):
            word, rest = at >> 6, (at & 63).astype(np.uint64)
            below = (np.uint64(1) << rest) - np.uint64(1)
            ones = self.before[k][word] + np.bitwise_count(self.words[k][word] & below)
            bit = (symbol >> (self.bits - 1 - k)) & 1
            at = np.where(bit == 1, self.zeros[k] + ones, at - ones)
        return at


class FMIndex:
    """Windows of ``window`` words of some sequences, each with its owner's number.

    Suffixes are sorted by their first 64 words, by doubling; that settles every
    interval of up to 63, so ``window`` must be smaller. Of the sorted suffixes
    only the borders of groups with window - 1 equal words, and the least owner of
    each group with ``window``, are kept beside the wavelet matrix.
    """

    DEPTH = 64

    def __init__(self, sequences: list[np.ndarray], owners: list[int], window: int):
        if not 32 < window < self.DEPTH:
            raise ValueError("window must lie between 33 and 63")
        self.window = window
        lengths = np.array([len(s) for s in sequences], np.int64)
        flat = np.concatenate(sequences) if len(sequences) else np.empty(0, np.uint64)
        self.alphabet, symbols = np.unique(flat, return_inverse=True)
        # Every sequence ends in symbol 0, which no window contains.
        ends = np.cumsum(lengths + 1) - 1
        text = np.zeros(len(flat) + len(lengths), np.int64)
        inside = np.ones(len(text), bool)
        inside[ends] = False
        text[inside] = symbols + 1
        owner = np.repeat(np.array(owners, np.int64), lengths + 1)
        n = self.n = len(text)

        def shifted(ranks: np.ndarray, by: int) -> np.ndarray:
            out = np.zeros(n, np.int64)
            out[:max(n - by, 0)] = ranks[by:] + 1
            return out

        def pair(ranks: np.ndarray, by: int) -> np.ndarray:
            return ranks * (n + 2) + shifted(ranks, by)

        ranks, half = text, None
        for step in (1, 2, 4, 8, 16, 32):
            if step == 32:
                half = ranks
            ranks = np.unique(pair(ranks, step), return_inverse=True)[1]
        order = np.argsort(ranks, kind="stable")

        def groups(length: int) -> np.ndarray:
            """Number of the group of equal first ``length`` words, by sorted place."""
            key = pair(half, length - 32)[order]
            return np.cumsum(np.concatenate([[0], key[1:] != key[:-1]])) if n else key

        short, full = groups(window - 1), groups(window)
        starts = np.flatnonzero(np.diff(short, prepend=-1))
        self.low, self.high = starts, np.append(starts[1:], n)
        self.short = short
        self.full = full
        first = np.flatnonzero(np.diff(full, prepend=-1))
        self.least = np.minimum.reduceat(owner[order], first) if n else owner
        last_words = text[order - 1]
        bits = max(1, int(len(self.alphabet)).bit_length())
        self.matrix = WaveletMatrix(last_words, bits)
        counts = np.bincount(text, minlength=len(self.alphabet) + 1)
        every = np.arange(len(counts))
        begin = self.matrix.descend(every, np.zeros(len(counts), np.int64))
        #: Added to a descended place, the place among the sorted suffixes.
        self.shift = np.cumsum(counts) - counts - begin

    def symbols(self, words: np.ndarray) -> np.ndarray:
        """The symbol of each word, -1 for a word that the index has not."""
        if not len(self.alphabet):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.alphabet, words), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == words, at + 1, -1)

    def least_owners(self, streams: list[np.ndarray]) -> list[np.ndarray]:
        """For each start of a window in each stream, the least owner of an equal
        window in the index, or -1.

        All streams are searched from their ends at once. One that holds a full
        window drops its last word before it takes the next; one whose interval
        runs empty starts again one word before its present end.
        """
        window = self.window
        out = [np.full(max(len(s) - window + 1, 0), -1, np.int64) for s in streams]
        alive = np.array([k for k, o in enumerate(out) if len(o)], np.int64)
        if not len(alive) or not self.n:
            return out
        lengths = np.array([len(s) for s in streams], np.int64)
        offset = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        symbols = self.symbols(np.concatenate(streams))
        found = np.full(len(symbols), -1, np.int64)
        end = lengths.copy()
        matched = np.zeros(len(streams), np.int64)
        low, high = np.zeros(len(streams), np.int64), np.full(len(streams), self.n)
        while len(alive):
            shrink = alive[matched[alive] == window]
            group = self.short[low[shrink]]
            low[shrink], high[shrink] = self.low[group], self.high[group]
            end[shrink] -= 1
            matched[shrink] = window - 1
            at = end[alive] - matched[alive] - 1
            symbol = symbols[offset[alive] + at]
            known = np.maximum(symbol, 0)
            both = self.matrix.descend(
                np.concatenate([known, known]), np.concatenate([low[alive], high[alive]]))
            low[alive] = both[:len(alive)] + self.shift[known]
            high[alive] = both[len(alive):] + self.shift[known]
            matched[alive] += 1
            empty = (symbol < 0) | (low[alive] >= high[alive])
            # An unknown word can be in no window at all.
            lost = alive[empty]
            end[lost] = np.where(symbol[empty] < 0, at[empty], end[lost] - 1)
            low[lost], high[lost], matched[lost] = 0, self.n, 0
            whole = alive[matched[alive] == window]
            found[offset[whole] + end[whole] - window] = self.least[self.full[low[whole]]]
            # The next step reaches one word further, or starts anew at the end.
            more = np.where(matched[alive] == window, end[alive] > window, end[alive] >= window)
            alive = alive[more]
        return [found[a:a + len(o)] for a, o in zip(offset, out, strict=True)]
