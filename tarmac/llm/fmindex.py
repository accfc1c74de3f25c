"""A compressed FM-index over words: the Burrows-Wheeler transform in a wavelet matrix.

The matrix keeps one bit per word and level, packed, with a count per 64 bits. All
searches of a batch go on together, one word further back in each step.
"""

from __future__ import annotations

import numpy as np

#: Suffixes are sorted by so many words, which is enough for searches that are shorter.
DEPTH = 64


def _suffixes(text: np.ndarray) -> np.ndarray:
    """Positions of the suffixes in the order of their first ``DEPTH`` words."""
    rank, step = text.astype(np.int64), 1
    while True:
        after = np.zeros(len(rank), np.int64)
        after[: max(0, len(rank) - step)] = rank[step:] + 1
        key = rank * (len(rank) + max(int(rank.max()), 1) + 2) + after
        if step * 2 >= DEPTH:
            return np.argsort(key, kind="stable")
        rank = np.unique(key, return_inverse=True)[1]
        step *= 2


class FMIndex:
    """Counts occurrences of words sequences in a text of numbers from 0 on."""

    def __init__(self, text: np.ndarray):
        sigma = int(text.max()) + 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))]).astype(np.int64)
        order = _suffixes(text)
        column = text[order - 1]  # the first suffix is preceded by the last word, a separator
        self.levels = max(1, (sigma - 1).bit_length())
        self.bits, self.counts, self.zeros = [], [], []
        for level in reversed(range(self.levels)):
            bit = (column >> level) & 1 == 1
            padded = np.zeros((len(bit) // 64 + 1) * 64, np.uint8)
            padded[: len(bit)] = bit
            self.bits.append(np.packbits(padded, bitorder="little").view(np.uint64))
            counts = np.concatenate([[0], np.cumsum(np.bitwise_count(self.bits[-1]), dtype=np.int64)])
            self.counts.append(counts.astype(np.uint32))
            self.zeros.append(len(bit) - int(bit.sum()))
            column = np.concatenate([column[~bit], column[bit]])
        self.base = self._descend(np.arange(sigma), np.zeros(sigma, np.int64))

    def _descend(self, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where a position comes to lie on the way down to the places of a word."""
        for k, level in enumerate(reversed(range(self.levels))):
            block = at >> 6
            below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.counts[k][block] + np.bitwise_count(self.bits[k][block] & below)
            at = np.where((word >> level) & 1 == 1, self.zeros[k] + ones, at - ones)
        return at

    def matching_statistics(self, text: np.ndarray, ends: np.ndarray, most: int, least: int = 2) -> np.ndarray:
        """For each end in a text, how long a sequence up to there occurs ``least`` times or more, up to ``most`` words."""
        length = np.zeros(len(ends), np.int64)
        live = np.arange(len(ends))
        lo = hi = None
        for step in range(most):
            word = text[ends[live] - step]
            if lo is None:
                lo, hi = self.first[word], self.first[word + 1]
            else:
                both = self._descend(np.concatenate([word, word]), np.concatenate([lo, hi]))
                start = self.first[word] - self.base[word]
                lo, hi = start + both[: len(word)], start + both[len(word) :]
            on = hi - lo >= least
            live, lo, hi = live[on], lo[on], hi[on]
            if not len(live):
                break
            length[live] = step + 1
        return length
