"""What a worker has learned about words: a bounded, array-based map from word hashes to runs of values."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

# Words that are kept; when there are more, those that the present chunk does not use are forgotten.
CACHE = 1_500_000


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of the elements of spans laid one after another."""
    total = np.cumsum(sizes)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(starts - (total - sizes), sizes)


class Store:
    def __init__(self, kind: str, cache: int = CACHE):
        self.cache = cache
        self.word, self.at, self.size, self.values = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, kind)

    def find(self, word: np.ndarray, learn: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Start and length, in self.values, of the runs of sorted distinct words; learn(places of unknown words) gives
        their values, one run after another, and the length of each."""
        at = np.minimum(np.searchsorted(self.word, word), max(len(self.word) - 1, 0))
        known = self.word[at] == word if len(self.word) else np.zeros(len(word), bool)
        fresh = np.flatnonzero(~known)
        if len(fresh):
            values, size = learn(fresh)
            if len(self.word) + len(fresh) > self.cache:
                keep = at[known]
                self.values = self.values[ragged(self.at[keep], self.size[keep])]
                self.word, self.size = self.word[keep], self.size[keep]
                self.at = np.cumsum(self.size, dtype=np.int64) - self.size
            into = np.searchsorted(self.word, word[fresh])
            self.at = np.insert(self.at, into, len(self.values) + np.cumsum(size) - size)
            self.size = np.insert(self.size, into, size)
            self.word = np.insert(self.word, into, word[fresh])
            self.values = np.concatenate([self.values, values])
            at = np.searchsorted(self.word, word)
        return self.at[at], self.size[at].astype(np.int64)
