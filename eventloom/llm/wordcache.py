"""Per-worker memory of values worked out once per distinct word."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from eventloom.llm import kernel as K

#: Distinct words remembered by a worker; beyond it the memory starts anew.
MOST_WORDS = 1 << 20


class WordCache:
    """Maps words to short integer runs; ``solve`` gives (lengths, flat values) for new words."""

    def __init__(self, solve: Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]], most_words: int = MOST_WORDS):
        self.solve, self.most_words = solve, most_words
        self.clear()

    def clear(self) -> None:
        self.key = np.zeros(0, np.uint64)
        self.first, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def look_up(self, data: np.ndarray, w: K.Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first, length) into ``flat`` for every word of a block."""
        distinct, sample, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.key) > self.most_words:
            self.clear()
        at = np.searchsorted(self.key, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.key)
        known[inside] = self.key[at[inside]] == distinct[inside]
        fresh = np.flatnonzero(~known)
        if len(fresh):
            length, flat = self.solve(data, w.start[sample[fresh]], w.end[sample[fresh]])
            first = len(self.flat) + np.cumsum(length) - length
            self.key = np.insert(self.key, at[fresh], distinct[fresh])
            self.first = np.insert(self.first, at[fresh], first)
            self.length = np.insert(self.length, at[fresh], length)
            self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
            at = np.searchsorted(self.key, distinct)
        return self.first[at][inverse], self.length[at][inverse]
