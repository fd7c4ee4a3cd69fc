"""A token trie of phrases, walked from all places of a batch of texts at once (M1)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np


class PhraseTrie:
    """Phrases of numbered words with a value each.

    The trie is two sorted arrays: edges (state and word packed in one number) and the states they lead to. One step from
    all places is one binary search in them, so a batch is walked in as many steps as the longest phrase has words.
    """

    def __init__(self, phrases: Mapping[Sequence[int], float]):
        edges: dict[tuple[int, int], int] = {}
        values: dict[int, float] = {}
        self.longest = 0
        for words, value in phrases.items():
            state = 0
            for word in words:
                state = edges.setdefault((state, word), len(edges) + 1)
            values[state] = value
            self.longest = max(self.longest, len(words))
        order = sorted(edges)
        self._codes = np.array([state << 32 | word for state, word in order], np.int64)
        self._next = np.array([edges[e] for e in order], np.int64)
        self._values = np.full(len(edges) + 1, np.nan)
        for state, value in values.items():
            self._values[state] = value

    def _step(self, states: np.ndarray, words: np.ndarray) -> np.ndarray:
        codes = states << 32 | words
        at = np.minimum(np.searchsorted(self._codes, codes), len(self._codes) - 1)
        return np.where(self._codes[at] == codes, self._next[at], -1)

    def found(self, words: np.ndarray, room: np.ndarray) -> list[np.ndarray]:
        """For each length from 0: the value of the phrase of so many words that begins at each place, else NaN.

        `words` are the numbers of all words one after another, `room` how many words its text has from each place on.
        """
        out = [np.full(len(words), np.nan) for _ in range(self.longest + 1)]
        places = np.arange(len(words))
        states = np.zeros(len(words), np.int64)
        for length in range(1, self.longest + 1):
            inside = room[places] >= length
            places, states = places[inside], states[inside]
            states = self._step(states, words[places + length - 1])
            places, states = places[states >= 0], states[states >= 0]
            out[length][places] = self._values[states]
        return out
