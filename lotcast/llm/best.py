"""The best few entries of many owners, kept within bounds in one task."""

from __future__ import annotations

import numpy as np


class Best:
    """The ``k`` entries with the highest scores of each of ``owners``
    owners; equal scores go by the smaller ties. ``least[owner]`` is the score
    an entry must reach to be looked at: given at first, then the k-th score.
    """

    def __init__(self, owners: int, k: int, least: np.ndarray, ties: int = 1, score_type=np.int64) -> None:
        self.k, self.least, self.room = k, least, max(4 * k * owners, 1 << 16)
        self.held = [(np.zeros(0, np.int64), np.zeros(0, score_type), *[np.zeros(0, np.int64)] * ties)]
        self.count = 0

    def add(self, owner: np.ndarray, score: np.ndarray, *ties: np.ndarray) -> None:
        """Entries of which each reaches its owner's ``least``."""
        if not len(owner):
            return
        self.held.append((owner, score, *ties))
        self.count += len(owner)
        if self.count > self.room:
            self.cut()

    def cut(self) -> tuple[np.ndarray, ...]:
        """Drop what is not among the best; owner, score and ties of the rest,
        best first within an owner."""
        owner, score, *ties = (np.concatenate(x) for x in zip(*self.held))
        order = np.lexsort((*ties[::-1], -score, owner))
        place = np.arange(len(order)) - np.searchsorted(owner[order], owner[order])
        order, place = order[place < self.k], place[place < self.k]
        self.held = [tuple(x[order] for x in (owner, score, *ties))]
        self.count = len(order)
        full = order[place == self.k - 1]
        self.least[owner[full]] = score[full]  # an equal score may still win by its ties
        return self.held[0]
