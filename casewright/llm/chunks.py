"""Ids of texts by way of their distinct blank-separated chunks.

Most chunks of a corpus repeat, so each is tokenized once per worker and then
copied from a pool by numpy. The pool is emptied when it grows past its bound.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np

MAX_CHUNKS = 250_000


class Numbers(dict):
    """Number of each chunk; a new chunk gets the next one and is noted."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self[chunk] = number = len(self)
        self.new.append(chunk)
        return number


class Pool:
    """Ids of chunks; ``encode`` maps a list of chunks to their ids end to end and the number of ids of each."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = MAX_CHUNKS):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.at = Numbers()
        self.ids, self.first, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def look_up(self, groups: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all groups end to end, and the number of ids of each group."""
        if len(self.at) > self.limit:
            self.clear()
        flat = list(chain.from_iterable(groups))
        index = np.fromiter(map(self.at.__getitem__, flat), dtype=np.int64, count=len(flat))
        if self.at.new:
            ids, size = self.encode(self.at.new)
            self.first = np.concatenate([self.first, len(self.ids) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
            self.at.new = []
        size = self.size[index]
        total = np.concatenate([[0], np.cumsum(size)])
        source = np.repeat(self.first[index] - total[:-1], size) + np.arange(total[-1])
        bounds = total[np.concatenate([[0], np.cumsum([len(g) for g in groups])]).astype(np.int64)]
        return self.ids[source], np.diff(bounds)
