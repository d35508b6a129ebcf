"""Token ids of repeated text chunks, kept once for a Python worker and gathered with numpy."""

from __future__ import annotations

from array import array
from collections.abc import Callable

import numpy as np


class ChunkTable:
    """chunk -> ids. Chunks that aren't known yet are encoded; beyond `limit` chunks the table starts anew."""

    def __init__(self, encode: Callable[[str], list[int]], limit: int = 700_000):
        self._encode, self._limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self._at: dict[str, int] = {}
        self._ids, self._starts = array("I"), array("q", [0])

    def index(self, chunks: list[str]) -> np.ndarray:
        """Places of the chunks for ids_of(), valid until the next call of fit()."""
        out, at = np.empty(len(chunks), dtype=np.int64), self._at
        for k, c in enumerate(chunks):
            i = at.get(c)
            if i is None:
                i = at[c] = len(self._starts) - 1
                self._ids.extend(self._encode(c))
                self._starts.append(len(self._ids))
            out[k] = i
        return out

    def fit(self) -> None:
        """Call between pieces of text."""
        if len(self._at) > self._limit or len(self._ids) > 8 * self._limit:
            self._clear()

    def ids_of(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the places, one after another, and the number of ids of each place."""
        starts = np.frombuffer(self._starts, dtype=np.int64)  # views: gone before the arrays grow again
        begin = starts[places]
        return gather(np.frombuffer(self._ids, dtype=np.uint32), begin, starts[places + 1] - begin)


def gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """values[starts[k] : starts[k] + sizes[k]] for all k, one after another, and the sizes."""
    ends = np.cumsum(sizes)
    where = np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
    return values[where], sizes
