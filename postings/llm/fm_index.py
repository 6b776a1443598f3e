"""A bidirectional FM-index over word ids, and the n-grams it counts."""

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np

#: The id that separates pieces; no n-gram holds it.
SEPARATOR = 0


class Intervals(NamedTuple):
    """n-grams of one length: a row of ids each, and where they stand in both indexes.

    The rows ``low .. low + size - 1`` of the index are the places that begin with the n-gram, the rows
    ``back .. back + size - 1`` of the index of the reversed text those that begin with its reverse.
    """

    words: np.ndarray
    low: np.ndarray
    back: np.ndarray
    size: np.ndarray

    def where(self, keep: np.ndarray) -> "Intervals":
        return Intervals(self.words[keep], self.low[keep], self.back[keep], self.size[keep])


class OneWay:
    """The Burrows-Wheeler transform of a text that is read in a circle, sorted by ``depth`` ids at least.

    Deeper sorting would change nothing: an interval of up to ``depth`` ids has the same bounds, and only
    bounds are ever looked up.
    """

    def __init__(self, text: np.ndarray, symbols: int, depth: int):
        rank, known = text, 1
        order = np.argsort(rank, kind="stable") if depth == 1 else None
        while known < depth:
            # Twice as many ids are compared each time: ranks of the first half, then of the second.
            pair = rank * (int(rank.max()) + 1) + np.roll(rank, -known)
            order = np.argsort(pair, kind="stable")
            known *= 2
            if known < depth:
                ordered = pair[order]
                steps = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
                rank = np.empty_like(steps)
                rank[order] = steps
        self.bwt = text[order - 1]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        self._places: np.ndarray | None = None

    def before(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How often each symbol is in the transform before a row (its rank)."""
        n = len(self.bwt)
        if self._places is None:
            self._places = np.sort(self.bwt * n + np.arange(n))
        return np.searchsorted(self._places, symbol * n + row) - self.starts[symbol]

    def extensions(self, low: np.ndarray, size: np.ndarray):
        """All intervals with one more id in front: their owner, the id, the count, the first row, and how many
        places of the owner have a smaller id there."""
        owner = np.repeat(np.arange(len(low)), size)
        first = np.cumsum(size) - size
        rows = np.repeat(low - first, size) + np.arange(len(owner))
        symbols = len(self.starts)
        found, count = np.unique(owner * symbols + self.bwt[rows], return_counts=True)
        owner, symbol = found // symbols, found % symbols
        smaller = np.cumsum(count) - count - first[owner]
        real = symbol != SEPARATOR
        owner, symbol, count, smaller = owner[real], symbol[real], count[real], smaller[real]
        return owner, symbol, count, self.starts[symbol] + self.before(symbol, low[owner]), smaller


class Index:
    """Both directions over ``text``: ids from 1 on, pieces separated by 0, which also begins and ends it."""

    def __init__(self, text: np.ndarray, symbols: int, depth: int):
        self.forward = OneWay(text, symbols, depth)
        self.backward = OneWay(text[::-1], symbols, depth) if depth > 2 else None
        self.symbols = symbols

    def single(self) -> Intervals:
        size = np.diff(self.forward.starts)
        words = np.flatnonzero(size)
        words = words[words != SEPARATOR]
        low = self.forward.starts[words]
        return Intervals(words[:, None], low, low, size[words])

    def to_left(self, grams: Intervals) -> Intervals:
        """Every n-gram with each word that stands before it; the other index keeps step."""
        owner, symbol, count, low, smaller = self.forward.extensions(grams.low, grams.size)
        words = np.concatenate([symbol[:, None], grams.words[owner]], axis=1)
        return Intervals(words, low, grams.back[owner] + smaller, count)

    def to_right(self, grams: Intervals) -> Intervals:
        """Every n-gram with each word that stands after it."""
        owner, symbol, count, back, smaller = self.backward.extensions(grams.back, grams.size)
        words = np.concatenate([grams.words[owner], symbol[:, None]], axis=1)
        return Intervals(words, grams.low[owner] + smaller, back, count)


def ngrams(
    text: np.ndarray, symbols: int, most: int, keep: Callable[[np.ndarray], np.ndarray] | None = None
) -> Iterator[Intervals]:
    """The n-grams of 1 to ``most`` words with their counts, one length after another.

    They are extended by a word to the left, then to the right, and so on. ``keep`` says of n-grams of two words
    or more which are wanted: the others are left out, with all that hold them.
    """
    index = Index(text, symbols, most)
    grams = index.single()
    yield grams
    for size in range(2, most + 1):
        grams = index.to_left(grams) if size % 2 == 0 else index.to_right(grams)
        if keep is not None:
            grams = grams.where(keep(grams.words))
        yield grams
