"""A bidirectional FM-index over integer symbols, for one shard's worth of text, in numpy.

The text is cut by a delimiter, symbol 0, and begins and ends with one. Its index has the BWT
of the text (it extends matches to the left) and of the reversed text (to the right). All
steps take arrays of intervals at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np

DELIMITER = 0
#: Occurrences of phrases that are extended at once.
SYMBOLS = 1 << 18
#: Suffixes that ``shallow_order`` sorts at once, unless more begin with one symbol.
PART = 1 << 18


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes in the order of their first ``depth`` symbols (at least).

    As many symbols as fit make up the first key; after that the span of the keys doubles.
    """
    n, bits = len(text), max(1, int(text.max(initial=0)).bit_length())
    ends = np.concatenate([text, np.zeros(62 // bits, text.dtype)])
    key, span = np.zeros(n, np.int64), 0
    while span < min(depth, 62 // bits):
        key = (key << bits) | ends[span : span + n]
        span += 1
    del ends
    order = np.argsort(key)
    while span < depth:
        number = key[order]
        changed = number[1:] != number[:-1]
        number[:1] = 0
        np.cumsum(changed, out=number[1:])
        if n == 0 or number[-1] == n - 1:
            break
        number *= n + 1
        key[order] = number
        del order, changed, number
        key[: n - span] += key[span:] // (n + 1) + 1
        order = np.argsort(key)
        span *= 2
    return order


def shallow_order(text: np.ndarray, depth: int) -> np.ndarray:
    """As ``suffix_order``, for few symbols: in parts by first symbol, so that little is held beside the order.

    As many symbols as fit make up a part's first key; after that ranks and further symbols do.
    """
    bits = max(1, int(text.max(initial=0)).bit_length())
    ends = np.concatenate([text, np.zeros(depth, text.dtype)])
    upto = np.cumsum(np.bincount(text))
    cuts = np.unique(np.searchsorted(upto, np.arange(PART, len(text), PART), side="right"))
    order, at = np.empty(len(text), np.int32 if len(text) < 1 << 31 else np.int64), 0
    for low, high in zip([0, *cuts], [*cuts, len(upto)]):
        starts = np.flatnonzero((text >= low) & (text < high))
        key, span, rank_bits = np.zeros(len(starts), np.int64), 0, 0
        while span < depth and len(starts):
            for _ in range(min(depth - span, (62 - rank_bits) // bits)):
                key <<= bits
                key |= ends[starts + span]
                span += 1
            by = np.argsort(key)
            starts, key = starts[by], key[by]
            changed = key[1:] != key[:-1]
            key[0] = 0
            np.cumsum(changed, out=key[1:])
            rank_bits = int(key[-1]).bit_length()
        order[at : at + len(starts)] = starts
        at += len(starts)
    return order


def bwt_of(
    text: np.ndarray, depth: int, ordered: Callable[[np.ndarray, int], np.ndarray] = suffix_order
) -> tuple[np.ndarray, np.ndarray]:
    """The symbol before each suffix, in suffix order, and that order."""
    order = ordered(text, depth)
    return text[order - 1], order


class Bwt:
    """Backward search by one BWT. Intervals [lo, hi) are of suffix ranks."""

    def __init__(self, bwt: np.ndarray):
        self.bwt, self.n = bwt, len(bwt)
        #: Ascending, one per rank: the suffix's first symbol and the place of that symbol in the BWT.
        self.keys = bwt.astype(np.int64)
        self.keys *= self.n + 1
        self.keys += np.arange(self.n, dtype=np.int32 if self.n < 1 << 31 else np.int64)
        self.keys.sort()

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Suffixes that are below each symbol, or begin with it and continue below rank ``at``."""
        return np.searchsorted(self.keys, symbols * (self.n + 1) + at)

    def step(self, lo: np.ndarray, hi: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each interval extended by one symbol of its own; lo == hi where there is none."""
        return self.rank(symbols, lo), self.rank(symbols, hi)

    def children(self, lo: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(interval number, symbol, count), ordered, for each different symbol in each interval.

        The intervals together may not be much larger than the text; give equal ones once.
        """
        at = np.repeat(lo - np.cumsum(size) + size, size) + np.arange(size.sum())
        width = int(self.keys[-1] // (self.n + 1)) + 1 if self.n else 1
        pairs, counts = np.unique(np.repeat(np.arange(len(lo)), size) * width + self.bwt[at], return_counts=True)
        return pairs // width, pairs % width, counts


@dataclass
class Phrases:
    """Matches as intervals of both BWTs: equally many suffixes, first ranks ``left`` and ``right``.

    ``symbols`` has one row per phrase, in reading order.
    """

    left: np.ndarray
    right: np.ndarray
    size: np.ndarray
    symbols: np.ndarray

    def where(self, chosen: np.ndarray | slice) -> "Phrases":
        return Phrases(self.left[chosen], self.right[chosen], self.size[chosen], self.symbols[chosen])

    def blocks(self) -> Iterator["Phrases"]:
        """All of them, some at a time, with about SYMBOLS occurrences or a single phrase."""
        upto = np.cumsum(self.size)
        cuts = np.searchsorted(upto, np.arange(SYMBOLS, int(upto[-1]) if len(upto) else 0, SYMBOLS))
        for start, end in zip([0, *cuts], [*cuts, len(upto)]):
            yield self.where(slice(start, end))


class Bidirectional:
    def __init__(self, left: np.ndarray, right: np.ndarray | None = None):
        """``left``: BWT of the text, ``right``: of the reversed text, which only extending to the right needs."""
        self.left, self.right = Bwt(left), None if right is None else Bwt(right)

    def words(self) -> Phrases:
        """Every symbol but the delimiter."""
        symbols, size = np.unique(self.left.bwt, return_counts=True)
        lo = np.cumsum(size) - size
        some = symbols != DELIMITER
        return Phrases(lo[some], lo[some], size[some], symbols[some][:, None])

    def extended(self, phrases: Phrases, to_the_left: bool) -> Phrases:
        """All phrases one symbol longer on that side, with both intervals; none crosses a delimiter."""
        own, other = (self.left, phrases.right) if to_the_left else (self.right, phrases.left)
        at = phrases.left if to_the_left else phrases.right
        parent, symbol, count = own.children(at, phrases.size)
        upto = np.cumsum(count) - count
        first = np.searchsorted(parent, parent)  # the parent's first child
        moved = other[parent] + upto - upto[first]  # children follow in the order of their symbols
        stepped = own.rank(symbol, at[parent])
        kept, new = phrases.symbols[parent], symbol[:, None]
        longer = Phrases(
            stepped if to_the_left else moved,
            moved if to_the_left else stepped,
            count,
            np.hstack([new, kept] if to_the_left else [kept, new]),
        )
        return longer.where(symbol != DELIMITER)
