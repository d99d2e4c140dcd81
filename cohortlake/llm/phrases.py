"""Content-defined phrases: the shared index of the two exact substring operators.

Take every window of W symbols (50 bytes, 13 words).  Its *anchor* is the
k-gram inside it with the smallest hash, the leftmost of equals, so equal
windows have equal anchors at equal places.  Consecutive windows with one
anchor make a *phrase*: the symbols from the first window's start to the last
one's end.  Each window belongs to exactly one phrase, neighbours overlap by
W - 1 symbols, and two equal windows in different documents lie in phrases
with the same anchor hash.
"""

from __future__ import annotations

import numpy as np

from cohortlake.llm import arrays as A


class Phrases:
    """Phrases of consecutive documents: ``doc`` (index), first and last
    window start, anchor place, anchor hash and phrase key (hash of content and
    of where the anchor stands in it)."""

    def __init__(self, values: np.ndarray, offsets: np.ndarray, window: int, k: int):
        self.window, self.sums = window, A.prefix_sums(values)
        n, width = len(values) - window + 1, window - k + 1
        empty = np.zeros(0, np.int64)
        self.doc = self.first = self.last = self.place = empty
        self.anchor = self.key = np.zeros(0, np.uint64)
        if n <= 0:
            return
        grams = A.gram_hash(values, k)
        low = A.window_min(grams & ~np.uint64(63), width) & np.uint64(63)
        lengths = np.diff(offsets)
        start = A.ranges(offsets[:-1], np.maximum(lengths - window + 1, 0))
        if not len(start):
            return
        place = start + low[start].astype(np.int64)
        new = np.empty(len(start), bool)
        new[0] = True
        new[1:] = (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)
        at = np.flatnonzero(new)
        self.first, self.place = start[at], place[at]
        self.last = start[np.append(at[1:], len(start)) - 1]
        self.doc = np.searchsorted(offsets, self.first, "right") - 1
        self.anchor = grams[self.place]
        content = A.span_hash(self.sums, self.first, self.last + window)
        self.key = A.mix(content + (self.place - self.first).astype(np.uint64) * A.BASE + self.anchor)

    def windows(self, which: np.ndarray):
        """Of the chosen phrases: the number of the phrase, start and hash of each window."""
        counts = self.last[which] - self.first[which] + 1
        start = A.ranges(self.first[which], counts)
        return np.repeat(which, counts), start, A.span_hash(self.sums, start, start + self.window)
