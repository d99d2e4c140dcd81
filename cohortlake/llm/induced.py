"""External induced sorting of the suffixes of one shard, with common prefixes.

A shard is a set of byte strings.  Suffixes are typed L or S by their first
descent or ascent.  Leftmost-S suffixes are sorted first: induction sorts the
substrings between them, equal ones get one name, and the string of names is
sorted in turn, each level joining pairs of names.  Two scans then induce the
L and the S suffixes.  A scan reads suffix tuples (place, common prefix with the
tuple before) from a priority queue in symbol order and puts each suffix's
left neighbour back under its own first symbol; the common prefix of two
neighbours in a queue is one more than the least value between their sources.

The queues keep tuples on disk once they exceed ``MEMORY``, and the text is
mapped from disk, so a shard may be larger than memory.  Prefixes are followed
to ``limit`` symbols only, the window that the caller asks for.
"""

from __future__ import annotations

import tempfile

import numpy as np

from cohortlake.llm import arrays as A

#: Bytes of queued tuples kept in memory, and tuples that a scan handles at once.
MEMORY, STEP = 64 << 20, 1 << 17
LAST, BREAK, SHIFT = 0, 1, 2
SYMBOLS = 256 + SHIFT


class Queue:
    """Tuples by symbol, first in first out; on disk beyond MEMORY."""

    def __init__(self):
        self.rows = [[] for _ in range(SYMBOLS)]
        self.size, self.file = 0, None

    def put(self, symbol: int, place: np.ndarray, lcp: np.ndarray) -> None:
        self.rows[symbol].append((place, lcp))
        self.size += place.nbytes + lcp.nbytes
        if self.size > MEMORY:
            self.spill()

    def spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for rows in self.rows:
            for i, row in enumerate(rows):
                if not isinstance(row[0], int):
                    at = self.file.tell()
                    self.file.write(row[0].tobytes())
                    self.file.write(row[1].tobytes())
                    rows[i] = (at, len(row[0]))
        self.size = 0

    def take(self, symbol: int):
        """What the symbol's queue holds now, oldest first, about STEP tuples at once."""
        rows, self.rows[symbol] = self.rows[symbol], []
        some, count = [], 0
        for a, b in rows:
            if isinstance(a, int):
                self.file.seek(a)
                a, b = np.frombuffer(self.file.read(4 * b), np.int32), np.frombuffer(self.file.read(b), np.uint8)
            else:
                self.size -= a.nbytes + b.nbytes
            some.append((a, b))
            count += len(a)
            if count >= STEP:
                yield tuple(map(np.concatenate, zip(*some)))
                some, count = [], 0
        if some:
            yield tuple(map(np.concatenate, zip(*some)))


def least_between(values: np.ndarray, after: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Minimum of values[after + 1 .. to] for each pair of places."""
    length = to - after
    level = np.frexp(length.astype(np.float64))[1] - 1
    out = np.empty(len(to), np.uint8)
    row, width = values, 1
    for k in range(int(level.max()) + 1 if len(level) else 0):
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(row[after[at] + 1], row[to[at] - width + 1])
        row = np.minimum(row[:-width], row[width:]) if len(row) > width else row
        width *= 2
    return out


class Scan:
    """One inducing scan: what it has read reaches the queues of left neighbours
    of the wanted type."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, limit: int):
        self.text, self.wanted, self.limit, self.queue = text, wanted, limit, Queue()
        self.begun = np.zeros(SYMBOLS, bool)
        self.since = np.full(SYMBOLS, 255, np.uint8)

    def read(self, place: np.ndarray, lcp: np.ndarray) -> None:
        for i in range(0, len(place), STEP):
            self._read(place[i:i + STEP], lcp[i:i + STEP])

    def _read(self, place, lcp):
        left = place - 1
        at = np.flatnonzero((place > 0) & self.wanted[left])
        symbol = self.text[left[at]]
        order = np.argsort(symbol, kind="stable")
        at, symbol = at[order], symbol[order]
        lowest = int(lcp.min())
        new = np.flatnonzero(np.append(True, symbol[1:] != symbol[:-1])) if len(at) else at
        value = np.empty(len(at), np.uint8)
        inner = np.ones(len(at), bool)
        inner[new] = False
        inner = np.flatnonzero(inner)
        value[inner] = least_between(lcp, at[inner - 1], at[inner])
        heads = symbol[new]
        value[new] = np.minimum(self.since[heads], np.minimum.accumulate(lcp)[at[new]])
        value = np.where(value < self.limit, value + 1, self.limit).astype(np.uint8)
        value[new[~self.begun[heads]]] = 0
        self.since = np.minimum(self.since, lowest).astype(np.uint8)
        if len(at):
            ends = np.append(new[1:], len(at))
            rest = np.append(np.minimum.accumulate(lcp[::-1])[::-1], np.uint8(255))
            self.since[heads] = rest[at[ends - 1] + 1]
            self.begun[heads] = True
            gone = left[at].astype(np.int32)
            for s, i, j in zip(heads.tolist(), new.tolist(), ends.tolist()):
                self.queue.put(s, gone[i:j], value[i:j])


def common(text: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Common prefixes, at most ``limit``, of the suffixes at a and b (the text
    is padded by ``limit``)."""
    out = np.zeros(len(a), np.uint8)
    at = np.arange(len(a))
    for j in range(limit):
        at = at[text[a[at] + j] == text[b[at] + j]]
        if not len(at):
            break
        out[at] += 1
    return out


def induce(text: np.ndarray, small: np.ndarray, seeds: np.ndarray, lcp: np.ndarray, limit: int):
    """Places of all suffixes but the last in order, and each one's common prefix
    with the one before, from sorted leftmost-S suffixes (of one symbol together)."""
    up = Scan(text, ~small, limit)
    bounds = np.searchsorted(text[seeds], np.arange(SYMBOLS + 1))
    large = [[] for _ in range(SYMBOLS)]
    border = lambda a, b: int(common(text, np.array([a]), np.array([b]), limit)[0])
    for c in range(SYMBOLS):
        last = None
        while up.queue.rows[c]:
            for place, value in up.queue.take(c):
                large[c].append((place, value))
                up.read(place, value)
                last = place[-1]
        i, j = bounds[c], bounds[c + 1]
        if i < j:
            value = lcp[i:j].copy()
            value[0] = 0 if last is None else border(last, seeds[i])
            up.read(seeds[i:j], value)
    down, out, values = Scan(text, small, limit), [], []
    for c in range(SYMBOLS - 1, -1, -1):
        some, last = [], None
        while down.queue.rows[c]:
            for place, value in down.queue.take(c):
                some.append((place, value))
                down.read(place, value)
                last = place[-1]
        bucket = [np.concatenate([x[k] for x in large[c]]) if large[c] else np.zeros(0, t)
                  for k, t in ((0, np.int32), (1, np.uint8))]
        s = [np.concatenate([x[k] for x in some])[::-1] if some else np.zeros(0, t)
             for k, t in ((0, np.int32), (1, np.uint8))]
        edge = border(bucket[0][-1], s[0][0]) if len(bucket[0]) and len(s[0]) else 0
        if len(bucket[0]):
            value = np.append(np.uint8(edge), bucket[1][:0:-1])
            down.read(bucket[0][::-1], value)
        if len(s[0]):
            s[1] = np.append(np.uint8(edge), s[1][:-1])
        out.append(np.append(bucket[0], s[0]))
        values.append(np.append(bucket[1], s[1]))
    return np.concatenate(out[::-1]), np.concatenate(values[::-1])


def sort_names(names: np.ndarray, most: int) -> np.ndarray:
    """Order of the suffixes of a string of names, followed for ``most`` names."""
    rank, width = names.astype(np.int64), 1
    while True:
        order = np.argsort(rank, kind="stable")
        new = np.append(False, rank[order[1:]] != rank[order[:-1]])
        if width >= most or new.sum() + 1 == len(rank):
            return order
        level = np.empty(len(rank), np.int64)
        level[order] = np.cumsum(new) + 1
        rank = level * (len(rank) + 2)
        rank[:-width] += level[width:]
        width *= 2


def suffixes(strings: np.ndarray, sizes: np.ndarray, limit: int):
    """Suffix places in order and their common prefixes (at most ``limit``) for
    byte strings of the given sizes, end to end.  Places count one break after
    each string."""
    n = len(strings) + len(sizes) + 1
    with tempfile.TemporaryFile() as file:
        text = (np.memmap(file, np.uint16, "w+", shape=(n + limit,)) if 2 * n > MEMORY
                else np.zeros(n + limit, np.uint16))
        text[:n] = BREAK
        at = A.ranges(np.append(0, np.cumsum(sizes + 1)[:-1]) if len(sizes) else sizes, sizes)
        text[at] = strings.astype(np.uint16) + SHIFT
        text[n - 1:] = LAST
        change = np.sign(text[1:n].astype(np.int8 if SYMBOLS < 128 else np.int32) - text[:n - 1])
        where = np.where(change != 0, np.arange(n - 1), n)
        where = np.minimum.accumulate(where[::-1])[::-1]
        small = np.append(change[np.minimum(where, n - 2)] > 0, True)
        seeds = np.flatnonzero(small[1:] & ~small[:-1]).astype(np.int32) + 1
        by = seeds[np.argsort(text[seeds], kind="stable")]
        order, _ = induce(text, small, by, np.zeros(len(by), np.uint8), limit)
        number = np.full(n, -1, np.int32)
        number[seeds] = np.arange(len(seeds))
        order = np.append(len(seeds) - 1, (x := number[order])[x >= 0])
        ends = np.append(seeds[1:], n - 1) + 1
        sums = A.prefix_sums(text[:n].astype(np.uint64) + np.uint64(1))
        content = A.span_hash(sums, seeds, ends)[order]
        names = np.empty(len(seeds), np.int64)
        names[order] = np.cumsum(np.append(False, content[1:] != content[:-1]))
        seeds = seeds[sort_names(names, limit // 2 + 1)]
        lcp = np.append(np.uint8(0), common(text, seeds[1:], seeds[:-1], limit))
        return induce(text, small, seeds, lcp, limit)
