"""Byte-level BPE encoding and decoding.

Spark deals out the documents; each task cuts whole texts into words by the
vocabulary's pattern and encodes the distinct words it meets: arrays of their
bytes fold by ranked merges, in every word the adjacent pair of lowest rank first
(leftmost among equals), until no pair has a rank.  A document's ids are its
words' ids in order.  Decoding looks the ids up and concatenates their binary
pieces.  Nothing is shuffled.

The fold takes time in the square of a word's length.  Words over ``LONG`` bytes
(unbroken runs of one character class) take the same merges with a heap.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import ready

LONG = 64
#: Above every rank.
NO_RANK = 1 << 32
#: Distinct words that a task remembers before it starts anew.
REMEMBERED = 1 << 19
#: Characters of text that a task encodes at once; a longer text is one step.
STEP = 4 << 20


def read_ranks(path: str) -> list[tuple[str, int]]:
    """(piece in base64, rank) lines of a vocabulary file."""
    with open(path) as f:
        return [(a, int(b)) for a, b in (line.split() for line in f if line.strip())]


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a long word: the same merges, the next pair from a heap."""
    if word in ranks:
        return [ranks[word]]
    ends = list(range(1, len(word) + 1))  # end of the part that starts here, 0: none does
    before = list(range(-1, len(word) - 1))
    heap = []

    def offer(a):
        b = ends[a]
        if b < len(word) and (r := ranks.get(word[a:ends[b]])) is not None:
            heapq.heappush(heap, (r, a, b, ends[b]))

    for i in range(len(word) - 1):
        offer(i)
    while heap:
        _, a, b, c = heapq.heappop(heap)
        if ends[a] != b or ends[b] != c:
            continue
        ends[a], ends[b] = c, 0
        if c < len(word):
            before[c] = a
            offer(a)
        if a > 0:
            offer(before[a])
    out, i = [], 0
    while i < len(word):
        out.append(ranks[word[i:ends[i]]])
        i = ends[i]
    return out


class Merges:
    """Ranked merges of many words at once.

    ``pairs`` has the rank of every two pieces that make a third, in key order."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        pairs = sorted((ranks[p[:k]] << 32 | ranks[p[k:]], r) for p, r in ranks.items()
                       for k in range(1, len(p)) if p[:k] in ranks and p[k:] in ranks)
        self.pairs, self.made = np.array(pairs or [(0, NO_RANK)], np.int64).T.copy()
        self.byte = np.array([ranks[bytes([i])] for i in range(256)])
        self.two = self.rank(*np.meshgrid(self.byte, self.byte, indexing="ij"))

    def rank(self, a, b):
        """Ranks of adjacent parts by their ids (-1: no part)."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.made[at], NO_RANK)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """The ids of every word, as little-endian unsigned 32-bit integers."""
        out = [None if w not in self.ranks else np.array(self.ranks[w], "<u4").tobytes() for w in words]
        length = np.array([0 if o else len(w) for w, o in zip(words, out)], int)
        for i in np.flatnonzero(length > LONG).tolist():
            out[i] = np.array(merge_long(words[i], self.ranks), "<u4").tobytes()
        for width in (8, 16, 32, LONG):
            rows = np.flatnonzero((length > (width // 2 if width > 8 else 0)) & (length <= width))
            if len(rows):
                self._fold(words, out, rows, length[rows], width)
        return out

    def _fold(self, words, out, rows, length, width):
        """Each step merges in every word its pair of lowest rank, the leftmost
        among equals; words without one are done."""
        held = np.arange(width) < length[:, None]
        text = np.zeros((len(rows), width), np.uint8)
        text[held] = np.frombuffer(b"".join([words[i] for i in rows.tolist()]), np.uint8)
        ids = np.where(held, self.byte[text], -1)
        pairs = np.where(held[:, 1:], self.two[text[:, :-1], text[:, 1:]], NO_RANK)
        while len(rows):
            least = pairs.min(axis=1, initial=NO_RANK)
            done = least == NO_RANK
            if done.any():
                ended = ids[done]
                raw = ended[ended >= 0].astype("<u4").tobytes()
                to = (np.cumsum((ended >= 0).sum(axis=1)) * 4).tolist()
                for i, a, b in zip(rows[done].tolist(), [0, *to], to):
                    out[i] = raw[a:b]
                rows, ids, pairs, least = rows[~done], ids[~done], pairs[~done], least[~done]
                if not len(rows):
                    break
            at, every = pairs.argmin(axis=1), np.arange(len(rows))
            ids[every, at] = least
            place = np.arange(ids.shape[1])
            ids = np.where(place[:-1] <= at[:, None], ids[:, :-1], ids[:, 1:])
            pairs = np.where(place[:-2] < at[:, None], pairs[:, :-1], pairs[:, 1:])
            left, right = np.flatnonzero(at > 0), np.flatnonzero(at < pairs.shape[1])
            pairs[left, at[left] - 1] = self.rank(ids[left, at[left] - 1], least[left])
            pairs[right, at[right]] = self.rank(least[right], ids[right, at[right] + 1])


def coder(merges: Merges, pattern: str):
    """Batches of (doc_id, text) -> batches of ``encode``'s columns."""
    names = ["doc_id", "n_tokens", "ids", "decoded"]
    types = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def run(batches):
        import regex
        cut = regex.compile(pattern).findall
        pieces = {r: p for p, r in merges.ranks.items()}
        known = {}

        def block(docs, texts):
            nonlocal known
            cuts = [cut(t) for t in texts]
            if len(known) >= REMEMBERED:
                known = {}
            new = list({w for words in cuts for w in words if w not in known})
            known.update(zip(new, merges.encode([w.encode() for w in new])))
            ids = [b"".join([known[w] for w in words]) for words in cuts]
            decoded = [b"".join([pieces[i] for i in np.frombuffer(x, "<u4").tolist()]) for x in ids]
            columns = docs, [len(x) // 4 for x in ids], ids, decoded
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in batches:
            docs, texts, size = [], [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                docs.append(doc)
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= STEP:
                    yield block(docs, texts)
                    docs, texts, size = [], [], 0
            if docs:
                yield block(docs, texts)
    return run


def encode(docs: DataFrame, ranks: list[tuple[str, int]], pattern: str,
           doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) for every row of ``docs``: ids as
    little-endian unsigned 32-bit integers in a binary, the way training shards
    hold them, and the bytes that they decode to.

    ``ranks`` from ``read_ranks``; ``pattern`` cuts texts into words, with Unicode
    classes; there are no special tokens.  Null and empty texts have no ids;
    rows that repeat are encoded alike; doc_id may be null; other columns are
    not read; an empty table gives an empty result."""
    ready(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    merges = Merges({base64.b64decode(p): r for p, r in ranks})
    return rows.mapInArrow(coder(merges, pattern), "doc_id long, n_tokens long, ids binary, decoded binary")
