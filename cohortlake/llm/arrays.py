"""Numpy helpers over Arrow batches, used inside Spark tasks.

A batch of texts is one byte array with document offsets; words, hashes and
windows are computed for all its documents at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Symbols (bytes or words) handled at once; a longer document is one chunk.
CHUNK = 1 << 19
_RNG = np.random.default_rng(20240229)
#: One random 64-bit value per byte, and the odd base of the rolling hash.
BYTE_VALUE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]``: digits, a-z, and all of non-ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, end to end, and the offsets of its rows
    (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK):
    """Ranges of documents (i, j) of at most ``limit`` symbols, or one document."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j
        i = j


def word_spans(data: np.ndarray, offsets: np.ndarray, word: np.ndarray):
    """Starts and ends of the maximal runs of ``word`` bytes within documents,
    and the offsets of the documents in those lists."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = word[data]
    before = np.empty(len(data) + 1, bool)
    before[0], before[1:] = False, inside
    cut = offsets[(offsets > 0) & (offsets < len(data))]
    before[cut] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.empty(len(data) + 1, bool)
    after[:-1], after[-1] = inside, False
    after[cut] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int, which: str = "up") -> np.ndarray:
    """BASE ** j (or its inverse) modulo 2**64 for j < n."""
    if len(_POWERS[which]) < n:
        step = np.full(max(n, CHUNK + 1), BASE if which == "up" else BASE_INVERSE, np.uint64)
        step[0] = 1
        _POWERS[which] = np.cumprod(step)
    return _POWERS[which][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a rolling hash over all 64 bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums from which ``span_hash`` takes the hash of any span."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values)), out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span's content, wherever it stands."""
    h = (sums[ends] - sums[starts]) * powers(len(sums), "down")[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def gram_hash(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k symbols from each position that has them."""
    have, width, out, done = values, 1, None, 0
    while True:
        if k & width:
            if out is None:
                out = have
            else:
                n = len(values) - done - width + 1
                out = out[:n] * np.uint64(pow(int(BASE), width, 1 << 64)) + have[done:done + n]
            done += width
        if done == k:
            return mix(out)
        have = have[:-width] * np.uint64(pow(int(BASE), width, 1 << 64)) + have[width:]
        width *= 2


def window_min(p: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, whose low six bits count the
    steps to the leftmost place that has it (the values come with those bits
    clear; width is 64 at most)."""
    done = 1
    while done < width:
        step = min(done, width - done)
        p = np.minimum(p[:-step], p[step:] + np.uint64(step))
        done += step
    return p


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers starts[i] .. starts[i] + lengths[i] - 1, one after another."""
    total = int(lengths.sum())
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return np.arange(total, dtype=np.int64) + shift


def cover(size: int, starts: np.ndarray, length) -> np.ndarray:
    """Which of ``size`` places lie in a span [start, start + length)."""
    edge = np.zeros(size + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + length, -1)
    return np.cumsum(edge[:-1]) > 0


def binary(rows: list[bytes]) -> pa.Array:
    return pa.array(rows, pa.binary())
