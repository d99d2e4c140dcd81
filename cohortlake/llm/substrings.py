"""Exact removal of repeated passages: what both substring operators share.

Which windows of a document also start in a document with a smaller doc_id?
Phrases (``phrases.py``) answer it without moving every window:

1. Documents are dealt to *blocks* by hash.  A block lists its distinct phrases
   (anchor hash, key, smallest doc_id) and deals them to *reference blocks* by
   anchor hash.
2. A reference block indexes the phrases of all documents with its anchors.
   It answers with the smallest doc_id of every phrase that several documents
   have: all windows of such a phrase repeat in the later ones.
3. Where one anchor has different phrases, a passage may begin or end inside
   them.  Only the first document of each such phrase is still open; its windows
   are checked one by one, by the operator's own method (``Boundary``).
4. Every block marks the repeated windows in its documents.

A phrase or window is sent once a block however often it occurs there, so a
passage in a third of all documents costs one entry a block; no document list
is ever gathered.  The dealt texts are one shuffle, reused by each step.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm import arrays as A
from cohortlake.llm.common import blocks_for, ready, text_size
from cohortlake.llm.phrases import Phrases

#: Bytes of text in a block.
BLOCK_BYTES = 8 << 20
#: Stands for a null doc_id: after all others, equal to itself.
NO_ID = np.iinfo(np.int64).max
LOW48 = np.uint64((1 << 48) - 1)


def pack(x: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(x).view(np.uint64).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack(rows, widths) -> np.ndarray:
    """Numbers of several packed rows, one after another."""
    out = []
    for row, width in zip(rows, widths):
        body = np.frombuffer(row, np.uint8).reshape(-1, width)
        wide = np.zeros((len(body), 8), np.uint8)
        wide[:, :width] = body
        out.append(wide.view(np.uint64).ravel())
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def pack_ids(ids: np.ndarray) -> tuple[int, int, bytes]:
    """Least id, bytes an id, and the ids less the least one."""
    least = int(ids.min())
    steps = ids.view(np.uint64) - np.uint64(least & (1 << 64) - 1)
    width = max(1, (int(steps.max()).bit_length() + 7) // 8)
    return least, width, pack(steps, width)


def unpack_ids(least, widths, rows) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64)] + [
        (unpack([r], [w]) + np.uint64(x & (1 << 64) - 1)).view(np.int64) for x, w, r in zip(least, widths, rows)])


def grouped(keys: list[np.ndarray]):
    """Order that sorts by the keys (first one first) and where its groups start."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order[1:]] != k[order[:-1]]
    return order, np.flatnonzero(new)


def least_ids(keys: np.ndarray, ids: np.ndarray):
    """Distinct keys, the smallest id of each, and whether it has several ids."""
    if not len(keys):
        return keys, ids, np.zeros(0, bool)
    order = np.argsort(keys)
    keys, ids = keys[order], ids[order]
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    low = np.minimum.reduceat(ids, at)
    return keys[at], low, np.maximum.reduceat(ids, at) != low


def find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted value in the sorted keys, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def columns(rows: pa.Table) -> dict[str, list]:
    return {name: rows.column(name).to_pylist() for name in rows.column_names}


def doc_ids(rows: pa.Table) -> np.ndarray:
    import pyarrow.compute as pc
    return pc.fill_null(rows.column("doc_id").combine_chunks(), int(NO_ID)).to_numpy(zero_copy_only=False)


class Symbols:
    """How texts become windows: bytes, or words between ASCII spaces."""

    def __init__(self, kind: str, window: int, k: int):
        self.kind, self.window, self.k = kind, window, k

    def parts(self, rows: pa.Table):
        """Chunks of a block: (first row, bytes, byte offsets, spans of the
        symbols in them, symbol offsets of the documents, phrases)."""
        data, offsets = A.text_bytes(rows.column("text"))
        for i, j in A.chunks(offsets):
            part, at = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
            if self.kind == "bytes":
                yield i, part, at, None, at, Phrases(A.BYTE_VALUE[part], at, self.window, self.k)
            else:
                starts, ends, words = A.word_spans(part, at, ~A.SPACE)
                values = A.span_hash(A.prefix_sums(A.BYTE_VALUE[part]), starts, ends)
                yield i, part, at, (starts, ends), words, Phrases(values, words, self.window, self.k)


def code(p: Phrases) -> np.ndarray:
    """64 bits by which a block knows a phrase: 48 of its key, 16 of its anchor."""
    return (p.key & LOW48) << np.uint64(16) | p.anchor & np.uint64(0xFFFF)


ENTRY = "part int, block int, anchor binary, code binary, least long, width int, ids binary, several binary"
ANSWER = "block int, kind int, code binary, least long, width int, ids binary"


def dealt_rows(part: np.ndarray, block: int, parts: int, named: dict, ids: np.ndarray) -> dict:
    """Rows of ENTRY: the entries of each part, packed."""
    out = {k: [] for k in ("part", "block", *named, "least", "width", "ids")}
    order = np.argsort(part, kind="stable")
    bounds = np.searchsorted(part[order], np.arange(parts + 1))
    for p, (i, j) in enumerate(itertools.pairwise(bounds.tolist())):
        if i < j:
            at = order[i:j]
            least, width, body = pack_ids(ids[at])
            for k, v in {"part": p, "block": block, "least": least, "width": width, "ids": body,
                         **{k: pack(v[at], w) for k, (v, w) in named.items()}}.items():
                out[k].append(v)
    return out


def answer_rows(whose: np.ndarray, blocks: list[int], kind: int, codes: np.ndarray, ids: np.ndarray) -> dict:
    """Rows of ANSWER: what each asking row gets."""
    out = {k: [] for k in ("block", "kind", "code", "least", "width", "ids")}
    bounds = np.searchsorted(whose, np.arange(len(blocks) + 1))
    for block, (i, j) in zip(blocks, itertools.pairwise(bounds.tolist())):
        if i < j:
            least, width, body = pack_ids(ids[i:j])
            for k, v in {"block": block, "kind": kind, "code": pack(codes[i:j], 8),
                         "least": least, "width": width, "ids": body}.items():
                out[k].append(v)
    return out


def to_table(parts: list[dict], schema) -> pa.Table:
    merged = {f.name: list(itertools.chain.from_iterable(p[f.name] for p in parts)) for f in schema}
    return pa.table({f.name: pa.array(merged[f.name], f.type) for f in schema}, schema=schema)


def arrow_schema(text: str):
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in text.split(", "))])


#: Kinds of answers: a phrase that repeats, an open phrase, and what the boundary check found.
REPEATS, OPEN, CHECKED = 0, 1, 2


def ask(symbols: Symbols, parts: int):
    def run(key, rows):
        ids, got = doc_ids(rows), []
        for i, _, _, _, _, p in symbols.parts(rows):
            got.append((p.anchor, code(p), ids[i + p.doc]))
        anchor, codes, ids = (np.concatenate(x) for x in zip(*got))
        whole = A.mix(anchor * A.BASE + codes)
        order = np.argsort(whole)
        whole, anchor, codes, ids = whole[order], anchor[order], codes[order], ids[order]
        at = np.flatnonzero(np.append(True, whole[1:] != whole[:-1])) if len(whole) else np.zeros(0, np.int64)
        low = np.minimum.reduceat(ids, at) if len(at) else ids
        several = np.maximum.reduceat(ids, at) != low if len(at) else ids
        anchor, codes = anchor[at], codes[at]
        part = (anchor >> np.uint64(32)).astype(np.int64) % parts
        named = {"anchor": (anchor, 4), "code": (codes >> np.uint64(16), 6), "several": (several.astype(np.uint64), 1)}
        return to_table([dealt_rows(part, key[0].as_py(), parts, named, low)], arrow_schema(ENTRY))
    return run


def answer(rows):
    """Of one reference block: the smallest doc_id of phrases that repeat, and
    the phrases left open."""
    c = columns(rows)
    anchor, key = unpack(c["anchor"], [4] * rows.num_rows), unpack(c["code"], [6] * rows.num_rows)
    low, several = unpack_ids(c["least"], c["width"], c["ids"]), unpack(c["several"], [1] * rows.num_rows) > 0
    whose = np.repeat(np.arange(rows.num_rows), [len(x) for x in c["several"]])
    order, at = grouped([anchor, key])
    group = np.empty(len(order), np.int64)
    group[order] = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(order))))
    first = np.minimum.reduceat(low[order], at)[group]
    kinds = np.unique(anchor[order[at]], return_counts=True)
    many = kinds[1][np.searchsorted(kinds[0], anchor)] > 1
    codes = key << np.uint64(16) | anchor & np.uint64(0xFFFF)
    repeats, still = (first < low) | several, many & (low == first)
    return to_table([answer_rows(whose[m], c["block"], kind, codes[m], first[m])
                     for kind, m in ((REPEATS, repeats), (OPEN, still))], arrow_schema(ANSWER))


def known(rows: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes (sorted) and numbers of one kind of answers to a block."""
    c = columns(rows)
    at = [i for i, k in enumerate(c["kind"]) if k == kind]
    take = lambda name: [c[name][i] for i in at]
    codes = unpack(take("code"), [8] * len(at))
    ids = unpack_ids(take("least"), take("width"), take("ids"))
    order = np.argsort(codes)
    return codes[order], ids[order]


def open_phrases(p: Phrases, ids: np.ndarray, rows: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Numbers of the phrases in their first document that must be checked; one
    of each kind a document."""
    codes, first = rows
    at = find(codes, code(p))
    which = np.flatnonzero((at >= 0) & (first[np.maximum(at, 0)] == ids) if len(codes) else at >= 0)
    _, one = np.unique(np.stack([code(p)[which].view(np.int64), ids[which]]), axis=1, return_index=True)
    return which[np.sort(one)]


def removed(docs: DataFrame, symbols: Symbols, boundary, mark, schema: str,
            doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Runs the four steps.  ``boundary(source, answers, parts)`` -> rows of ANSWER with
    kind CHECKED; ``mark(rows, answers)`` -> the result rows of one block."""
    ready(docs.sparkSession)
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    blocks = blocks_for(text_size(source), BLOCK_BYTES)
    source = source.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))
    asked = source.groupBy("block").applyInArrow(ask(symbols, blocks), ENTRY)
    answers = asked.groupBy("part").applyInArrow(answer, ANSWER)
    checked = boundary(source, answers, blocks)
    return (source.groupBy("block").cogroup(answers.unionByName(checked).groupBy("block"))
            .applyInArrow(mark, schema))
