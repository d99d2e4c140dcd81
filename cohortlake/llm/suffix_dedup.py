"""Suffix-array dedup over bytes.

``substrings.py`` settles passages whose whole phrase repeats.  What is left,
the distinct phrases in which a repeat may begin or end, goes to shards by
anchor.  A shard sorts all suffixes of its phrases by external induced sorting
(``induced.py``); suffixes in a row with a common prefix of a window or more
start equal windows, and those of later documents are repeats.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cohortlake.llm import arrays as A
from cohortlake.llm import induced
from cohortlake.llm import substrings as S

SHARD = "part int, block int, text binary, sizes binary, code binary, least long, width int, ids binary"


def repeated(strings: np.ndarray, sizes: np.ndarray, ids: np.ndarray, window: int) -> np.ndarray:
    """For each string a mask of the window starts whose bytes also start in a
    string with a smaller id (bit j: place j)."""
    masks = np.zeros(len(sizes), np.uint64)
    place, lcp = induced.suffixes(strings, sizes, window)
    group = np.cumsum(lcp < window)
    begin = np.append(0, np.cumsum(sizes + 1))
    whose = np.searchsorted(begin, place, "right") - 1
    inside = np.flatnonzero((whose < len(sizes)) & (place + window < begin[np.minimum(whose + 1, len(sizes))]))
    if not len(inside):
        return masks
    place, group, whose = place[inside], group[inside], whose[inside]
    at = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    first = np.repeat(np.minimum.reduceat(ids[whose], at), np.diff(np.append(at, len(group))))
    late = first < ids[whose]
    np.bitwise_or.at(masks, whose[late], np.uint64(1) << (place[late] - begin[whose[late]]).astype(np.uint64))
    return masks


def _boundary(symbols: S.Symbols):
    def build(source, answers, parts):
        def shards(key, rows, told):
            schema, open_ = S.arrow_schema(SHARD), S.known(told, S.OPEN)
            out, got = {f.name: [] for f in schema}, []
            ids = S.doc_ids(rows) if rows.num_rows else None
            for i, data, _, _, _, p in symbols.parts(rows) if rows.num_rows and len(open_[0]) else ():
                own = ids[i + p.doc]
                which = S.open_phrases(p, own, open_)
                size = p.last[which] - p.first[which] + symbols.window
                got.append((p.anchor[which], S.code(p)[which], own[which], size, data[A.ranges(p.first[which], size)]))
            if got:
                anchor, codes, own, size, text = (np.concatenate(x) for x in zip(*got))
                begin = np.append(0, np.cumsum(size))
                part = (anchor >> np.uint64(32)).astype(np.int64) % parts
                order = np.argsort(part, kind="stable")
                bounds = np.searchsorted(part[order], np.arange(parts + 1))
                for p, (i, j) in enumerate(itertools.pairwise(bounds.tolist())):
                    if i < j:
                        at = order[i:j]
                        least, width, body = S.pack_ids(own[at])
                        row = (p, key[0].as_py(), text[A.ranges(begin[at], size[at])].tobytes(),
                               S.pack(size[at], 4), S.pack(codes[at], 8), least, width, body)
                        for name, v in zip(out, row):
                            out[name].append(v)
            return S.to_table([out], schema)

        def sort(rows):
            c = S.columns(rows)
            sizes = S.unpack(c["sizes"], [4] * rows.num_rows).astype(np.int64)
            codes, own = S.unpack(c["code"], [8] * rows.num_rows), S.unpack_ids(c["least"], c["width"], c["ids"])
            masks = repeated(np.frombuffer(b"".join(c["text"]), np.uint8), sizes, own, symbols.window)
            whose = np.repeat(np.arange(rows.num_rows), [len(x) // 8 for x in c["code"]])
            hit = masks > 0
            return S.to_table([S.answer_rows(whose[hit], c["block"], S.CHECKED, codes[hit], masks[hit].view(np.int64))],
                              S.arrow_schema(S.ANSWER))

        sent = source.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(shards, SHARD)
        return sent.groupBy("part").applyInArrow(sort, S.ANSWER)
    return build


def _mark(symbols: S.Symbols):
    def run(rows, told):
        schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                            ("kept", pa.binary())])
        if not rows.num_rows:
            return schema.empty_table()
        repeats, checked, opened = S.known(told, S.REPEATS), S.known(told, S.CHECKED), S.known(told, S.OPEN)
        ids, n_bytes, n_removed, spans, kept = S.doc_ids(rows), [], [], [], []
        for i, data, at, _, _, p in symbols.parts(rows):
            own, codes = ids[i + p.doc], S.code(p)
            place = S.find(repeats[0], codes)
            whole = (place >= 0) & (repeats[1][np.maximum(place, 0)] < own) if len(repeats[0]) else place >= 0
            place, first = S.find(checked[0], codes), S.find(opened[0], codes)
            part = np.flatnonzero((place >= 0) & ~whole)
            part = part[opened[1][first[part]] == own[part]]
            masks = checked[1][place[part]].view(np.uint64)
            begin, length = [p.first[whole]], [p.last[whole] - p.first[whole] + symbols.window]
            for j in range(symbols.window - symbols.k + 1):
                hit = part[(masks >> np.uint64(j)) & np.uint64(1) > 0]
                begin.append(p.first[hit] + j)
                length.append(np.full(len(hit), symbols.window))
            out = A.cover(len(data), np.concatenate(begin), np.concatenate(length))
            total = np.append(0, np.cumsum(out))
            for x, y in itertools.pairwise(at.tolist()):
                n_bytes.append(y - x)
                n_removed.append(int(total[y] - total[x]))
                if not n_removed[-1]:
                    spans.append([])
                    kept.append(data[x:y].tobytes())
                    continue
                gone = np.diff(out[x:y].astype(np.int8), prepend=0, append=0)
                spans.append([{"start": s, "end": e} for s, e in
                              zip(np.flatnonzero(gone > 0).tolist(), np.flatnonzero(gone < 0).tolist())])
                kept.append(data[x:y][~out[x:y]].tobytes())
        return pa.table([rows.column("doc_id").combine_chunks(), n_bytes, n_removed, spans, kept], schema=schema)
    return run


def remove_repeated_bytes(docs: DataFrame, window: int = 50, gram: int = 20,
                          doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept) for every row of ``docs``.

    Texts are UTF-8 bytes (null: empty).  A byte goes if a run of ``window`` bytes
    around it also starts in a document with a smaller doc_id; spans are the
    maximal removed runs, kept (binary) is the rest, which may cut characters.
    Texts shorter than the window keep all; rows that repeat (one doc_id) don't
    count against each other; a null doc_id comes after all others; other columns
    are not read; an empty table gives an empty result."""
    symbols = S.Symbols("bytes", window, gram)
    return S.removed(docs, symbols, _boundary(symbols), _mark(symbols),
                     "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary",
                     doc_id, text)
