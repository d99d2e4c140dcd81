"""Substring dedup by relative Lempel-Ziv parsing, over words.

The reference is the phrase index of all documents, cut into blocks by anchor
(``substrings.py``).  Each document is factored greedily against every block
that indexes one of its anchors: a factor grows over all consecutive phrases
that the block has from an earlier document, so within it every window repeats.
At the ends of factors a copied passage may begin or stop inside a phrase;
the 13-word windows there are looked up one by one in a second index, dealt by
window hash.  Factors and checked windows together are the duplicate spans.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cohortlake.llm import arrays as A
from cohortlake.llm import substrings as S


def _boundary(symbols: S.Symbols):
    def build(source, answers, parts):
        def windows(key, rows, told):
            open_, ids, got = S.known(told, S.OPEN), S.doc_ids(rows) if rows.num_rows else None, []
            for i, _, _, _, _, p in symbols.parts(rows) if rows.num_rows and len(open_[0]) else ():
                own = ids[i + p.doc]
                which, _, h = p.windows(S.open_phrases(p, own, open_))
                got.append((h, own[which]))
            h, own, several = S.least_ids(*(np.concatenate(x) for x in zip(*got))) if got else S.least_ids(
                np.zeros(0, np.uint64), np.zeros(0, np.int64))
            zero = np.zeros(len(h), np.uint64)
            named = {"anchor": (zero, 1), "code": (h, 8), "several": (several.astype(np.uint64), 1)}
            part = (h >> np.uint64(32)).astype(np.int64) % parts
            return S.to_table([S.dealt_rows(part, key[0].as_py(), parts, named, own)], S.arrow_schema(S.ENTRY))

        def least(rows):
            c = S.columns(rows)
            h, own = S.unpack(c["code"], [8] * rows.num_rows), S.unpack_ids(c["least"], c["width"], c["ids"])
            several = S.unpack(c["several"], [1] * rows.num_rows) > 0
            whose = np.repeat(np.arange(rows.num_rows), [len(x) for x in c["several"]])
            keys, low, _ = S.least_ids(h, own)
            first = low[S.find(keys, h)]
            m = (first < own) | several
            return S.to_table([S.answer_rows(whose[m], c["block"], S.CHECKED, h[m], first[m])],
                              S.arrow_schema(S.ANSWER))

        asked = source.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(windows, S.ENTRY)
        return asked.groupBy("part").applyInArrow(least, S.ANSWER)
    return build


def _mark(symbols: S.Symbols):
    def run(rows, told):
        schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                            ("kept", pa.string())])
        if not rows.num_rows:
            return schema.empty_table()
        repeats, checked = S.known(told, S.REPEATS), S.known(told, S.CHECKED)
        ids, n_words, n_removed, spans, kept = S.doc_ids(rows), [], [], [], []
        for i, data, at, (starts, ends), words, p in symbols.parts(rows):
            own = ids[i + p.doc]
            place = S.find(repeats[0], S.code(p))
            factor = (place >= 0) & (repeats[1][np.maximum(place, 0)] < own) if len(repeats[0]) else place >= 0
            which, start, h = p.windows(np.flatnonzero(~factor))
            place = S.find(checked[0], h)
            single = start[(place >= 0) & (checked[1][np.maximum(place, 0)] < own[which])] if len(checked[0]) else start[:0]
            begin = np.concatenate([p.first[factor], single])
            length = np.concatenate([p.last[factor] - p.first[factor], np.zeros(len(single), np.int64)]) + symbols.window
            out = A.cover(len(starts), begin, length)
            # kept words, each with the place after it, which becomes a space
            line = np.full(len(data) + 1, 0x20, np.uint8)
            line[:-1] = data
            stay = np.flatnonzero(~out)
            mask = A.cover(len(line), starts[stay], ends[stay] - starts[stay])
            total = np.append(0, np.cumsum(out))
            for d, (x, y) in enumerate(itertools.pairwise(words.tolist())):
                n_words.append(y - x)
                n_removed.append(int(total[y] - total[x]))
                if not n_removed[-1]:
                    spans.append([])
                    kept.append(b" ".join(data[at[d]:at[d + 1]].tobytes().split()).decode())
                    continue
                gone = np.diff(out[x:y].astype(np.int8), prepend=0, append=0)
                spans.append([{"start": s, "end": e} for s, e in
                              zip(np.flatnonzero(gone > 0).tolist(), np.flatnonzero(gone < 0).tolist())])
                piece = np.where(mask[at[d]:at[d + 1]], data[at[d]:at[d + 1]], 0x20).astype(np.uint8)
                kept.append(b" ".join(piece.tobytes().split()).decode())
        return pa.table([rows.column("doc_id").combine_chunks(), n_words, n_removed, spans, kept], schema=schema)
    return run


def remove_repeated_passages(docs: DataFrame, window: int = 13, gram: int = 5,
                             doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept) for every row of ``docs``.

    Words lie between ASCII spaces.  A word goes if a run of ``window`` words
    around it also starts in a document with a smaller doc_id; spans count words
    from 0, kept has the other words joined by one space.  Null and empty texts
    have no words; texts shorter than the window keep all; rows that repeat (one
    doc_id) don't count against each other; a null doc_id comes after all
    others; other columns are not read; an empty table gives an empty result."""
    symbols = S.Symbols("words", window, gram)
    return S.removed(docs, symbols, _boundary(symbols), _mark(symbols),
                     "doc_id long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept string",
                     doc_id, text)
