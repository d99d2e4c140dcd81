"""Benchmark decontamination by a prefix-filtered set join.

An item's windows are runs of ``window`` of its words.  The shingles of a window
are ordered by rarity, that is by how many documents have them; exact
containment needs only the rarest one, the prefix, to meet.  Places of prefix
shingles in documents are joined to the windows, kept if the window fits at
that place (position and length bounds), and checked word by word.

Both passes over the documents look shingles up in a bit table of fixed size
(``FILTER_BITS``), so what is sent to the tasks does not grow with the
benchmark; what passes it by chance falls in the join.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm import arrays as A
from cohortlake.llm.common import ready, stored

SHINGLE = 3
#: Size of the bit table sent to the tasks; places of one row.
FILTER_BITS, PLACES = 1 << 22, 4096


def _words(column):
    """Chunks of texts: (first row, lower-cased bytes, word starts, ends, offsets
    of the documents, sums for hashes of runs of words)."""
    data, offsets = A.text_bytes(column)
    for i, j in A.chunks(offsets):
        part = A.LOWER[data[offsets[i]:offsets[j]]]
        starts, ends, at = A.word_spans(part, offsets[i:j + 1] - offsets[i], A.ALNUM)
        yield i, part, starts, ends, at, A.prefix_sums(A.span_hash(A.prefix_sums(A.BYTE_VALUE[part]), starts, ends))


def _grams(sums: np.ndarray, at: np.ndarray, size: int):
    """Place, document and hash of every run of ``size`` words within a document."""
    place = A.ranges(at[:-1], np.maximum(np.diff(at) - size + 1, 0))
    return place, np.searchsorted(at, place, "right") - 1, A.span_hash(sums, place, place + size)


def item_windows(items: DataFrame, window: int, item_id: str, text: str) -> DataFrame:
    """(item_id, start, words, grams): every window of every item with the hashes of
    its shingles; an item of fewer words is one window."""
    def make(batches):
        for batch in batches:
            for i, part, starts, ends, at, sums in _words(batch.column(1)):
                rows = {"item_id": [], "start": [], "words": [], "grams": []}
                raw = part.tobytes()
                for d, (a, b) in enumerate(itertools.pairwise(at.tolist())):
                    words = [raw[x:y].decode() for x, y in zip(starts[a:b].tolist(), ends[a:b].tolist())]
                    size = min(window, b - a)
                    g = min(SHINGLE, size)
                    hashes = A.span_hash(sums, np.arange(a, b - g + 1), np.arange(a, b - g + 1) + g).view(np.int64).tolist() if size else []
                    for s in range(b - a - size + 1 if size else 0):
                        rows["item_id"].append(batch.column(0)[i + d].as_py())
                        rows["start"].append(s)
                        rows["words"].append(words[s:s + size])
                        rows["grams"].append(hashes[s:s + size - g + 1])
                yield pa.RecordBatch.from_arrays([
                    pa.array(rows["item_id"], pa.string()), pa.array(rows["start"], pa.int32()),
                    pa.array(rows["words"], pa.list_(pa.string())), pa.array(rows["grams"], pa.list_(pa.int64()))],
                    ["item_id", "start", "words", "grams"])

    return (items.select(F.col(item_id).cast("string").alias("item_id"), F.col(text).cast("string").alias("text"))
            .mapInArrow(make, "item_id string, start int, words array<string>, grams array<long>"))


def _bits(grams: DataFrame) -> np.ndarray:
    """The bit table of ``grams(gram)``."""
    rows = grams.select(F.pmod("gram", F.lit(FILTER_BITS)).cast("int").alias("slot")).distinct().toArrow()
    table = np.zeros(FILTER_BITS, bool)
    table[rows.column("slot").to_numpy()] = True
    return np.packbits(table)


def _hits(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    slot = np.mod(h.view(np.int64), FILTER_BITS)
    return (bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 > 0


def frequency(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """(gram, n): in how many documents each shingle of the benchmark stands."""
    bits = _bits(grams)

    def count(batches):
        for batch in batches:
            keys = []
            for i, _, _, _, at, sums in _words(batch.column(0)):
                for size in range(1, SHINGLE + 1):
                    _, doc, h = _grams(sums, at, size)
                    m = _hits(bits, h)
                    pair = np.unique(np.stack([h[m].view(np.int64), i + doc[m]]), axis=1)
                    keys.append(pair[0])
            values, n = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(n.astype(np.int64))], ["gram", "n"])

    counts = docs.select(F.col("text")).mapInArrow(count, "gram long, n long")
    return grams.distinct().join(counts.groupBy("gram").agg(F.sum("n").alias("n")), "gram", "left").fillna(0, ["n"])


def _places(bits: np.ndarray, window: int):
    """Every document's number of words (the row with ``own``), and the places of prefix
    shingles with the words around that a window there could cover, at most ``PLACES``
    a row.  A shingle of fewer than ``SHINGLE`` words is a whole window itself."""
    kind = pa.list_(pa.struct([("at", pa.int64()), ("gram", pa.int64()), ("base", pa.int64()), ("words", pa.list_(pa.string()))]))

    def run(batches):
        for batch in batches:
            for i, part, starts, ends, at, sums in _words(batch.column(2)):
                raw, places = part.tobytes(), []
                for size in range(1, SHINGLE + 1):
                    place, doc, h = _grams(sums, at, size)
                    m = np.flatnonzero(_hits(bits, h))
                    places.append(np.stack([doc[m], place[m], np.full(len(m), size), h[m].view(np.int64)], 1))
                places = np.concatenate(places)
                places = places[np.argsort(places[:, 0], kind="stable")]
                n = len(at) - 1
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, n), batch.column(1).slice(i, n), pa.array(np.diff(at).astype(np.int64)),
                                                  pa.array([True] * n), pa.array([[]] * n, kind)], names)
                for k in range(0, len(places), PLACES):
                    found: dict[int, list] = {}
                    for d, p, size, g in places[k:k + PLACES].tolist():
                        a, b = (p, p + size) if size < SHINGLE else (max(int(at[d]), p + size - window), min(int(at[d + 1]), p + window))
                        found.setdefault(d, []).append({"at": p - int(at[d]), "gram": g, "base": a - int(at[d]), "words": [
                            raw[x:y].decode() for x, y in zip(starts[a:b].tolist(), ends[a:b].tolist())]})
                    of = pa.array([i + d for d in found])
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(of), batch.column(1).take(of),
                                                      pa.array([int(at[d + 1] - at[d]) for d in found]),
                                                      pa.array([False] * len(found)), pa.array(list(found.values()), kind)], names)

    names = ["doc_id", "copy", "n_words", "own", "found"]
    return run


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, doc_id: str = "doc_id",
                  text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, copy, n_words, n_hit, n_items, items, contaminated) for every row of ``docs``.

    Words are runs of digits, letters a-z and non-ASCII characters after A-Z
    are lower-cased.  A word is hit if it lies in an occurrence of a window;
    items are the ids (as strings, sorted) with windows that occur; copy is a
    hash of the text, so that rows that repeat a doc_id keep their own results.
    Null and empty texts have no words and, as items, no windows; an item
    without an id hits words but is not listed; other columns are not read; an
    empty benchmark hits nothing and an empty table gives an empty result.  Of a very
    long text, memory holds the words and some thousand places at once."""
    ready(docs.sparkSession)
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                         F.xxhash64(F.col(text).cast("string")).alias("copy"), F.col(text).cast("string").alias("text"))
    windows = stored(item_windows(items, window, item_id, item_text), "windows")
    each = windows.select("item_id", "start", "words", F.posexplode("grams").alias("offset", "gram"))
    rarity = frequency(source, each.select("gram"))
    # one row for each distinct window, however many items have it
    prefix = stored(each.join(rarity, "gram").groupBy("words")
                    .agg(F.min(F.struct("n", "gram", "offset")).alias("p"), F.array_sort(F.collect_set("item_id")).alias("items"))
                    .select(F.col("words").alias("window"), "p.gram", "p.offset", F.xxhash64("items").alias("group"), "items"), "prefixes")
    found = stored(source.mapInArrow(
        _places(_bits(prefix.select("gram")), window), "doc_id long, copy long, n_words long, own boolean, "
        "found array<struct<at:long,gram:long,base:long,words:array<string>>>"), "places")
    start, size = F.col("at") - F.col("offset"), F.size("window")
    hits = (found.select("doc_id", "copy", "n_words", F.explode("found").alias("f"))
            .select("doc_id", "copy", "n_words", "f.*").join(prefix.drop("items"), "gram")
            .where((start >= 0) & (start + size <= F.col("n_words")))
            .where(F.slice("words", (start - F.col("base") + 1).cast("int"), size) == F.col("window"))
            .select("doc_id", "copy", start.alias("from"), (start + size).alias("to"), "group"))
    covered = F.aggregate(
        F.array_sort(F.collect_set(F.struct("from", "to"))), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda acc, x: F.struct((acc["n"] + F.greatest(F.lit(0).cast("long"), x["to"] - F.greatest(x["from"], acc["end"]))).alias("n"),
                                F.greatest(acc["end"], x["to"]).alias("end")), lambda acc: acc["n"])
    hit = stored(hits.groupBy("doc_id", "copy").agg(covered.alias("n_hit"), F.collect_set("group").alias("groups")), "hits")
    # sets of items that windows have in common are united once for each document
    sets = prefix.groupBy("group").agg(F.first("items").alias("items"))
    listed = (hit.select("doc_id", "copy", F.explode("groups").alias("group")).join(sets, "group").groupBy("doc_id", "copy")
              .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")))
    own = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.copy") == F.col("b.copy"))
    hit = hit.alias("a").join(listed.alias("b"), own).select("a.doc_id", "a.copy", "n_hit", "items")
    rows = found.where("own").select("doc_id", "copy", "n_words").alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("d.copy") == F.col("h.copy"))
    return (rows.join(hit.alias("h"), same, "left")
            .select("d.doc_id", "d.copy", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")))
