"""SimHash near-duplicates by meeting in the middle.

Two fingerprints at most r bits apart have a common 64-bit value at most r/2
bits from each.  So every distinct fingerprint emits all such values, equal
values meet, and the pairs that met are checked by their bit distance.

The values are dealt by their leading bits.  A fingerprint sends one row to
each leading part at most r/2 flips away; the values of a part are made in the
task that joins them, so the shuffle carries tens of rows a fingerprint rather
than thousands.  A task works through its values in slices of bounded size.
Fingerprints that share a value are all within r of one another: a star around
the first one keeps every component.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake.llm import arrays as A
from cohortlake.llm.common import connected, ready, stored

#: Values of one task, and of one slice of a task.
PART_VALUES, SLICE_VALUES = 1 << 22, 1 << 22


def majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the 64-bit values (no values: 0)."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i:i + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint(text: bytes, shingle: int) -> int:
    import xxhash
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.append(0, ends[:-1] + 1)
    n = max(1, len(words) - shingle + 1)
    h = xxhash.xxh64_intdigest
    return majority(np.array([h(line[a:b], 42) for a, b in
                              zip(starts[:n].tolist(), ends[len(words) - n:].tolist())], np.uint64))


def fingerprints(docs: DataFrame, shingle: int = 4, doc_id: str = "doc_id", text: str = "text",
                 keep: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, fp) and the kept columns, all longs: the SimHash of each row's text
    as a signed long (no words: 0)."""
    ready(docs.sparkSession)
    keep = keep or {}

    def make(batches):
        for batch in batches:
            data, offsets = A.text_bytes(batch.column(1))
            data = data.tobytes()
            out = [fingerprint(data[a:b], shingle) for a, b in itertools.pairwise(offsets.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(out, np.uint64).view(np.int64)), *batch.columns[2:]], names)

    names = ["doc_id", "fp", *keep]
    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                        *[c.alias(n) for n, c in keep.items()])
            .mapInArrow(make, ", ".join(f"{n} long" for n in names)))


def _flips(bits: int, most: int) -> np.ndarray:
    """All masks of at most ``most`` of the low ``bits`` bits."""
    masks = [0]
    for k in range(1, most + 1):
        masks += [sum(1 << i for i in c) for c in itertools.combinations(range(bits), k)]
    return np.array(masks, np.uint64)


def _meet(low: np.ndarray, left: np.ndarray, bits: int, whole: np.ndarray):
    """Pairs of places in ``whole`` whose values at most ``left`` flips away in
    the low ``bits`` bits meet: a star for every value that several have."""
    budgets = [int(x) for x in np.unique(left)]
    count = sum(int((left == b).sum()) * sum(math.comb(bits, k) for k in range(b + 1)) for b in budgets)
    if len(low) < 2:
        return
    if count > SLICE_VALUES and bits > 4:
        top, rest = low >> np.uint64(bits - 4), low & np.uint64((1 << (bits - 4)) - 1)
        for part in range(16):
            still = left - np.bitwise_count(top ^ np.uint64(part)).astype(np.int64)
            keep = still >= 0
            yield from _meet(rest[keep], still[keep], bits - 4, whole[keep])
        return
    made, whose = [], []
    for b in budgets:
        at = np.flatnonzero(left == b)
        masks = _flips(bits, b)
        made.append((masks[:, None] ^ low[at][None, :]).ravel())
        whose.append((at, len(masks)))
    values = np.concatenate(made)
    ordered = np.sort(values)
    met = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(met):
        return
    slot = lambda x: (A.mix(x) >> np.uint64(40)).astype(np.int64)
    seen = np.zeros(1 << 24, bool)
    seen[slot(met)] = True
    base = 0
    group, member = [], []
    for (at, masks), part in zip(whose, made):
        hit = np.flatnonzero(seen[slot(part)])
        place = np.minimum(np.searchsorted(met, part[hit]), len(met) - 1)
        hit, place = hit[met[place] == part[hit]], place[met[place] == part[hit]]
        group.append(place)
        member.append(at[hit % len(at)])
        base += len(part)
    group, member = np.concatenate(group), np.concatenate(member)
    order = np.lexsort((whole[member], group))
    group, member = group[order], member[order]
    first = np.append(True, group[1:] != group[:-1])
    lead = member[first][np.cumsum(first) - 1]
    yield np.stack([whole[lead], whole[member]], 1)[~first]


def near_links(distinct: DataFrame, bits: int = 4, parts: int | None = None) -> DataFrame:
    """(a, b): checked links between distinct fingerprints ``distinct(fp)`` at most
    ``bits`` bits apart, enough to connect every such pair."""
    half = bits // 2 + bits % 2
    if parts is None:
        each = sum(math.comb(64, k) for k in range(half + 1))
        parts = max(5, math.ceil(math.log2(max(1, distinct.count() * each / PART_VALUES))))
    masks = _flips(parts, half)
    flips = F.array(*[F.struct(F.lit(int(m)).alias("mask"), F.lit(int(m).bit_count()).alias("n")) for m in masks])
    sent = (distinct.select("fp", F.explode(flips).alias("f"))
            .select("fp", F.shiftrightunsigned("fp", 64 - parts).bitwiseXOR(F.col("f.mask").cast("long")).alias("part"),
                    (F.lit(half) - F.col("f.n")).alias("left")))

    def join(rows: pa.Table) -> pa.Table:
        fp = rows.column("fp").to_numpy().view(np.uint64)
        order = np.argsort(fp)
        fp, left = fp[order], rows.column("left").to_numpy().astype(np.int64)[order]
        low = fp & np.uint64((1 << (64 - parts)) - 1)
        pairs = [np.zeros((0, 2), np.int64)]
        for p in _meet(low, left, 64 - parts, np.arange(len(fp))):
            near = np.bitwise_count(fp[p[:, 0]] ^ fp[p[:, 1]]) <= bits
            pairs.append(np.unique(p[near], axis=0))
        pairs = np.unique(np.concatenate(pairs), axis=0)
        return pa.table({"a": fp[pairs[:, 0]].view(np.int64), "b": fp[pairs[:, 1]].view(np.int64)})

    return sent.groupBy("part").applyInArrow(join, "a long, b long").distinct()


def _components(prints: DataFrame, least: Column, bits: int) -> DataFrame:
    """(fp, least, component) of every distinct fingerprint; least is the minimum
    of that column over its rows, component a fingerprint."""
    own = prints.groupBy("fp").agg(F.min(least).alias("least"))
    groups = connected(near_links(prints.select("fp").distinct(), bits))
    return (own.join(groups, own.fp == groups.node, "left")
            .select("fp", "least", F.coalesce("component", "fp").alias("component")))


def near_duplicates(docs: DataFrame, shingle: int = 4, bits: int = 4,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: (doc_id, fingerprint, component_id).

    Documents whose fingerprints differ in at most ``bits`` bits are linked;
    component_id is the smallest doc_id reachable, the own one included.  Null
    and empty texts have fingerprint zero and are linked like any other; rows
    that repeat stay; a null doc_id counts in no minimum; other columns are not
    read; an empty table gives an empty result."""
    ready(docs.sparkSession)
    prints = stored(fingerprints(docs, shingle, doc_id, text), "fingerprints")
    member = _components(prints, F.col("doc_id"), bits)
    smallest = member.groupBy("component").agg(F.min("least").alias("component_id"))
    of = member.join(smallest, "component").select("fp", "component_id")
    return (prints.join(of, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def row_hash(docs: DataFrame, at: str = "") -> Column:
    """A hash of all columns; maps, which can't be hashed or compared, count as JSON."""
    def part(f: T.StructField) -> Column:
        column = F.col(f"{at}`{f.name}`")
        return F.to_json(F.struct(column)) if "map<" in f.dataType.simpleString() or "variant" in f.dataType.simpleString() else column
    return F.xxhash64(*map(part, docs.schema.fields))


def first_copies(docs: DataFrame, shingle: int = 4, bits: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, copy, row): one row for each component of near copies, its least by
    doc_id, then copy (a hash of the text), then row (a hash of all columns).

    A doc_id with several texts is in several components and may stand for each of
    them.  Rows without a doc_id link others but are never the one that stands;
    components of such rows only are not in the result."""
    ready(docs.sparkSession)
    hashes = {"copy": F.xxhash64(F.col(text).cast("string")), "row": row_hash(docs)}
    prints = stored(fingerprints(docs, shingle, doc_id, text, hashes), "fingerprints")
    least = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "copy", "row"))
    return (_components(prints, least, bits).groupBy("component").agg(F.min("least").alias("least"))
            .where("least is not null").select("least.*"))
