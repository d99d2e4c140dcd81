"""Hard-negative mining with angular triangle filtering.

Every row stores its angles to a few reference directions and its norm.  For an
anchor and a row, each reference gives |a - b| <= angle <= min(a + b, 2 pi - a - b),
so the best of them give an interval of the cosine; times both norms it is an
interval of the score, widened by more than any rounding.  Only rows whose
interval overlaps a wanted window get the integer inner product.

Rows are dealt in blocks, sorted by their nearest reference and the angle to it,
so a block has narrow ranges of angles: the same bounds on these ranges tell which
blocks an anchor must visit at all.  A task holds one block and streams the anchors
that visit it.  Positives come first; the wanted window there is all from the
anchor's fifth best score in its own block.  They fix the windows of the negatives.
"""

from __future__ import annotations

import math
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.llm.common import ready, stored
from cohortlake.llm.meeting import Once, meet
from cohortlake.llm.vectors import lists, matrix, usable

#: Rows of a block, blocks of a page of block ranges, anchors compared at once.
BLOCK_ROWS, PAGE_BLOCKS, SLICE = 16384, 512, 64
#: Rows looked at to choose the reference directions.
SAMPLE = 1000

_PLACED = ("block long, vec_id long, label long, sig long, q array<double>, angles array<double>, norm double, "
           "anchor boolean, own_score array<long>, own_id array<long>, own_sig array<long>")
_LONG = pa.list_(pa.int64())


def directions(rows: DataFrame, k: int, scale: int) -> np.ndarray:
    """Unit vectors of ``k`` rows of a sample, each the one farthest in angle from
    those before it."""
    sample = rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(SAMPLE).select("v").toArrow()
    x = matrix(sample.column("v")) * float(scale)
    norm = np.linalg.norm(x, axis=1)
    x = x[norm > 0] / norm[norm > 0][:, None]
    if not len(x):
        return np.zeros((0, x.shape[1]))
    chosen = [0]
    near = x @ x[0]
    while len(chosen) < min(k, len(x)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, x @ x[chosen[-1]])
    return x[chosen]


def measure(rows: DataFrame, references: np.ndarray, scale: int, width: int) -> DataFrame:
    """Scaled integer entries (``width`` of them), angles to the references, and the norm of each row."""
    directions_ = np.pad(references, ((0, 0), (0, width - references.shape[1])))

    def run(batches):
        for batch in batches:
            big = np.finfo(np.float64).max
            with np.errstate(over="ignore"):
                q = np.clip(np.floor(matrix(batch.column(2), width) * scale), -big, big) + 0.0
            peak = np.maximum(np.abs(q).max(axis=1, initial=0.0), 1.0)
            unit = q / peak[:, None]
            norm = np.linalg.norm(unit, axis=1)
            unit /= np.maximum(norm, 1e-300)[:, None]
            cos = np.clip(unit @ directions_.T, -1.0, 1.0)
            angles = np.where((norm > 0)[:, None], np.arccos(cos), np.pi / 2)
            near = angles.argmin(1) if angles.shape[1] else np.zeros(len(q), int)
            best = angles.min(axis=1, initial=np.pi)
            with np.errstate(over="ignore"):
                norm = np.minimum(norm * peak, big)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), lists(q, pa.float64()), lists(angles, pa.float64()),
                 pa.array(norm), pa.array(near.astype(np.int32)), pa.array(best)],
                ["vec_id", "label", "anchor", "q", "angles", "norm", "near", "best"])

    return rows.mapInArrow(run, "vec_id long, label long, anchor boolean, q array<double>, angles array<double>, "
                                "norm double, near int, best double")


class Block:
    """Rows as columns of numpy arrays."""

    def __init__(self, table: pa.Table):
        c = {n: table.column(n) for n in ("vec_id", "label", "sig", "norm")}
        self.ids, self.labels, self.sigs = (c[n].to_numpy() for n in ("vec_id", "label", "sig"))
        self.norms = c["norm"].to_numpy()
        self.q, self.angles = matrix(table.column("q")), matrix(table.column("angles"))
        self.most = float(np.abs(self.q).max(initial=0.0))

    def scores(self, at: np.ndarray, a: np.ndarray) -> np.ndarray:
        """Integer inner products of some rows with ``a``, held to 64 bits."""
        most = int(self.most) * int(np.abs(a).max(initial=0.0)) * len(a)
        q = self.q[at]
        if most < 1 << 53:
            return (q @ a).astype(np.int64)
        if most < 1 << 63 and self.most < 1 << 63:
            return q.astype(np.int64) @ a.astype(np.int64)
        whole = [int(v) for v in a.tolist()]
        found = [sum(int(x) * w for x, w in zip(row, whole)) for row in q.tolist()]
        return np.array([max(-(1 << 63), min((1 << 63) - 1, s)) for s in found], np.int64)

    def best(self, at: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
        """The first k places of ``at`` by score, then vec_id, then content."""
        if len(at) > k:
            cut = np.partition(score, len(score) - k)[len(score) - k]
            at, score = at[score >= cut], score[score >= cut]
        return np.lexsort((self.sigs[at], self.ids[at], -score))[:k], at, score


def score_bounds(angles: np.ndarray, norms: np.ndarray, low, high, least, most, width: int):
    """Least and greatest possible score of each anchor (rows) with each thing
    (columns) whose angles lie in [low, high] and whose norm is in [least, most]."""
    slack = 8 * math.sqrt(2 * (width + 8) * 2.3e-16)
    near = np.zeros((len(norms), len(least)))
    far = np.full(near.shape, np.pi)
    for i in range(angles.shape[1]):
        a = angles[:, i, None]
        np.maximum(near, np.maximum(a - high[None, :, i], low[None, :, i] - a), out=near)
        np.minimum(far, np.minimum(a + high[None, :, i], 2 * np.pi - a - low[None, :, i]), out=far)
    up = np.cos(np.maximum(near - slack, 0.0))
    down = np.cos(np.minimum(far + slack, np.pi))
    with np.errstate(over="ignore", invalid="ignore"):
        big = np.multiply.outer(norms, most)
        small = np.multiply.outer(norms, least)
        margin = 1.0 + 1e-9 * big
        top = np.nan_to_num(np.where(up > 0, big, small) * up, nan=np.inf) + margin
        bottom = np.nan_to_num(np.where(down > 0, small, big) * down, nan=-np.inf) - margin
    return bottom, top


def overlapping(bottom: np.ndarray, top: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Which score intervals meet one of an anchor's windows (low, high, low, high ...)."""
    hit = np.zeros(top.shape, bool)
    for j in range(0, windows.shape[1], 2):
        hit |= (top >= windows[:, j, None]) & (bottom <= windows[:, j + 1, None])
    return hit


def _window_matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    """Windows of unequal number; those missing are empty ones."""
    got = column.to_pylist()
    width = max((len(w) for w in got), default=0)
    out = np.tile(np.array([np.inf, -np.inf]), (rows, width // 2))
    for i, w in enumerate(got):
        out[i, :len(w)] = w
    return out


def place(measured: DataFrame, blocks: int, positives: int) -> DataFrame:
    """Rows with their block; anchors also have their best positives in that block."""
    def run(batches):
        from pyspark import TaskContext
        block = TaskContext.get().partitionId()
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        rows = pa.Table.from_batches(batches)
        held = Block(rows)
        own = [([], [], [])] * len(rows)
        for i in np.flatnonzero(rows.column("anchor").to_numpy(zero_copy_only=False)):
            same = np.flatnonzero(held.labels == held.labels[i])
            same = same[same != i]
            if len(same):
                order, at, score = held.best(same, held.scores(same, held.q[i]), positives)
                own[i] = (score[order].tolist(), held.ids[at[order]].tolist(), held.sigs[at[order]].tolist())
        out = {n: rows.column(n) for n in ("vec_id", "label", "sig", "q", "angles", "norm", "anchor")}
        out = {"block": pa.array(np.full(len(rows), block, np.int64)), **out}
        out |= {n: pa.array([o[j] for o in own], _LONG) for j, n in enumerate(("own_score", "own_id", "own_sig"))}
        yield from pa.table(out).to_batches(max_chunksize=10000)

    dealt = (measured.withColumn("sig", F.xxhash64("q")).dropDuplicates(["vec_id", "label", "sig"])
             .repartitionByRange(blocks, "near", "best", "vec_id", "sig"))
    return dealt.mapInArrow(run, _PLACED)


def block_ranges(placed: DataFrame, k: int) -> DataFrame:
    """Ranges of angles and norms of each block, packed to pages."""
    low = F.array(*[F.min(F.col("angles")[i]) for i in range(k)]).cast("array<double>")
    high = F.array(*[F.max(F.col("angles")[i]) for i in range(k)]).cast("array<double>")
    each = placed.groupBy("block").agg(F.concat(F.array(F.min("norm"), F.max("norm")), low, high).alias("r"))
    return (each.withColumn("key", F.floor(F.col("block") / PAGE_BLOCKS))
            .groupBy("key").agg(F.flatten(F.collect_list(F.concat(F.array(F.col("block").cast("double")), "r"))).alias("q")))


def _to_blocks(anchors: DataFrame, pages: DataFrame, n_pages: int, salts: int, k: int, width: int, skip_own: bool) -> DataFrame:
    """The anchors, one row for each block whose ranges meet one of their windows."""
    def pack(table):
        return table.column("q").combine_chunks().flatten().to_numpy().reshape(-1, 3 + 2 * k)

    def work(table, visitors):
        p = packed(table)
        angles = matrix(visitors.column("angles"), k)
        bottom, top = score_bounds(angles, visitors.column("norm").to_numpy(), p[:, 3:3 + k], p[:, 3 + k:], p[:, 1], p[:, 2], width)
        who, which = np.nonzero(overlapping(bottom, top, _window_matrix(visitors.column("windows"), len(visitors))))
        for i in range(0, len(who), 4096):
            rows = visitors.take(pa.array(who[i:i + 4096]))
            block = pa.array(p[which[i:i + 4096], 0].astype(np.int64))
            yield pa.table({"block": block, **{n: rows.column(n) for n in names}})

    names = ["vec_id", "label", "sig", "q", "angles", "norm", "home", "windows"]
    packed = Once(pack)
    holders = pages.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    visitors = (anchors.withColumn("salt", F.pmod(F.xxhash64("vec_id", "sig"), F.lit(salts)).cast("long"))
                .withColumn("key", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_pages - 1).cast("long")))))
    found = meet(holders, visitors.withColumnRenamed("block", "home"), work,
                 "block long, vec_id long, label long, sig long, q array<double>, "
                 "angles array<double>, norm double, home long, windows array<double>", SLICE)
    if skip_own:
        found = found.where("block <> home")
    return found.withColumnRenamed("block", "key")


def _search(placed: DataFrame, to_blocks: DataFrame, k: int, width: int, same_label: bool, best: int, salts: int) -> DataFrame:
    """For each visiting anchor and window: the first ``best`` rows of the block
    whose score lies in the window, of the anchor's label or of the others."""
    def work(table, visitors):
        b = block(table)
        a = Block(visitors)
        windows = _window_matrix(visitors.column("windows"), len(visitors))
        bottom, top = score_bounds(a.angles, a.norms, b.angles, b.angles, b.norms, b.norms, width)
        hit = overlapping(bottom, top, windows)
        hit &= (a.labels[:, None] == b.labels[None, :]) == same_label
        if same_label:      # an anchor is no positive of its own
            hit &= ~((a.ids[:, None] == b.ids[None, :]) & (a.sigs[:, None] == b.sigs[None, :]))
        out = []
        for i in range(len(a.ids)):
            at = np.flatnonzero(hit[i])
            if not len(at):
                continue
            score = b.scores(at, a.q[i])
            for j in range(0, windows.shape[1], 2):
                inside = (score >= windows[i, j]) & (score <= windows[i, j + 1])
                if inside.any():
                    order, place, s = b.best(at[inside], score[inside], best)
                    out.append((i, j // 2, place[order], s[order]))
        if out:
            n = [len(o[2]) for o in out]
            who = np.repeat([o[0] for o in out], n)
            which = np.concatenate([o[2] for o in out])
            yield pa.table({"anchor_id": a.ids[who], "anchor_label": a.labels[who], "anchor_sig": a.sigs[who],
                            "window": np.repeat([o[1] for o in out], n).astype(np.int32),
                            "found_id": b.ids[which], "found_sig": b.sigs[which],
                            "score": np.concatenate([o[3] for o in out])})

    block = Once(Block)
    holders = (placed.select(F.col("block").alias("key"), "vec_id", "label", "sig", "q", "angles", "norm")
               .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))))
    visitors = to_blocks.withColumn("salt", F.pmod(F.xxhash64("vec_id", "sig"), F.lit(salts)).cast("long"))
    return meet(holders, visitors, work, "anchor_id long, anchor_label long, anchor_sig long, window int, "
                                         "found_id long, found_sig long, score long", SLICE)


def mine(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         scale: int = 256, references: int = 8, vec_id: str = "vec_id", label: str = "label",
         vector: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` tells which rows are anchors.  Entries become floor(scale * x);
    a score is the integer inner product with the anchor (shorter vectors are
    filled up with zeros; a score beyond 64 bits is held to them).  An anchor's
    positives are its first ``positives`` other rows of the same label; for each,
    the first ``negatives`` rows of other labels with low * positive_score <=
    100 * negative_score <= high * positive_score.  Higher scores come first,
    ties by smaller vec_id, then by content.

    Rows with a null vec_id, label or vector, or null or non-finite entries, take
    no part.  Rows equal in vec_id, label and entries are one row; those of equal
    vec_id and other content are rows of their own.  An empty table gives an empty
    result; other columns are not read."""
    spark = rows.sparkSession
    ready(spark)
    clean = rows.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & usable(vector)).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
        F.col(vector).cast("array<double>").alias("v"), F.coalesce(anchors, F.lit(False)).alias("anchor"))
    refs = directions(clean, references, scale)
    k = len(refs)
    count, width = clean.agg(F.count("*"), F.max(F.size("v"))).first()
    width = max(width or 0, 1)
    blocks = max(1, math.ceil(count / BLOCK_ROWS))
    placed = stored(place(measure(clean, refs, scale, width), blocks, positives), "placed-vectors")
    pages = stored(block_ranges(placed, k), "block-ranges")
    n_pages = (pages.agg(F.max("key")).first()[0] or 0) + 1
    salts = max(1, math.ceil(int(spark.conf.get("spark.sql.shuffle.partitions")) / max(n_pages, 1)))
    share = max(1, math.ceil(salts / 4 / blocks))   # few blocks: several tasks hold the same one
    mine_ = placed.where("anchor")
    who = ["anchor_id", "anchor_label", "anchor_sig"]

    def first(df, keys, k):
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), "found_id", "found_sig")
        return df.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)

    floor = F.when(F.size("own_score") >= positives, F.element_at("own_score", positives).cast("double")).otherwise(F.lit(float("-inf")))
    wide = mine_.withColumn("windows", F.array(floor, F.lit(float("inf"))))
    visits = _to_blocks(wide, pages, n_pages, salts, k, width, True)
    own = mine_.select(F.col("vec_id").alias("anchor_id"), F.col("label").alias("anchor_label"), F.col("sig").alias("anchor_sig"),
                       F.inline(F.arrays_zip(F.col("own_id").alias("found_id"), F.col("own_sig").alias("found_sig"),
                                             F.col("own_score").alias("score"))))
    near = stored(first(_search(placed, visits, k, width, True, positives, share).drop("window").unionByName(own), who, positives),
                  "positives")

    # the window of a score s: whole numbers from low * s / 100 to high * s / 100
    s = F.col("score").cast("decimal(38,0)")
    least = F.ceil(s * low / 100).cast("double")
    most = F.floor(s * high / 100).cast("double")
    listed = near.groupBy(*who).agg(F.sort_array(F.collect_list(F.struct("place", least.alias("a"), most.alias("b")))).alias("w"))
    listed = listed.select(F.col("anchor_id").alias("vec_id"), F.col("anchor_label").alias("label"), F.col("anchor_sig").alias("sig"),
                           F.flatten(F.transform("w", lambda x: F.array(x["a"], x["b"]))).alias("windows"))
    visits = _to_blocks(mine_.join(listed, ["vec_id", "label", "sig"]), pages, n_pages, salts, k, width, False)
    found = first(_search(placed, visits, k, width, False, negatives, share), [*who, "window"], negatives)
    pos = near.select(*who, (F.col("place") - 1).alias("window"), F.col("found_id").alias("positive_id"),
                      F.col("score").alias("positive_score"))
    return (found.join(pos, [*who, "window"])
            .select("anchor_id", "positive_id", F.col("place").cast("int").alias("rank"),
                    F.col("found_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
