"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

The centred matrix X (one row for each distinct vector) is never gathered.  A
step makes one distributed pass: every row gives t = x.p, and the pass sums
Xᵀt, t.t and Uᵀt.  A left vector u is X p for a p that the driver holds, so its
entries are made again from the rows in each pass; nothing has to be kept on the
executors, and a lost one costs only its tasks.  Both bases are reorthogonalised
in full, twice: right vectors on the driver, left ones by their inner products
(first from the sums Xᵀu already known, then as measured in the pass).  The
driver holds vectors of the embedding's dimension only, whatever the row count.

The entries are integers: sums are exact, and a row is centred by an integer
before the fraction is taken off, so a large common offset costs no precision.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import ready, stored
from cohortlake.llm.vectors import lists, matrix, usable

#: Singular values below this part of the norm of X count as none.
NOTHING = 1e-11
#: Entries beyond this are set to it (they would not fit a long).
LARGEST = float(1 << 61)


@dataclass
class Whitening:
    """What the rows of the fit list told: count, exact sums, and the components
    (columns) with their eigenvalues, falling."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float | None = None
    middle: np.ndarray = field(init=False)
    rest: np.ndarray = field(init=False)

    def __post_init__(self):
        whole = [s // self.n if self.n else 0 for s in self.sums]
        self.middle = np.array(whole, np.int64)
        self.rest = np.array([(s - self.n * w) / max(self.n, 1) for s, w in zip(self.sums, whole)])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.middle) - self.rest

    def deviations(self, x: np.ndarray) -> list:
        """Sum of (n x - S) squared of each row, exact (None beyond 64 bits)."""
        near = x - self.middle
        off = [s - self.n * int(w) for s, w in zip(self.sums, self.middle)]
        most = self.n * (int(np.abs(near).max(initial=0)) + 1)
        if len(off) * most * most < 1 << 63:
            return (np.square(near * self.n - np.array(off, np.int64))).sum(1).tolist()
        found = [sum((self.n * v - o) ** 2 for v, o in zip(row, off)) for row in near.tolist()]
        return [v if v < 1 << 63 else None for v in found]


def entries(df: DataFrame, scale: int, offset: int, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, x): floor(scale * c) + offset of each entry, as longs; a vector
    shorter than the longest one is filled up with zeros."""
    rows = df.where(usable(vector)).select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("c"))
    width = rows.agg(F.max(F.size("c"))).first()[0] or 0
    full = F.concat("c", F.array_repeat(F.lit(0.0), F.lit(width) - F.size("c")))
    near = lambda c: F.least(F.greatest(c * scale, F.lit(-LARGEST)), F.lit(LARGEST))
    return rows.select("vec_id", F.transform(full, lambda c: F.floor(near(c)).cast("long") + F.lit(offset)).alias("x"))


def _summed(fit: DataFrame, width: int, make) -> np.ndarray:
    """Sums over all rows of what ``make`` adds up for a batch (``width`` numbers)."""
    def run(batches):
        total = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                total += make(matrix(batch.column(0), dtype=np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(total)], ["at", "v"])

    out = np.zeros(width)
    for at, v in fit.mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v")).collect():
        out[at] = v
    return out


def _exact_sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """Rows, and the sum of each dimension as whole numbers of any size."""
    def run(batches):
        for batch in batches:
            x = matrix(batch.column(0), dtype=np.int64)
            high, low = (x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)
            n = np.full(width + 1, len(x), np.int64)
            n[:width] = 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(width + 1, dtype=np.int32)), pa.array(np.append(high, 0)),
                 pa.array(np.append(low, 0)), pa.array(n)], ["at", "high", "low", "n"])

    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low", "n")]
    rows = fit.mapInArrow(run, "at int, high long, low long, n long").groupBy("at").agg(*wide).collect()
    at = {r["at"]: r for r in rows}
    if not at:
        return 0, [0] * width
    return int(at[width]["n"]), [(int(at[i]["high"]) << 32) + int(at[i]["low"]) for i in range(width)]


def _away(w: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """``w`` without its parts along the basis."""
    if basis:
        q = np.array(basis)
        for _ in range(2):
            w = w - q.T @ (q @ w)
    return w


def bidiagonalise(fit: DataFrame, model: Whitening, wanted: int, steps: int):
    """Right singular vectors and singular values of the centred fit list, largest
    first.  Runs until the right basis is full, or after ``steps`` steps as soon as
    the residuals of the ``wanted`` largest are below 1e-14 of the greatest.  Where
    the space of the start vector is used up, a new start vector goes on, so equal
    singular values are all found."""
    d = len(model.sums)
    size = np.sqrt(max(model.trace * model.n, 0.0))
    draw = np.random.default_rng(7)
    right, left, back, cells = [], [], [], {}     # v, p with u = X p, Xᵀu, entries of B

    def fresh() -> bool:
        if len(right) == d:
            return False
        w = _away(draw.standard_normal(d), right)
        right.append(w / np.linalg.norm(w))
        return True

    def product(p):
        made = np.array([*left, p]).T

        def sums(x):
            c = model.centred(x)
            t = c @ made
            last = t[:, -1]
            return np.concatenate([c.T @ last, t.T @ last])
        return _summed(fit, d + len(left) + 1, sums)

    def small():
        b = np.zeros((len(left), len(right)))
        for (i, j), v in cells.items():
            b[i, j] = v
        return np.linalg.svd(b, full_matrices=False)

    begun = size > 0 and fresh()                  # this vector starts a new space
    at, new = 0, True
    while begun and at < len(right):
        p = right[at].copy()
        if left:
            p -= np.array(left).T @ (np.array(back) @ p)
        got = product(p)
        xt, measured, norm2 = got[:d], got[d:-1], got[-1]
        if left:
            p -= np.array(left).T @ measured
            xt = xt - np.array(back).T @ measured
            norm2 -= measured @ measured
        alpha = np.sqrt(max(norm2, 0.0))
        at += 1
        if alpha <= NOTHING * size:               # X v lies in the left basis already
            if new or not fresh():
                break
            new = True
            continue
        left.append(p / alpha)
        back.append(xt / alpha)
        cells[len(left) - 1, at - 1] = alpha
        if len(right) == d:
            break
        w = _away(back[-1] - alpha * right[at - 1], right)
        beta = np.linalg.norm(w)
        if beta <= NOTHING * size:
            new = fresh()
            continue
        if len(right) >= max(steps, 2 * wanted):
            l, s, _ = small()
            if (np.abs(beta * l[-1, :wanted]) <= 1e-14 * s[0]).all():
                break
        new = False
        right.append(w / beta)
        cells[len(left) - 1, len(right) - 1] = beta
    if not left:
        return np.zeros((d, 0)), np.zeros(0)
    _, s, r = small()
    keep = np.flatnonzero(s > NOTHING * size)[:wanted]
    return np.array(right).T @ r[keep].T, s[keep]


def fit_whitening(rows: DataFrame, components: int = 16, steps: int = 512) -> Whitening:
    """The components of ``rows(x)``, each distinct x counted once."""
    ready(rows.sparkSession)
    fit = stored(rows.select("x").distinct(), "fit-list").persist(StorageLevel.MEMORY_AND_DISK)
    width = fit.agg(F.max(F.size("x"))).first()[0] or 0
    n, sums = _exact_sums(fit, width)
    model = Whitening(n, sums, np.zeros((width, 0)), np.zeros(0), 0.0)
    if n:
        model.trace = float(_summed(fit, 1, lambda x: np.square(model.centred(x)).sum())[0]) / n
        c, s = bidiagonalise(fit, model, components, steps)
        lead = np.abs(c).argmax(0) if c.size else np.zeros(0, int)
        model.components = c * np.where(c[lead, np.arange(c.shape[1])] < 0, -1.0, 1.0)
        model.values = s * s / n
    k = len(model.values)
    if k:
        def moments(x):
            w = model.centred(x) @ model.components / np.sqrt(model.values)
            return np.concatenate([w.sum(0), (w.T @ w).ravel()])
        got = _summed(fit, k + k * k, moments) / n
        cov = got[k:].reshape(k, k) - np.outer(got[:k], got[:k])
        model.identity_error = float(np.abs(cov - np.eye(k)).max())
    fit.unpersist()
    return model


def whiten(df: DataFrame, components: int = 16, scale: int = 64, offset: int = 1_000_000, steps: int = 512,
           vec_id: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, Whitening]:
    """(vec_id, whitened, deviation) of each row with a usable vector, and the model.

    whitened: the centred entries projected on each component, over the root of
    its eigenvalue; deviation: sum of (n x - S) squared (null beyond 64 bits).
    Rows with a null vector, or null or non-finite entries, are left out; a shorter
    vector is filled up with zeros, an empty one too; entries beyond 2**61 are set
    to that.  Repeated rows stay, but count once in the fit; a null vec_id stays
    null.  There are as many components as the fit list has dimensions of any
    spread, ``components`` at most: none for an empty table or equal vectors.
    Other columns are not read."""
    ready(df.sparkSession)
    rows = entries(df, scale, offset, vec_id, vector)
    model = fit_whitening(rows, components, steps)

    def run(batches):
        for batch in batches:
            x = matrix(batch.column(1), len(model.sums), np.int64)
            w = model.centred(x) @ model.components / np.sqrt(model.values)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), lists(w, pa.float64()), pa.array(model.deviations(x), pa.int64())],
                ["vec_id", "whitened", "deviation"])

    kind = df.schema[vec_id].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id {kind}, whitened array<double>, deviation long"), model
