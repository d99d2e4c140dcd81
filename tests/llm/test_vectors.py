"""Hard negatives and whitening against brute force, on tables with nulls, ties,
repeated rows, vectors of several lengths, clashing column names, and none at all."""

import numpy as np
import pytest
from cohortlake.llm import hard_negatives, whitening
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int, block int, q string, x double, `window` string"
EXTRA = (1, "q", 2.0, "w")


def vectors(n, d, seed, kinds=4, spread=0.6):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(kinds, d))
    return [(i, (centres[i % kinds] + spread * r.normal(size=d)).astype(np.float32).tolist(), int(r.integers(3)))
            for i in range(n)]


@pytest.fixture(scope="module")
def rows():
    out = vectors(300, 6, 3)
    out += [(300 + i, [1.0, 0.5, 0.0, 0.0, -0.25, 2.0], i % 3) for i in range(40)]     # one vector, many rows
    out += [(350, [0.0] * 6, 1), (400, [], 2), (401, [1.0, 2.0], 0), (402, None, 1), (403, [1.0, None], 1),
            (404, [float("nan")] * 6, 1), (405, [float("inf")] + [0.0] * 5, 1), (406, [1.0] * 6, None), (None, [1.0] * 6, 1)]
    out += [out[0], out[0], (50, [3.0] * 6, 2), (407, [3e30, -2e30, 0.0, 0.0, 0.0, 0.0], 1), (408, [1.0] * 9, 0)]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)


def usable(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


def hard_by_force(rows, scale=256):
    """Whole-number products of all pairs; rows equal in all three columns are one."""
    held = {}
    for i, v, l in rows:
        if i is not None and l is not None and usable(v):
            held[(i, l, tuple(int(np.floor(np.float64(np.float32(x)) * scale)) for x in v))] = None
    clip = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    out = []
    for a in held:
        if a[0] % 50:
            continue
        s = [(clip(sum(x * y for x, y in zip(a[2], b[2]))), b) for b in held if b != a]
        s.sort(key=lambda t: (-t[0], t[1][0]))
        for score, p in [t for t in s if t[1][1] == a[1]][:5]:
            fit = [t for t in s if t[1][1] != a[1] and 50 * score <= 100 * t[0] <= 95 * score][:3]
            out += [(a[0], p[0], k + 1, n[0], score, sc) for k, (sc, n) in enumerate(fit)]
    return sorted(out)


def hard(df, **kw):
    return sorted(tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % 50 == 0, **kw).collect())


@pytest.mark.parametrize("block_rows,page", [(16384, 512), (40, 2)])
def test_hard_negatives(spark, rows, monkeypatch, block_rows, page):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(hard_negatives, "PAGE_BLOCKS", page)
    want = hard_by_force(rows)
    assert len(want) > 50
    assert hard(frame(spark, rows)) == want


def test_hard_negatives_without_rows(spark, rows):
    assert hard(frame(spark, [])) == []
    assert hard(frame(spark, [(50, [1.0, 2.0], 1)])) == []
    assert hard(frame(spark, [(0, [0.0] * 3, 1), (1, [0.0] * 3, 1), (2, [0.0] * 3, 2)])) == [(0, 1, 1, 2, 0, 0)]


def test_score_bounds_hold():
    r = np.random.default_rng(1)
    for d in (2, 3, 64):
        x = np.floor(256 * np.concatenate([r.normal(size=(80, d)), np.repeat(r.normal(size=(1, d)), 20, 0), np.zeros((2, d))]))
        x = np.concatenate([x, -x[:5], 3 * x[:5]])
        refs = x[:4] / np.linalg.norm(x[:4], axis=1)[:, None]
        norm = np.linalg.norm(x, axis=1)
        angles = np.where(norm[:, None] > 0, np.arccos(np.clip(x @ refs.T / np.maximum(norm, 1e-9)[:, None], -1, 1)), np.pi / 2)
        low, high = hard_negatives.score_bounds(angles, norm, angles, angles, norm, norm, d)
        assert (low <= x @ x.T).all() and (x @ x.T <= high).all()


def test_few_pairs_are_scored_where_angles_tell(spark, monkeypatch):
    """Tight clusters: the windows leave most rows unscored."""
    close = vectors(400, 6, 9, kinds=8, spread=0.02)
    x = np.floor(256 * np.array([v for _, v, _ in close], np.float32).astype(float))
    norm = np.linalg.norm(x, axis=1)
    refs = x[:8] / norm[:8, None]
    angles = np.arccos(np.clip(x @ refs.T / norm[:, None], -1, 1))
    low, high = hard_negatives.score_bounds(angles[:50], norm[:50], angles, angles, norm, norm, 6)
    fifth = np.sort(x[:50] @ x.T, axis=1)[:, -6]
    opened = hard_negatives.overlapping(low, high, np.stack([fifth, np.full(50, np.inf)], 1))
    assert opened.mean() < 0.35
    assert hard(frame(spark, close)) == hard_by_force(close)


def whitened(spark, rows, **kw):
    df, model = whitening.whiten(frame(spark, rows), **kw)
    return df.collect(), model


def white_by_force(rows, components=16):
    use = [(i, v) for i, v, _ in rows if usable(v)]
    d = max(len(v) for _, v in use)
    x = [[int(np.floor(64 * float(np.float32(c)))) + 1000000 for c in v] + [1000000] * (d - len(v)) for _, v in use]
    u = sorted(set(map(tuple, x)))
    n, s = len(u), [sum(c) for c in zip(*u)]
    a = np.array([[v - t // n - (t % n) / n for v, t in zip(r, s)] for r in u], float)
    values, vectors_ = np.linalg.eigh(a.T @ a / n)
    trace = values.sum()
    values, vectors_ = values[::-1][:components], vectors_[:, ::-1][:, :components]
    keep = values > 1e-9 * max(trace, 1e-300)
    b = np.array([[v - t // n - (t % n) / n for v, t in zip(r, s)] for r in x], float)
    return (use, n, [sum((n * v - t) ** 2 for v, t in zip(r, s)) for r in x],
            b @ vectors_[:, keep] / np.sqrt(values[keep]), values[keep] / trace)


@pytest.mark.parametrize("seed", [1, 2])
def test_whitening(spark, rows, seed):
    plain = [r for r in rows if r[0] != 407] if seed == 1 else vectors(60, 24, seed)
    use, n, deviation, white, share = white_by_force(plain)
    got, model = whitened(spark, plain)
    assert model.n == n and len(got) == len(use)
    assert np.allclose(model.values / model.trace, share, rtol=1e-9)
    assert model.identity_error < 1e-9
    key = lambda i, dev, w: (-1 if i is None else i, dev, np.round(np.abs(w), 6).tolist())
    have = sorted((r for r in got), key=lambda r: key(r["vec_id"], r["deviation"], np.array(r["whitened"])))
    want = sorted(zip([i for i, _ in use], deviation, white), key=lambda r: key(*r))
    assert [(r["vec_id"], r["deviation"]) for r in have] == [(i, dev) for i, dev, _ in want]
    a, b = np.array([r["whitened"] for r in have]), np.array([w for _, _, w in want])
    assert np.allclose(a * np.sign((a * b).sum(0)), b, atol=1e-8)


def test_whitening_equal_values_and_flat_data(spark):
    """Components of equal spread are all found; directions without spread give none."""
    cross = []
    for i in range(4):
        for s in (1.0, -1.0):
            v = [0.0] * 6
            v[i] = s
            cross.append((len(cross), v, 0))
    got, model = whitened(spark, cross)
    assert np.allclose(model.values, [1024.0] * 4) and model.identity_error < 1e-9
    assert whitened(spark, [(1, [2.0, 3.0], 0), (1, [2.0, 3.0], 0)])[0][0]["whitened"] == []
    assert whitened(spark, [])[0] == []
    assert whitened(spark, [(1, [], 0)])[0][0]["deviation"] == 0


def test_whitening_large_entries(spark):
    """Squares beyond 64 bits become null; nothing wraps round."""
    got, model = whitened(spark, [(1, [3e30, 0.0], 0), (2, [-3e30, 1.0], 0), (3, [0.0, 2.0], 0)])
    assert [r["deviation"] for r in sorted(got, key=lambda r: r["vec_id"])][:2] == [None, None]
    assert model.n == 3 and np.isfinite(model.values).all()
