"""Volumes slab by slab against the whole volume."""

import io
import os
import tracemalloc

import numpy as np
import pytest

from cohortlake.operators.tensors import volume_slabs
from cohortlake.sources import nifti


@pytest.mark.parametrize("shape", [(5,), (4, 3), (3, 4, 5), (2, 3, 4, 2), (1, 1, 7)])
@pytest.mark.parametrize("kw", [{}, {"compress": False}, {"version": 2, "big_endian": True}, {"slope": 2.0, "inter": -1.5, "big_endian": True}])
def test_slabs_make_the_volume(shape, kw, monkeypatch):
    monkeypatch.setattr(nifti, "BLOCK_BYTES", 24)
    vol = np.random.default_rng(3).integers(-500, 500, shape).astype(np.int16)
    data = nifti.encode(vol, **kw)
    whole = nifti.to_tensor(nifti.decode(data))
    assert nifti.read_shape(io.BytesIO(data)) == shape
    for width in (1, 2, 7):
        got = [nifti.read_slab(io.BytesIO(data), x, width) for x in range(0, shape[0], width)]
        np.testing.assert_array_equal(np.concatenate(got), whole)


def test_errors():
    good = nifti.encode(np.zeros((3, 3), np.float32), compress=False)
    with pytest.raises(ValueError, match="last voxel"):
        nifti.read_slab(io.BytesIO(good[:-4]), 0, 1)
    with pytest.raises(ValueError, match="first voxel"):
        nifti.read_slab(io.BytesIO(good[:350]), 0, 1)
    with pytest.raises(ValueError):
        nifti.read_shape(io.BytesIO(b"short"))


def test_memory_follows_the_slab_not_the_volume():
    """A volume of 64 MB in slabs of 2 MB."""
    vol = np.zeros((64, 512, 512), np.float32)
    vol[:, 0, 0] = np.arange(64) * 255
    data = nifti.encode(vol)
    del vol
    width = nifti.slab_width((64, 512, 512), 2 << 20)
    assert width == 2
    tracemalloc.start()
    slab = nifti.read_slab(io.BytesIO(data), 10, width)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert slab[0] == 10 and slab[512 * 512] == 11 and peak < 24 << 20


def test_job(spark, tmp_dir):
    rows, whole = [], {}
    for i, shape in enumerate([(6, 5, 4), (3, 2), (1, 8)]):
        vol = np.random.default_rng(i).random(shape).astype(np.float32)
        p = os.path.join(tmp_dir, f"v{i}.nii.gz")
        with open(p, "wb") as f:
            f.write(nifti.encode(vol))
        rows.append((p, "cn", i))
        whole[i] = nifti.to_tensor(vol.astype(np.float64))
    df = spark.createDataFrame(rows, "path string, dx string, id long")
    got = volume_slabs(df, buffer_bytes=170, keep=["id"]).collect()
    assert sorted((r["id"], r["slab"]) for r in got) == [(0, 0), (0, 1), (0, 2), (1, 0), (2, 0)]
    for i, v in whole.items():
        parts = sorted((r["start"], r["raw"]) for r in got if r["id"] == i)
        assert [s for s, _ in parts] == np.cumsum([0] + [len(r) for _, r in parts[:-1]]).tolist()
        np.testing.assert_array_equal(np.concatenate([np.array(r, np.float32) for _, r in parts]), v)
    assert volume_slabs(df.limit(0)).count() == 0
