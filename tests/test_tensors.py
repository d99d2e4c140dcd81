"""Volumes and tensors: NIfTI fixtures written here, T1/T2, the U1 job."""

import glob
import os

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cohortlake.functions import tensor
from cohortlake.operators.tensors import volumes_to_tensors
from cohortlake.sinks import write_tensors
from cohortlake.sources import nifti


@pytest.mark.parametrize("big_endian", [False, True])
@pytest.mark.parametrize("compress", [False, True])
def test_nifti_roundtrip_scaled_int16(tmp_dir, big_endian, compress):
    vol = np.arange(3 * 4 * 5, dtype=np.int16).reshape(3, 4, 5)
    data = nifti.encode(vol, slope=2.0, inter=1.0, big_endian=big_endian, compress=compress)
    got = nifti.decode(data)
    assert got.shape == (3, 4, 5) and got.dtype == np.float64
    np.testing.assert_array_equal(got, vol.astype(np.float64) * 2 + 1)


@pytest.mark.parametrize("big_endian", [False, True])
def test_nifti2_roundtrip(big_endian):
    vol = np.arange(2 * 3 * 4, dtype=np.float64).reshape(2, 3, 4) / 7
    got = nifti.decode(nifti.encode(vol, slope=0.5, inter=-1.0, big_endian=big_endian, version=2))
    np.testing.assert_array_equal(got, vol * 0.5 - 1.0)


def test_nifti_float32_unscaled(tmp_dir):
    vol = np.random.default_rng(0).random((2, 3, 4)).astype(np.float32)
    got = nifti.decode(nifti.encode(vol, slope=0.0))
    np.testing.assert_array_equal(got, vol.astype(np.float64))


def test_nifti_rejects_garbage():
    with pytest.raises(ValueError):
        nifti.decode(b"\x00" * 400)


@pytest.mark.parametrize("shape", [(10, 10, 10), (20, 20, 20)])
def test_process_scan_shape_dtype(shape):
    vol = np.random.default_rng(1).random(shape)
    t = nifti.to_tensor(vol)
    assert t.dtype == np.float32 and t.shape == (int(np.prod(shape)),)
    assert np.all((t >= 0) & (t <= 1 / 255 + 1e-7))
    np.testing.assert_array_equal(t, (np.expand_dims(vol, -1).astype(np.float32) / np.float32(255)).reshape(-1))


def test_scaling_does_not_clip():
    t = nifti.to_tensor(np.full((2, 2, 2), 510.0))
    assert np.all(t == np.float32(2.0))


def test_flatten_matches_numpy(spark):
    a3 = np.arange(1, 9).reshape(2, 2, 2)
    a2 = np.arange(1, 7).reshape(2, 3)
    df = spark.createDataFrame([(a3.tolist(), a2.tolist())], "a array<array<array<int>>>, b array<array<int>>")
    r = df.select(tensor.flatten_c_order(tensor.flatten_c_order("a")).alias("a"),
                  tensor.flatten_c_order("b").alias("b")).first()
    assert r["a"] == a3.flatten().tolist() and r["b"] == a2.flatten().tolist()


def test_scale_voxels_equals_numpy_float32(spark):
    vals = np.random.default_rng(2).random(64).astype(np.float32) * 300
    df = spark.createDataFrame([(vals.tolist(),)], "a array<float>")
    got = np.array(df.select(tensor.scale_voxels("a")).first()[0], dtype=np.float32)
    np.testing.assert_array_equal(got, vals / np.float32(255.0))


def write_volumes(tmp_dir, n=5):
    rows = []
    rng = np.random.default_rng(3)
    for i in range(n):
        vol = (rng.random((3, 4, 5)) * 400).astype(np.float32)
        p = os.path.join(tmp_dir, f"v{i}.nii" + (".gz" if i % 2 else ""))
        with open(p, "wb") as f:
            f.write(nifti.encode(vol, big_endian=bool(i % 3 == 0), compress=bool(i % 2)))
        rows.append((p, "cn" if i % 2 else "mci", vol))
    return rows


def test_volume_job(spark, tmp_dir):
    rows = write_volumes(tmp_dir)
    paths = spark.createDataFrame([(p, dx) for p, dx, _ in rows], "path string, dx string")
    out = volumes_to_tensors(paths, num_partitions=3, keep=["path"], with_shape=True).collect()
    by_path = {r["path"]: r for r in out}
    for p, dx, vol in rows:
        r = by_path[p]
        assert r["dx"] == dx and r["shape"] == [3, 4, 5, 1]
        np.testing.assert_array_equal(np.array(r["raw"], dtype=np.float32), nifti.to_tensor(vol))


def test_volume_job_errors(spark, tmp_dir):
    bad = os.path.join(tmp_dir, "bad.nii")
    with open(bad, "wb") as f:
        f.write(b"not a volume")
    paths = spark.createDataFrame([(bad, "cn")], "path string, dx string")
    rep = volumes_to_tensors(paths, on_error="report").first()
    assert rep["raw"] is None and rep["error"]
    with pytest.raises(Exception):
        volumes_to_tensors(paths).collect()


def test_tensor_files_at_most_128_rows(spark, tmp_dir):
    df = spark.range(300).select(F.array(F.col("id").cast("float")).alias("raw"),
                                 F.lit("cn").alias("dx")).coalesce(1)
    out = os.path.join(tmp_dir, "t")
    write_tensors(df, out)
    files = sorted(glob.glob(os.path.join(out, "*.parquet")))
    sizes = sorted(pq.read_metadata(f).num_rows for f in files)
    assert sizes == [44, 128, 128]
    assert all("zstd" in f for f in files)
