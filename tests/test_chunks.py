"""Numbered tensor files: exact rows, complete commits, nothing left by a failed job."""

import glob
import os

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cohortlake.sinks import chunks
from cohortlake.sources import nifti


@pytest.fixture(scope="module")
def volumes(tmp_path_factory):
    d = tmp_path_factory.mktemp("run-vols")
    out = []
    for i in range(30):
        p = str(d / f"v{i}.nii")
        with open(p, "wb") as f:
            f.write(nifti.encode(np.full((1, 2, 2), 255.0 * i, np.float32)))
        out.append((p, f"d{i % 3}", (i * 7) % 30, "train" if i % 3 else "test"))
    return out


def paths(spark, volumes):
    return spark.createDataFrame(volumes, "path string, dx string, place long, split string")


def test_files_hold_their_rows_in_order(spark, volumes, tmp_dir):
    out = os.path.join(tmp_dir, "t")
    chunks.write_tensor_chunks(paths(spark, volumes), out, ["place"], rows_per_chunk=8, num_partitions=3)
    files = sorted(os.path.basename(f) for f in glob.glob(out + "/*"))
    assert files == [f"chunk_{i}.parquet" for i in range(4)]
    order = sorted(volumes, key=lambda v: v[2])
    for i in range(4):
        t = pq.read_table(f"{out}/chunk_{i}.parquet")
        assert t.schema.equals(chunks.FILE_SCHEMA)
        want = order[8 * i:8 * i + 8]
        assert [r[0] for r in t.column("raw").to_pylist()] == [float(os.path.basename(v[0])[1:-4]) for v in want]
        assert t.column("dx").to_pylist() == [v[1] for v in want]
        assert pq.ParquetFile(f"{out}/chunk_{i}.parquet").metadata.row_group(0).column(0).compression == "ZSTD"
    got = chunks.read_tensor_chunks(spark, out).select("chunk", "row").collect()
    assert sorted(map(tuple, got)) == [(p // 8, p % 8) for p in range(30)]


def test_splits_are_numbered_on_their_own_and_overwritten(spark, volumes, tmp_dir):
    out = os.path.join(tmp_dir, "t")
    chunks.write_tensor_chunks(paths(spark, volumes), out, ["place"], 4)
    chunks.write_tensor_chunks(paths(spark, volumes), out, ["place"], 6, split_col="split")
    files = sorted(os.path.relpath(f, out) for f in glob.glob(out + "/**/*.parquet", recursive=True))
    assert files == [f"split=test/chunk_{i}.parquet" for i in range(2)] + [f"split=train/chunk_{i}.parquet" for i in range(4)]
    assert chunks.read_tensor_chunks(spark, out).groupBy("split").count().count() == 2
    with pytest.raises(Exception, match="FileExists|already exists"):
        chunks.write_tensor_chunks(paths(spark, volumes), out, ["place"], 4, mode="append")
    assert len(glob.glob(out + "/**/*.parquet", recursive=True)) == 6 and not glob.glob(out + ".staging*")


def test_a_failing_volume_leaves_nothing(spark, volumes, tmp_dir):
    out = os.path.join(tmp_dir, "t")
    bad = paths(spark, volumes).withColumn("path", F.when(F.col("place") == 9, F.lit("/nowhere")).otherwise(F.col("path")))
    with pytest.raises(Exception, match="nowhere"):
        chunks.write_tensor_chunks(bad, out, ["place"], 8)
    assert not glob.glob(out + "*")


def batch(positions):
    n = len(positions)
    return pa.RecordBatch.from_pydict({"raw": pa.array([[1.0]] * n, pa.list_(pa.float32())), "dx": ["a"] * n,
                                       "folder": [""] * n, "pos": pa.array(positions, pa.int64())})


def test_a_repeated_task_changes_nothing(tmp_dir):
    """Two attempts of one task, one of them broken off, then the commit."""
    w = chunks.ChunkWriter(os.path.join(tmp_dir, "t"), 2, True)

    def broken():
        yield batch([0, 1, 2])
        raise RuntimeError("executor lost")

    with pytest.raises(RuntimeError):
        w.write(broken())
    first, second = w.write(iter([batch([0, 1, 2]), batch([3])])), w.write(iter([batch([0, 1, 2, 3])]))
    assert first == second
    w.commit([second, w.write(iter([batch([4])])), None])
    assert sorted(os.listdir(os.path.join(tmp_dir, "t"))) == ["chunk_0.parquet", "chunk_1.parquet", "chunk_2.parquet"]


def test_incomplete_chunks_are_refused(tmp_dir):
    w = chunks.ChunkWriter(os.path.join(tmp_dir, "t"), 2, True)
    with pytest.raises(ValueError, match="row 3"):
        w.write(iter([batch([0, 1, 3])]))
    with pytest.raises(ValueError, match="not complete"):
        w.commit([w.write(iter([batch([0, 1])])), w.write(iter([batch([4])]))])


def test_no_rows(spark, tmp_dir):
    df = spark.createDataFrame([], "path string, dx string, place long")
    chunks.write_tensor_chunks(df, os.path.join(tmp_dir, "t"), ["place"])
    assert os.listdir(os.path.join(tmp_dir, "t")) == []
