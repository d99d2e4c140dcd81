"""Waves of decoding against reading every file."""

import random

import pytest
from pyspark.sql import functions as F

from cohortlake.operators import elements, waves


def decode_by(bad):
    """Files named in ``bad`` are unreadable, those that end in 0 hold nothing."""
    def decode(paths):
        p = F.col("path")
        return (paths.where(~p.endswith("0")).select(p.alias("file_path"), F.concat(F.lit("v"), p).alias("value"),
                                                     F.when(p.isin(bad), F.lit("broken")).alias("error")))
    return decode


@pytest.mark.parametrize("k", [1, 3, 5])
def test_same_as_reading_all(spark, k):
    r = random.Random(k)
    rows = [(f"d{i % 6}", f"f{i:04d}", f"d{i % 6}/f{i:04d}") for i in range(300)]
    rows += [("all_bad", f"f{i:04d}", f"all_bad/f{i:04d}") for i in range(40)] + [("one", "x", "one/x")]
    bad = [p for d, _, p in rows if not p.endswith("0") and (d == "all_bad" or r.random() < 0.5)]
    files = spark.createDataFrame(rows, "dir string, name string, path string")
    status, read, tried = waves.read_first_files(files, decode_by(bad), k)
    whole = elements.first_files_per_dir(files.withColumn("ok", ~F.col("path").isin(bad)), k)
    assert sorted((x["dir"], x["name"], x["status"]) for x in status.collect()) == sorted(map(tuple, whole.collect()))
    good = {x["path"] for x in status.collect() if x["status"] == "ok"}
    assert {x["file_path"] for x in read.collect()} == {p for p in good if not p.endswith("0")}
    assert tried.count() == tried.distinct().count()


def test_a_large_folder_is_hardly_read(spark):
    n = 10000
    files = spark.range(n).select(F.lit("d").alias("dir"), F.format_string("f%06d", "id").alias("name"),
                                  F.format_string("d/f%06d", "id").alias("path"))
    bad = [f"d/f{i:06d}" for i in range(0, n, 3)]
    status, _, tried = waves.read_first_files(files, decode_by(bad), 5)
    assert status.where("status = 'ok'").count() == 5
    assert tried.count() <= 20


def test_all_files_without_a_limit_and_no_files(spark):
    files = spark.createDataFrame([("d", "a", "d/a"), ("d", "b", "d/b")], "dir string, name string, path string")
    status, read, tried = waves.read_first_files(files, decode_by(["d/b"]), None)
    assert sorted((x["name"], x["status"]) for x in status.collect()) == [("a", "ok"), ("b", "error")]
    assert read.count() == 1 and tried.count() == 2
    status, read, tried = waves.read_first_files(files.limit(0), decode_by([]), 3)
    assert (status.count(), read.count(), tried.count()) == (0, 0, 0)
