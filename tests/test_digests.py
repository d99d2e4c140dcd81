"""Comparison by folder digests against the full join."""

import random

from pyspark.sql import functions as F

from cohortlake.operators import digests, sets


def sides(spark, n=600):
    r = random.Random(3)
    paths = [f"{'' if i % 50 == 0 else f'a{i % 3}/'}{'' if i % 7 == 0 else f'b{i % 40}/'}f{i}" for i in range(n)]
    disk = [p for p in paths if r.random() > 0.01]
    index = [p for p in paths if r.random() > 0.01] + ["x/y/new", paths[5], paths[5], None]
    df = lambda v: spark.createDataFrame([(p,) for p in v], "path string")
    return df(disk), df(index)


def test_status_and_summary_equal_the_full_join(spark):
    disk, index = sides(spark)
    full = sets.compare_files(disk, index.filter("path is not null"))
    got = digests.compare_by_digest(disk, index)
    assert sorted((r["path"], r["status"]) for r in got.collect()) == sorted((r["path"], r["status"]) for r in full.collect())
    want = sets.manifest_summary(full.withColumn("dir", F.regexp_replace("path", r"/?[^/]*$", "")))
    assert sorted(map(tuple, digests.summary_by_digest(disk, index).collect())) == sorted(map(tuple, want.collect()))


def test_trees_that_agree_show_at_their_top(spark):
    a = spark.createDataFrame([(f"t{i % 3}/u{i % 5}/f{i}",) for i in range(60)], "path string")
    b = a.filter("path <> 't1/u0/f10'").unionByName(a.limit(0))
    got = {r["dir"]: (r["n_on_disk"], r["n_in_manifest"], r["same"]) for r in digests.differing_trees(a, b).collect()}
    assert got[""] == (60, 59, False) and got["t1"] == (20, 19, False) and got["t0"] == (20, 20, True)
    assert [d for d, v in got.items() if not v[2]] == ["", "t1", "t1/u0"] or {d for d, v in got.items() if not v[2]} == {"", "t1", "t1/u0"}


def test_only_differing_folders_are_joined_by_path(spark):
    a = spark.range(20000).select(F.format_string("d%d/f%d", (F.col("id") / 100).cast("long"), F.col("id")).alias("path"))
    b = a.filter("path <> 'd7/f705'")
    folders = digests.differing(digests.folder_digests(a), digests.folder_digests(b))
    assert [r["dir"] for r in folders.filter("not same").collect()] == ["d7"]
    assert digests._apart(a, b, folders).count() == 100


def test_empty_sides(spark):
    a = spark.createDataFrame([("d/x",)], "path string")
    none = a.limit(0)
    assert [tuple(r) for r in digests.compare_by_digest(a, none).collect()] == [("d/x", "d", "only_on_disk")]
    assert [tuple(r) for r in digests.compare_by_digest(none, a).collect()] == [("d/x", "d", "only_in_manifest")]
    assert digests.summary_by_digest(none, none).count() == 0
