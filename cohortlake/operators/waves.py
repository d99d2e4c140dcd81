"""W5 without reading whole folders: the first readable files of each folder, decoded in
waves.

A wave takes, in name order, the next files of every folder that still lacks readable
ones: as many as it lacks, more where few of its files were readable so far.  So a
folder is read a little beyond its last wanted file, not to its end, and one without a
readable file takes a number of waves that grows with the logarithm of its size.  Each
wave's rows are written; folders are counted by grouped aggregates."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.operators.elements import first_files_per_dir
from cohortlake.operators.position import with_position
from cohortlake.session import written


def read_first_files(files: DataFrame, decode: Callable[[DataFrame], DataFrame],
                     max_files: int | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``files(dir, name, path)`` -> (status, elements, tried).

    ``decode`` takes a table (path) and returns element rows with ``file_path`` and
    ``error``; a file without rows is readable and empty.  status: (dir, name, path,
    status) of the files up to the ``max_files``-th readable one of each folder, and the
    unreadable ones before it; all files without ``max_files``.  elements: the rows of
    the readable ones among them.  tried: (dir, name, path, ok) of all files decoded."""
    if max_files is None:
        elements = written(decode(files.select("path")), "decoded")
        tried = written(_status(files, elements), "tried")
    else:
        want = max(int(max_files), 1)
        ranked = written(with_position(files.select("dir", "name", "path"), ["name", "path"], ["dir"], pos_col="rank"), "ranked")
        sizes = ranked.groupBy("dir").agg(F.count(F.lit(1)).alias("size"))
        state = sizes.select("dir", "size", F.lit(0).cast("long").alias("from"), F.lit(want).cast("long").alias("take"))
        waves, found = [], []
        while True:
            state = written(state, "folders")
            now = (ranked.join(state.select("dir", "from", "take"), "dir")
                   .where("rank >= from AND rank < from + take").select("dir", "name", "path", "rank"))
            now = written(now, "wave")
            found.append(written(decode(now.select("path")), "decoded"))
            waves.append(written(_status(now, found[-1]), "tried"))
            tried = reduce(DataFrame.unionByName, waves)
            ok = tried.groupBy("dir").agg(F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("good"))
            lack = want - F.col("good")
            # at the rate of readable files so far; none yet: as many again
            step = F.when(F.col("good") > 0, F.ceil(lack * F.col("n") / F.col("good"))).otherwise(F.col("n"))
            state = (sizes.join(ok, "dir").where((F.col("good") < want) & (F.col("n") < F.col("size")))
                     .select("dir", "size", F.col("n").alias("from"), F.greatest(step, lack).cast("long").alias("take")))
            if state.isEmpty():
                break
        elements = reduce(DataFrame.unionByName, found)
    status = first_files_per_dir(tried, max_files)
    status = status.join(tried.select("dir", "name", "path"), ["dir", "name"])
    read = elements.join(status.where("status = 'ok'").select(F.col("path").alias("file_path")), "file_path", "left_semi")
    return status, read, tried.select("dir", "name", "path", "ok")


def _status(files: DataFrame, elements: DataFrame) -> DataFrame:
    bad = elements.where("error is not null").select(F.col("file_path").alias("path")).distinct().withColumn("bad", F.lit(True))
    return files.join(bad, "path", "left").select("dir", "name", "path", F.col("bad").isNull().alias("ok"))
