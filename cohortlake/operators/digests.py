"""G1, A6, C7 by digests: which files differ from a manifest, at a cost that follows the
folders that differ.

Each side is summed to one row per folder: the number of its paths and two sums of their
hashes, which need no order and merge by addition.  Sums of a folder's own files add up
to those of the folders above it, so a whole tree that agrees shows at its top.  Only
paths of folders whose own sums differ are compared one by one; all others are common
without being shuffled.

Paths of the file listing are unique, as listings are.  A manifest may name a path more
than once: its folder then differs and is compared path by path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.operators.sets import COMMON, compare_files, manifest_summary
from cohortlake.session import materialize

_SUMS = ["n", "h1", "h2"]


def _folder(path: str) -> Column:
    """All before the last ``/`` (empty at the top)."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def folder_digests(paths: DataFrame, key: str = "path") -> DataFrame:
    """(dir, n, h1, h2) of each folder's own files."""
    wide = lambda c: F.sum(c.cast("decimal(38,0)"))
    return paths.filter(F.col(key).isNotNull()).groupBy(_folder(key).alias("dir")).agg(
        F.count(F.lit(1)).alias("n"), wide(F.xxhash64(key)).alias("h1"), wide(F.xxhash64(F.lit("second"), F.col(key))).alias("h2"))


def tree_digests(own: DataFrame) -> DataFrame:
    """``folder_digests`` summed up the tree: (dir, n, h1, h2) of each folder with all
    below it, the top (empty) included."""
    parts = F.split("dir", "/")
    above = F.when(F.col("dir") == "", F.array(F.lit(""))).otherwise(F.concat(
        F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))))
    return (own.select(F.explode(F.array_distinct(above)).alias("dir"), *_SUMS)
            .groupBy("dir").agg(*[F.sum(c).alias(c) for c in _SUMS]))


def differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """(dir, n_a, n_b, same) of every folder of two digests."""
    j = a.alias("a").join(b.alias("b"), "dir", "full_outer")
    same = F.lit(True)
    for c in _SUMS:
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    zero = F.lit(0).cast("long")
    return j.select("dir", F.coalesce("a.n", zero).alias("n_a"), F.coalesce("b.n", zero).alias("n_b"), same.alias("same"))


def _apart(on_disk: DataFrame, manifest: DataFrame, folders: DataFrame) -> DataFrame:
    """Status of each path in the folders that differ."""
    other = folders.filter(~F.col("same")).select("dir")
    pick = lambda df: df.select("path").filter("path is not null").withColumn("dir", _folder("path")).join(other, "dir", "left_semi")
    return compare_files(pick(on_disk), pick(manifest), carry=["dir"])


def compare_by_digest(on_disk: DataFrame, manifest: DataFrame) -> DataFrame:
    """G1: (path, dir, status) of every path, as ``compare_files`` gives them."""
    folders = materialize(differing(folder_digests(on_disk), folder_digests(manifest)))
    equal = (on_disk.select("path").filter("path is not null").withColumn("dir", _folder("path"))
             .join(folders.filter("same").select("dir"), "dir", "left_semi"))
    return (equal.select("path", "dir", F.lit(COMMON).alias("status"))
            .unionByName(_apart(on_disk, manifest, folders).select("path", "dir", "status")))


def summary_by_digest(on_disk: DataFrame, manifest: DataFrame) -> DataFrame:
    """Per folder the counts and state of ``manifest_summary``.  Folders that agree
    are counted by their digests alone."""
    folders = materialize(differing(folder_digests(on_disk), folder_digests(manifest)))
    zero = F.lit(0).cast("long")
    equal = folders.filter("same").select("dir", zero.alias("n_only_on_disk"), zero.alias("n_only_in_manifest"),
                                          F.col("n_a").alias("n_common"), F.lit("up_to_date").alias("state"))
    return equal.unionByName(manifest_summary(_apart(on_disk, manifest, folders), "dir"))


def differing_trees(on_disk: DataFrame, manifest: DataFrame) -> DataFrame:
    """(dir, n_on_disk, n_in_manifest, same) of every folder with all below it."""
    both = differing(tree_digests(folder_digests(on_disk)), tree_digests(folder_digests(manifest)))
    return both.select("dir", F.col("n_a").alias("n_on_disk"), F.col("n_b").alias("n_in_manifest"), "same")
