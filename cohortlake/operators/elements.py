"""Header-element tables: selection (X12, X13), the indented report (W7),
first files per folder (W5) and the directory-record tree (W6)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.functions.tags import tag_matches, tag_matches_top_level
from cohortlake.operators.position import first_k_per_group
from cohortlake.operators.records import without_image_children


def select_tags(elements: DataFrame, tag_list: Iterable[str] | None,
                all_tags: bool = False) -> DataFrame:
    """Matching elements at any depth (each tested on its own)."""
    return elements.filter(tag_matches(tag_list, all_tags))


def select_tags_top_level(elements: DataFrame, tag_list: Iterable[str] | None,
                          all_tags: bool = False) -> DataFrame:
    """Matching, non-sequence elements at the top level."""
    return elements.filter(tag_matches_top_level(tag_list, all_tags))


def position_key(col: str = "elem_pos", width: int = 6) -> Column:
    """Text that sorts like the position path (pre-order: parent, then its
    items' elements).  A number of more digits than ``width`` comes after all
    shorter ones, by its digit count, and is never cut."""
    def part(x):
        text = x.cast("string")
        size = F.length(text)
        return F.when(size <= width, F.lpad(text, width, "0")).otherwise(
            F.concat(F.lit("~"), F.lpad(size.cast("string"), 2, "0"), text))
    return F.array_join(F.transform(F.col(col), part), ".")


def report_lines(elements: DataFrame, tag_list: Iterable[str] | None,
                 all_tags: bool = False) -> DataFrame:
    """One text line per matching element, indented 4 spaces per depth;
    ``sort_key`` orders the lines of a file."""
    m = select_tags(elements, tag_list, all_tags)
    known = lambda c: F.coalesce(F.col(c), F.lit(""))  # noqa: E731  private tags have no keyword
    text = F.concat(F.repeat(F.lit(" "), F.coalesce(F.col("depth"), F.lit(0)) * 4), known("tag"), F.lit(" "), known("vr"),
                    F.lit(": "), known("keyword"), F.lit(" = "), known("value"))
    return m.select("file_path", position_key().alias("sort_key"), text.alias("text"))


def first_files_per_dir(files: DataFrame, max_files: int | None, dir_col: str = "dir",
                        name_col: str = "name", ok_col: str = "ok") -> DataFrame:
    """Per folder, in name order, the files read until ``max_files``
    successful reads, with the failures met before the last of them.
    ``max_files`` below 1 acts as 1 (the check follows a success)."""
    status = F.when(F.col(ok_col), F.lit("ok")).otherwise(F.lit("error"))
    if max_files is None:
        return files.select(dir_col, name_col, status.alias("status"))
    k = max(int(max_files), 1)
    oks = first_k_per_group(files.filter(F.col(ok_col)), [dir_col], [name_col], k)
    limit = oks.groupBy(dir_col).agg(F.max(name_col).alias("_kth"),
                                     F.count(F.lit(1)).alias("_n_ok"))
    errs = (files.filter(~F.col(ok_col)).join(limit, dir_col, "left")
            .filter(F.col("_kth").isNull() | (F.col("_n_ok") < k) | (F.col(name_col) < F.col("_kth"))))
    return (oks.select(dir_col, name_col, F.lit("ok").alias("status"))
            .unionByName(errs.select(dir_col, name_col, F.lit("error").alias("status"))))


# Tree-listing marks.
TREE_BRANCH = "|-"
TREE_MORE = "|-(...)"
TREE_IGNORING = "Ignoring the remaining images..."
IMAGES_SHOWN = 4


def tree_listing(records: DataFrame) -> DataFrame:
    """The record tree, two spaces per level: every non-image record, the
    first four images under each parent (the count starts anew in each subtree), and
    for a fifth image a ``(...)`` line plus a notice.  What lies below an image is not
    listed.  ``sort_key`` orders the records of a file from the top, each before what
    is below it; ``line`` orders the two lines of one record."""
    records = without_image_children(records)
    level = F.size("parent_pos")
    indent = F.repeat(F.lit("  "), level)
    group = ["dicomdir_path", "parent_pos"]
    others = (records.filter(F.col("record_type") != "IMAGE")
              .select(*group, "pos", F.lit(0).alias("line"),
                      F.concat(indent, F.lit(TREE_BRANCH), F.col("record_type")).alias("text")))
    imgs = first_k_per_group(records.filter(F.col("record_type") == "IMAGE"), group, ["pos"],
                             IMAGES_SHOWN + 1, rank_col="_n")
    img_lines = F.when(
        F.col("_n") <= IMAGES_SHOWN,
        F.array(F.concat(indent, F.lit(TREE_BRANCH), F.col("record_type")))
    ).otherwise(F.array(F.concat(indent, F.lit(TREE_MORE)), F.concat(indent, F.lit(TREE_IGNORING))))
    images = imgs.select(*group, "pos", F.posexplode(img_lines).alias("line", "text"))
    return (others.unionByName(images)
            .withColumn("_path", F.concat("parent_pos", F.array(F.col("pos").cast("int"))))
            .select("dicomdir_path", level.alias("level"), position_key("_path").alias("sort_key"), "pos", "line", "text"))
