"""Listing utilities: folder sizes (A7), running peak (W8), chunk numbers
for split exports (K6, K3), sort-target names (K8 with A9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.operators.position import running_max, with_position


def dir_sizes(files: DataFrame, dir_col: str = "dir", size_col: str = "size",
              root: str | None = None) -> DataFrame:
    """Apparent bytes and file count below each folder, subfolders included;
    ``root`` keeps the folders at or below it.  Files without a folder form one
    row.  Folders are summed on their own first, then added to their ancestors."""
    own = files.groupBy(dir_col).agg(F.sum(size_col).cast("long").alias("bytes"),
                                     F.count(F.lit(1)).alias("n_files"))
    parts = F.split(dir_col, "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))
    inside = F.lit(True)
    if root is not None:
        top = root.rstrip("/")
        inside = (F.col(dir_col) == top) | F.col(dir_col).startswith(top + "/")
    each = (own.where(F.col(dir_col).isNotNull())
            .select(F.explode(F.when(F.col(dir_col) == "", F.array(F.lit("")))
                              .otherwise(F.filter(above, lambda x: x != ""))).alias(dir_col), "bytes", "n_files")
            .where(inside))
    if root is None:
        each = own.where(F.col(dir_col).isNull()).unionByName(each)
    return each.groupBy(dir_col).agg(F.sum("bytes").alias("bytes"), F.sum("n_files").alias("n_files"))


def running_peak(samples: DataFrame, order_cols: Sequence[str] = ("ts",),
                 dir_col: str = "dir", bytes_col: str = "bytes") -> DataFrame:
    """Per sample, the highest size seen so far for its folder."""
    return running_max(samples, bytes_col, list(order_cols), [dir_col], out_col="peak_bytes")


def with_chunks(df: DataFrame, order_cols: Sequence[str], rows_per_chunk: int,
                first_chunk: int = 1, chunk_col: str = "chunk_id",
                line_col: str | None = "line_in_chunk") -> DataFrame:
    """K6/K3: consecutive chunks of ``rows_per_chunk`` rows in ``order_cols``
    order, numbered from ``first_chunk``."""
    if rows_per_chunk < 1:
        raise ValueError("rows_per_chunk must be positive")
    p = with_position(df, list(order_cols), pos_col="_pos")
    out = p.withColumn(chunk_col, F.floor(F.col("_pos") / rows_per_chunk) + first_chunk)
    if line_col:
        out = out.withColumn(line_col, F.col("_pos") % rows_per_chunk + 1)
    return out.drop("_pos")


# Keywords used by the sort template.
TEMPLATE_KEYWORDS = ["PatientID", "SeriesNumber", "SeriesDescription", "InstanceNumber"]


def elements_wide(elements: DataFrame, keywords: Sequence[str] = TEMPLATE_KEYWORDS,
                  key: str = "file_path") -> DataFrame:
    """Top-level element values, one column per keyword (fixed list, so
    no extra pass to find pivot values)."""
    top = elements
    if "depth" in elements.columns:
        top = elements.filter(F.col("depth") == 0)
    return top.groupBy(key).pivot("keyword", list(keywords)).agg(F.max("value"))


def sort_targets(elements: DataFrame, key: str = "file_path") -> DataFrame:
    """K8: target folder ``{PatientID}_{SeriesNumber:03d}`` and file
    ``{PatientID}_{SeriesNumber:03d}_{SeriesDescription}_{InstanceNumber:05d}.dcm``
    per source file, with the number of sources sharing the target.  A number
    that isn't one reads ``null`` in the name."""
    w = elements_wide(elements, TEMPLATE_KEYWORDS, key)
    series = F.col("SeriesNumber").try_cast("bigint")
    inst = F.col("InstanceNumber").try_cast("bigint")
    folder = F.format_string("%s_%03d", F.col("PatientID"), series)
    name = F.format_string("%s_%03d_%s_%05d.dcm", F.col("PatientID"), series,
                           F.col("SeriesDescription"), inst)
    plan = w.select(key, F.concat(folder, F.lit("/"), name).alias("target"))
    same = plan.groupBy("target").agg(F.count(F.lit(1)).alias("n_same_target"))
    return plan.join(same, "target").select(key, "target", "n_same_target")
