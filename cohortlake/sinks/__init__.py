"""Writers (K1, K2, K5, K6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.operators.listing import with_chunks

# Fixed value: rows per tensor file.
TENSOR_ROWS_PER_FILE = 128
# Fixed value: default lines per exported TSV chunk.
TSV_LINES_PER_CHUNK = 10


def write_tsv(df: DataFrame, out_dir: str, mode: str = "overwrite",
              partition_by: Sequence[str] | None = None) -> None:
    """K1 (and K5 with ``partition_by=["split"]``): tab-separated with a
    header, one folder of part files.  NULL -> empty field.  Errors raise."""
    nested = [f.name for f in df.schema.fields
              if f.dataType.typeName() in ("array", "map", "struct")]
    if nested:
        raise ValueError(f"nested columns cannot be written as text: {nested}")
    w = df.write.mode(mode).option("sep", "\t").option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(out_dir)


def write_tensors(df: DataFrame, out_dir: str, mode: str = "overwrite",
                  rows_per_file: int = TENSOR_ROWS_PER_FILE,
                  partition_by: Sequence[str] | None = None) -> None:
    """K2/K5: parquet, zstd, at most ``rows_per_file`` rows per file."""
    w = (df.write.mode(mode).option("compression", "zstd")
         .option("maxRecordsPerFile", rows_per_file))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(out_dir)


def write_tsv_chunks(df: DataFrame, out_dir: str, order_cols: Sequence[str],
                     lines_per_chunk: int = TSV_LINES_PER_CHUNK, mode: str = "overwrite") -> None:
    """K6: chunks of ``lines_per_chunk`` rows in ``order_cols`` order, each
    chunk one TSV file with the header, numbered from 1 (``chunk_id=<n>``)."""
    chunks = with_chunks(df, order_cols, lines_per_chunk, line_col="_line")
    (chunks.repartition("chunk_id").sortWithinPartitions("chunk_id", "_line").drop("_line")
     .write.mode(mode).partitionBy("chunk_id").option("sep", "\t").option("header", True)
     .csv(out_dir))


def chunk_counts(df: DataFrame) -> DataFrame:
    """Rows per ``chunk_id`` (for checks)."""
    return df.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n"))
