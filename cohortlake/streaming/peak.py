"""Current and peak size per folder from a stream of size samples.

State is one row per folder (all-time peak, no watermark).  Each micro-batch writes the
rows that changed as a delta of its own in the shared folder; every so many batches the
deltas are merged into a base and removed, so reading the current table costs the folders
and a bounded number of deltas, not the batches so far.  A delta and a base are named by
their batch: a replayed batch writes the same again, and one that a base already holds is
not read.  The stream's checkpoint sits next to it, so a restarted query resumes where it
stopped."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortlake.session import shared_dir


#: Micro-batches between two merges of the deltas.
COMPACT_EVERY = 32


def peak_aggregate(samples: DataFrame, dir_col: str = "dir", bytes_col: str = "bytes",
                   order_cols: tuple[str, ...] = ("ts",)) -> DataFrame:
    """Per folder: highest size, latest size (by ``order_cols``) and sample count.
    Works on batch and streaming DataFrames alike."""
    order = F.struct(*order_cols)
    return samples.groupBy(dir_col).agg(
        F.max(bytes_col).alias("peak_bytes"),
        F.max_by(bytes_col, order).alias("current_bytes"),
        F.count(F.lit(1)).alias("n_samples"))


def stream_samples(spark: SparkSession, source_dir: str, schema: StructType | str,
                   file_glob: str | None = None) -> DataFrame:
    """A parquet folder as a stream of samples (new files become new batches)."""
    r = spark.readStream.schema(schema)
    if file_glob:
        r = r.option("pathGlobFilter", file_glob)
    return r.parquet(source_dir)


def run_until_caught_up(agg: DataFrame, out_dir: str | None = None,
                        checkpoint: str | None = None, keys: tuple[str, ...] = ("dir",),
                        compact_every: int = COMPACT_EVERY) -> DataFrame:
    """Process everything available now and return the current table.

    Update mode: each micro-batch writes only the keys whose state changed, as
    ``<out>/_batch=<id>``; the current table is the latest row per key
    (``current_table``).  Every ``compact_every`` batches they are merged
    (``compact``).  A replayed batch replaces its rows by the same rows, so retries do
    not change the result."""
    spark = agg.sparkSession
    out_dir = out_dir or shared_dir(spark, "peak_out")
    checkpoint = checkpoint or shared_dir(spark, "peak_ckpt")

    def sink(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/_batch={epoch}")
        if (epoch + 1) % compact_every == 0:
            compact(batch.sparkSession, out_dir, agg.schema, keys)

    q = (agg.writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return current_table(spark, out_dir, agg.schema, keys)


def _numbered(folder: str, name: str) -> dict[int, str]:
    """The complete subfolders ``<name>=<number>`` of a folder."""
    from pyarrow import fs
    from cohortlake.operators.tensors import _filesystem
    filesystem, root = _filesystem(folder)
    found = filesystem.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return {int(f.base_name.split("=")[1]): f"{folder}/{f.base_name}" for f in found
            if f.base_name.startswith(name + "=")
            and filesystem.get_file_info(f"{f.path}/_SUCCESS").type != fs.FileType.NotFound}


def _layout(out_dir: str) -> tuple[int, str | None, dict[int, str]]:
    """(last batch of the base, its folder, the deltas after it)."""
    out = out_dir.rstrip("/")
    bases = _numbered(out + ".base", "upto")
    upto = max(bases, default=-1)
    return upto, bases.get(upto), {k: v for k, v in _numbered(out, "_batch").items() if k > upto}


def compact(spark: SparkSession, out_dir: str, schema: StructType, keys: tuple[str, ...] = ("dir",)) -> None:
    """Merge the base and the deltas after it to a new base, then remove them.  Broken
    off anywhere, the table stays the same: the new base counts once it is complete,
    and what it holds is not read again."""
    from cohortlake.operators.tensors import _filesystem
    out = out_dir.rstrip("/")
    upto, _, deltas = _layout(out)
    if deltas:
        upto = max(deltas)
        current_table(spark, out, schema, keys).write.mode("overwrite").parquet(f"{out}.base/upto={upto}")
    for folder, name, last in ((out, "_batch", upto), (out + ".base", "upto", upto - 1)):
        for number, path in _numbered(folder, name).items():
            if number <= last:
                filesystem, inner = _filesystem(path)
                filesystem.delete_dir(inner)


def current_table(spark: SparkSession, out_dir: str, schema: StructType,
                  keys: tuple[str, ...] = ("dir",)) -> DataFrame:
    """Latest row per key over the base and the deltas after it (partial aggregation,
    one row per key)."""
    upto, base, deltas = _layout(out_dir)
    parts = [spark.read.schema(schema).parquet(path).withColumn("_batch", F.lit(k).cast("long"))
             for k, path in [*([(upto, base)] if base else []), *sorted(deltas.items())]]
    if not parts:                            # nothing written yet
        return spark.createDataFrame([], schema)
    updates = reduce(DataFrame.unionByName, parts)
    values = [c for c in schema.names if c not in keys]
    latest = updates.groupBy(*keys).agg(
        F.max_by(F.struct(*values), "_batch").alias("_v"))
    return latest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values])
