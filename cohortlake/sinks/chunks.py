"""K2/K3: tensor files in order, ``chunk_<i>.parquet`` holding exactly rows i*n to
i*n + n - 1 of the table's order.

Positions are computed on the path table, before any volume is read; the paths of a
chunk go to one task, which decodes them in order and hands them to a Spark data source
writer.  A task writes its chunks below a staging folder, each under another name first
and then moved, so a repeated or speculative attempt replaces a file by its equal.  The
commit checks that the chunks are complete and moves the folder to its place in one
step; a failed job leaves nothing there."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from cohortlake.operators.position import with_position
from cohortlake.operators.tensors import _filesystem, volumes_to_tensors
from cohortlake.session import ship_package

# Fixed value: the schema of a tensor file.
FILE_SCHEMA = pa.schema([("raw", pa.list_(pa.float32())), ("dx", pa.large_string())])
FORMAT = "tensor_chunks"


@dataclass
class ChunksWritten(WriterCommitMessage):
    """What a task wrote, by folder: chunks, sum and greatest of their numbers, rows."""

    folders: dict[str, tuple[int, int, int, int]] = field(default_factory=dict)

    def add(self, folder: str, chunk: int, rows: int) -> None:
        n, total, last, all_rows = self.folders.get(folder, (0, 0, -1, 0))
        self.folders[folder] = (n + 1, total + chunk, max(last, chunk), all_rows + rows)


class ChunkWriter(DataSourceArrowWriter):
    def __init__(self, path: str, rows: int, overwrite: bool):
        self.path, self.rows, self.overwrite = path.rstrip("/"), rows, overwrite
        self.staging = f"{self.path}.staging-{uuid.uuid4().hex[:12]}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> ChunksWritten:
        filesystem, root = _filesystem(self.staging)
        done, held, now = ChunksWritten(), [], None

        def close():
            folder, chunk = now
            table = pa.Table.from_batches(held).select(FILE_SCHEMA.names).cast(FILE_SCHEMA)
            at = f"{root}/{folder}" if folder else root
            filesystem.create_dir(at, recursive=True)
            other = f"{at}/.chunk_{chunk}.{uuid.uuid4().hex}"
            pq.write_table(table, other, filesystem=filesystem, compression="zstd")
            filesystem.move(other, f"{at}/chunk_{chunk}.parquet")
            done.add(folder, chunk, table.num_rows)

        next_pos = None
        for batch in iterator:
            keys = list(zip(batch.column("folder").to_pylist(), batch.column("pos").to_pylist()))
            for i, (folder, pos) in enumerate(keys):
                at = (folder or "", pos // self.rows)
                if at != now:
                    if held:
                        close()
                    held, now, next_pos = [], at, at[1] * self.rows
                if pos != next_pos:
                    raise ValueError(f"row {pos} of {folder!r} where row {next_pos} should stand")
                held.append(batch.slice(i, 1))
                next_pos += 1
        if held:
            close()
        return done

    def commit(self, messages) -> None:
        filesystem, root = _filesystem(self.staging)
        _, target = _filesystem(self.path)
        found: dict[str, list[int]] = {}
        for m in messages:
            for folder, (n, total, last, rows) in (m.folders if m else {}).items():
                have = found.setdefault(folder, [0, 0, -1, 0])
                found[folder] = [have[0] + n, have[1] + total, max(have[2], last), have[3] + rows]
        for folder, (n, total, last, rows) in found.items():
            if n != last + 1 or total != last * (last + 1) // 2 or not last * self.rows < rows <= n * self.rows:
                raise ValueError(f"the chunks of {folder or 'the table'} are not complete: {n} of {last + 1}")
        filesystem.create_dir(root, recursive=True)
        from pyarrow import fs
        if filesystem.get_file_info(target).type != fs.FileType.NotFound:
            if not self.overwrite and filesystem.get_file_info(fs.FileSelector(target)):
                raise FileExistsError(self.path)
            filesystem.delete_dir(target)
        filesystem.move(root, target)

    def abort(self, messages) -> None:
        filesystem, root = _filesystem(self.staging)
        from pyarrow import fs
        if filesystem.get_file_info(root).type == fs.FileType.Directory:
            filesystem.delete_dir(root)


class TensorChunkSource(DataSource):
    """``df.write.format("tensor_chunks")``: columns raw, dx, folder and pos, the rows of
    a chunk together and in order.  Options: ``path``, ``rows`` per chunk."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> ChunkWriter:
        return ChunkWriter(self.options["path"], int(self.options.get("rows", "128")), overwrite)


def write_tensor_chunks(paths: DataFrame, out_dir: str, order_cols: Sequence[str], rows_per_chunk: int = 128,
                        split_col: str | None = None, mode: str = "overwrite", decoder=None,
                        num_partitions: int | None = None) -> None:
    """The volumes of ``paths(path, dx, ...)`` as tensor files in ``order_cols`` order:
    ``<out>/chunk_<i>.parquet``, or ``<out>/split=<s>/chunk_<i>.parquet`` with numbers
    from 0 in each split (a null split is the folder of Spark's name for it).  Volumes are
    read once, after the paths are dealt, and never shuffled."""
    if rows_per_chunk < 1:
        raise ValueError("rows_per_chunk must be positive")
    spark = paths.sparkSession
    ship_package(spark)
    spark.dataSource.register(TensorChunkSource)
    folder = F.lit("") if split_col is None else F.concat(
        F.lit(f"{split_col}="), F.coalesce(F.col(split_col).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")))
    order = list(order_cols)
    at = (with_position(paths, order, [split_col] if split_col else [], pos_col="pos")
          .select("path", F.col("dx").cast("string").alias("dx"), folder.alias("folder"), "pos"))
    n = num_partitions or 4 * max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = (at.withColumn("chunk", F.floor(F.col("pos") / rows_per_chunk))
             .repartition(n, "folder", "chunk").sortWithinPartitions("folder", "pos").drop("chunk"))
    more = {"decoder": decoder} if decoder else {}
    (volumes_to_tensors(dealt, keep=["folder", "pos"], spread=False, **more)
     .write.format(FORMAT).option("path", out_dir).option("rows", rows_per_chunk).mode(mode).save())


def read_tensor_chunks(spark, path: str) -> DataFrame:
    """The rows of the chunks with the file's number and the place in it: (raw, dx,
    chunk, row), and ``split`` where there are such folders."""
    df = spark.read.parquet(path)
    chunk = F.regexp_extract(F.col("_metadata.file_name"), r"chunk_(\d+)\.parquet$", 1).cast("long")
    return df.select("*", chunk.alias("chunk"), F.col("_metadata.row_index").alias("row"))
