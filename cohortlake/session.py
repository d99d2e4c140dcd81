"""Session construction and the shared folder used to cut lineage.

On a cluster ``spark.checkpoint.dir`` names a folder every executor can
reach (HDFS, S3, ...).  It is read from the session; a machine-local
temporary folder is only ever chosen for a ``local[...]`` master (tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(cpus: int | str | None = None, shuffle_partitions: int | None = None,
              app: str = "cohortlake", extra: dict | None = None) -> SparkSession:
    """Local session with the settings every job here assumes."""
    cpus = cpus or os.environ.get("BENCH_CPUS") or "*"
    # local runs: two tasks per core for CPU-bound stages; on a cluster size
    # shuffle partitions from the data (AQE coalesces toward the advisory size)
    parts = shuffle_partitions or (2 * int(cpus) if str(cpus).isdigit() else 16)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # small local inputs: do not merge partitions below 64 KiB (keeps all cores busy)
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # partial top-k before the shuffle, for larger k too
        .config("spark.sql.optimizer.windowGroupLimitThreshold", "100000")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_base(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Set here only when unset and the master is local (as in tests)."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if base:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(base)
        return base
    current = sc.getCheckpointDir()
    if current:
        return current
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder shared by all executors")
    base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    sc._conf.set("spark.checkpoint.dir", base)
    sc.setCheckpointDir(base)
    return base


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder, for written tables."""
    base = checkpoint_base(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"


def written(df, name: str):
    """``df`` written below the shared folder and read again: cuts the lineage of an
    iterative job in a way that survives the loss of executors."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df, spread: bool = False):
    """Persist ``df`` (memory, spilling to disk); its first reader fills the
    cache, so building a query runs nothing.  Lost blocks are recomputed from
    the lineage, which is deterministic here.
    ``spread``: first deal the rows evenly over the session's shuffle
    partitions (for inputs read from few, uneven splits)."""
    from pyspark import StorageLevel
    if spread:
        df = df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.persist(StorageLevel.MEMORY_AND_DISK_DESER)   # columnar cache, no per-read decode


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``cohortlake`` importable in Python workers (``addPyFile``, the
    programmatic form of ``--py-files``), once per SparkContext.  Needed by
    the operators that run Python inside tasks (``mapInArrow``)."""
    import zipfile
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import cohortlake
    pkg_dir = os.path.dirname(os.path.abspath(cohortlake.__file__))
    base = checkpoint_base(spark)
    local = base[len("file:"):] if base.startswith("file:") else base
    if "://" in local or not os.path.isdir(local):
        local = tempfile.mkdtemp(prefix="run-")   # source for Spark's file server only
    zpath = os.path.join(local, f"cohortlake-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(zpath)
    _SHIPPED.add(key)
