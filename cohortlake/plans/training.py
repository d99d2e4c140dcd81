"""Cohort -> TSV -> subject split -> per-split TSV and tensor parquet."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame

from cohortlake.functions.ids import DEFAULT_PHASES, VALID_DX
from cohortlake.operators.split import check_fractions, split_train_val_test
from cohortlake.operators.tensors import volumes_to_tensors
from cohortlake.plans.cohort import collect_cohort
from cohortlake.sinks import write_tensors, write_tsv
from cohortlake.sinks.chunks import write_tensor_chunks
from cohortlake.sources import nifti


def build_training_set(layout: DataFrame, clinical: DataFrame, out_dir: str,
                       phases: Sequence[str] = DEFAULT_PHASES,
                       valid_dx: Sequence[str] = VALID_DX, suffix: str = "T1w",
                       trc: str = "", rec: str = "", desc: str = "", res: str = "",
                       train: float = 0.8, val: float = 0.1, n_proc: int | None = None,
                       decoder: Callable[[bytes], np.ndarray] = nifti.decode,
                       order_cols: Sequence[str] = ("session", "path", "filename"),
                       keep_identity: bool = False, ordered: bool = False) -> dict[str, str]:
    """Writes ``<out>/dataset`` (TSV), ``<out>/splits/split=<s>`` (TSV) and
    ``<out>/tensors/split=<s>`` (parquet, zstd, <=128 rows per file).
    ``ordered``: the tensor files are ``chunk_<i>.parquet``, each holding exactly its
    128 rows of the split in (subject, ``order_cols``) order.
    The cohort is computed once and persisted: it feeds all three outputs."""
    check_fractions(train, val)
    cohort = collect_cohort(layout, clinical, phases, valid_dx, suffix, trc, rec, desc, res)
    cohort = cohort.persist(StorageLevel.MEMORY_AND_DISK_DESER)
    try:
        base = out_dir.rstrip("/")
        paths = {"dataset": f"{base}/dataset", "splits": f"{base}/splits",
                 "tensors": f"{base}/tensors"}
        write_tsv(cohort, paths["dataset"])
        rows = split_train_val_test(cohort, train, val, order_cols=list(order_cols))
        write_tsv(rows, paths["splits"], partition_by=["split"])
        if ordered:
            if keep_identity:
                raise ValueError("ordered chunks hold raw and dx only")
            write_tensor_chunks(rows, paths["tensors"], ["ptid", *order_cols], split_col="split", decoder=decoder,
                                num_partitions=n_proc)
            return paths
        keep = ["split"] + (["ptid", "session", "path"] if keep_identity else [])
        tensors = volumes_to_tensors(rows, num_partitions=n_proc, decoder=decoder, keep=keep,
                                     with_shape=keep_identity)
        write_tensors(tensors, paths["tensors"], partition_by=["split"])
        return paths
    finally:
        cohort.unpersist()


def build_training_set_from_files(spark, index_parquet: str, clinical_csv: str, out_dir: str,
                                  **kwargs) -> dict[str, str]:
    """C2 from files: the index parquet (S1, empty is an error) and the
    clinical CSV (S2, codes kept as text); other arguments as
    ``build_training_set``."""
    from cohortlake.sources.readers import read_bids_parquet, read_clinical_csv
    return build_training_set(read_bids_parquet(spark, index_parquet),
                              read_clinical_csv(spark, clinical_csv), out_dir, **kwargs)
