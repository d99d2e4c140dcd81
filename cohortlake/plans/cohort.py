"""Cohort selection (C1) and the included-subjects list."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.functions.ids import (
    DEFAULT_PHASES, VALID_DX, extract_entities, to_ptid, to_subject, visit_to_session)
from cohortlake.functions.text import strip_lower

LAYOUT_COLUMNS = ["filename", "path", "suffix", "extension", "desc", "res",
                  "tracer", "reconstruction"]


def image_filter(suffix: str = "T1w", trc: str = "", rec: str = "", desc: str = "",
                 res: str = "") -> Column:
    """Which index rows are images of the wanted kind.  For ``pet`` the
    four scan parameters must match; otherwise ``Crop`` at ``1x1x1`` is
    required and the parameters are not used."""
    conds = [F.col("suffix") == suffix, F.col("extension") == "nii.gz",
             F.col("path").contains("derivatives")]
    if suffix == "pet":
        conds += [F.col("desc") == desc, F.col("res") == res,
                  F.col("tracer") == trc, F.col("reconstruction") == rec]
    else:
        conds += [F.col("desc") == "Crop", F.col("res") == "1x1x1"]
    return functools.reduce(operator.and_, conds)


def select_images(layout: DataFrame, suffix: str = "T1w", trc: str = "", rec: str = "",
                  desc: str = "", res: str = "") -> DataFrame:
    """X6 + X1 (lenient) + X2: filtered index with ``ptid`` and ``session``."""
    sub, ses = extract_entities("filename")
    return (layout.filter(image_filter(suffix, trc, rec, desc, res))
            .withColumn("ptid", to_ptid(sub))
            .withColumn("session", ses))


def clinical_visits(clinical: DataFrame, phases: Sequence[str] = DEFAULT_PHASES,
                    valid_dx: Sequence[str] | None = VALID_DX) -> DataFrame:
    """(phase, ptid, session, dx) of wanted phases/diagnoses."""
    out = clinical.select(
        F.col("COLPROT").alias("phase"),
        to_ptid("PTID").alias("ptid"),
        visit_to_session("VISCODE").alias("session"),
        strip_lower("DX").alias("dx"),
    ).filter(F.col("phase").isin(list(phases)))
    if valid_dx is not None:
        out = out.filter(F.col("dx").isin(list(valid_dx)))
    return out


def collect_cohort(layout: DataFrame, clinical: DataFrame,
                   phases: Sequence[str] = DEFAULT_PHASES,
                   valid_dx: Sequence[str] = VALID_DX, suffix: str = "T1w",
                   trc: str = "", rec: str = "", desc: str = "", res: str = "") -> DataFrame:
    """Image rows joined to the clinical visit of the same subject and
    session (inner, many-to-many allowed, NULL keys never match).

    The join is left to the planner: AQE turns it into a broadcast join only
    when the measured visit side is under the broadcast threshold, and splits
    skewed (subject, session) partitions otherwise."""
    images = select_images(layout, suffix, trc, rec, desc, res)
    visits = clinical_visits(clinical, phases, valid_dx)
    keep = [c for c in layout.columns]
    joined = images.join(visits, ["ptid", "session"], "inner")
    return joined.select(*keep, "ptid", "session", "phase", "dx")


def included_subjects(layout: DataFrame, clinical: DataFrame, phases: Sequence[str],
                      suffix: str = "pet", trc: str = "18FFDG", rec: str = "coregiso") -> DataFrame:
    """(participant_id, session_id) of index files with a visit in the
    wanted phases.  File names must start with the entities (else the query
    fails); rows repeat once per matching file (semi join keeps the left)."""
    files = layout.filter(F.col("suffix") == suffix)
    if suffix == "pet":
        files = files.filter((F.col("tracer") == trc) & (F.col("reconstruction") == rec))
    sub, ses = extract_entities("filename", strict=True)
    left = files.select(sub.alias("participant_id"), ses.alias("session_id"))
    right = clinical.select(
        F.col("COLPROT").alias("phase"),
        to_subject("PTID").alias("participant_id"),
        visit_to_session("VISCODE").alias("session_id"),
    ).filter(F.col("phase").isin(list(phases)))
    return left.join(right, ["participant_id", "session_id"], "left_semi")


def included_subjects_tsv(spark, bids_root: str, clinical_csv: str, out_dir: str,
                          phases: Sequence[str], suffix: str = "pet", trc: str = "18FFDG",
                          rec: str = "coregiso") -> DataFrame:
    """C3 from files: index a BIDS tree (S3), read the clinical CSV (S2),
    keep files with a visit in ``phases`` and write the TSV (K1) to
    ``out_dir``.  Returns the written table."""
    from cohortlake.sinks import write_tsv
    from cohortlake.sources.listing import bids_layout, file_listing
    from cohortlake.sources.readers import read_clinical_csv
    layout = bids_layout(file_listing(spark, bids_root))
    result = included_subjects(layout, read_clinical_csv(spark, clinical_csv), phases,
                               suffix=suffix, trc=trc, rec=rec)
    write_tsv(result, out_dir)
    return result
