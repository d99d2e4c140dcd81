"""Cohort selection (C1) and included subjects."""

import pytest

from cohortlake.plans import cohort

LAYOUT = "filename string, path string, suffix string, extension string, desc string, res string, " \
         "tracer string, reconstruction string"
CLIN = "COLPROT string, PTID string, VISCODE string, DX string"


def test_reference_unit_case(spark):
    # the source tool's fixture, with "derivatives" in the path (the filter requires it)
    lay = spark.createDataFrame([(
        "sub-ADNI002S0413_ses-M132_T1w.nii.gz",
        "/data/derivatives/sub-ADNI002S0413_ses-M132_T1w.nii.gz",
        "T1w", "nii.gz", "Crop", "1x1x1", None, None)], LAYOUT)
    clin = spark.createDataFrame([("ADNI3", "002_S_0413", "m132", "CN")], CLIN)
    out = cohort.collect_cohort(lay, clin, ["ADNI3"]).collect()
    assert len(out) == 1
    r = out[0]
    assert (r["ptid"], r["session"], r["dx"], r["phase"]) == ("002_S_0413", "ses-M132", "cn", "ADNI3")
    assert "extracted" not in out[0].asDict()


def test_filters_and_null_keys(spark):
    rows = [
        ("sub-ADNI002S0413_ses-M132_T1w.nii.gz", "/raw/x", "T1w", "nii.gz", "Crop", "1x1x1", None, None),
        ("nomatch.nii.gz", "/derivatives/x", "T1w", "nii.gz", "Crop", "1x1x1", None, None),
        ("sub-ADNI002S0413_ses-M000_T1w.nii.gz", "/derivatives/x", "T1w", "nii.gz", "Crop", "1x1x1", None, None),
        ("sub-ADNI002S0413_ses-M000_pet.nii.gz", "/derivatives/x", "pet", "nii.gz", "", "", "18FFDG", "coregiso"),
    ]
    lay = spark.createDataFrame(rows, LAYOUT)
    clin = spark.createDataFrame([("ADNI3", "002_S_0413", "bl", "\tMCI "),
                                  ("ADNI3", "002_S_0413", "m132", "CN"),
                                  ("ADNI3", None, "bl", "CN"),
                                  ("ADNI2", "002_S_0413", "bl", "CN")], CLIN)
    t1 = cohort.collect_cohort(lay, clin, ["ADNI3"]).collect()
    assert [(r["session"], r["dx"]) for r in t1] == [("ses-M000", "mci")]
    pet = cohort.collect_cohort(lay, clin, ["ADNI3"], suffix="pet", trc="18FFDG", rec="coregiso").collect()
    assert len(pet) == 1 and pet[0]["suffix"] == "pet"
    # pet with non-matching parameters (defaults are empty strings, which match only '')
    assert cohort.collect_cohort(lay, clin, ["ADNI3"], suffix="pet").count() == 0


def test_many_to_many_fanout(spark):
    lay = spark.createDataFrame([("sub-ADNI002S0413_ses-M000_T1w.nii.gz", "/derivatives/a", "T1w", "nii.gz",
                                  "Crop", "1x1x1", None, None)] * 2, LAYOUT)
    clin = spark.createDataFrame([("ADNI3", "002_S_0413", "bl", "CN")] * 3, CLIN)
    assert cohort.collect_cohort(lay, clin, ["ADNI3"]).count() == 6


def test_included_subjects(spark):
    lay = spark.createDataFrame([
        ("sub-ADNI002S0413_ses-M000_pet.nii.gz", "/p", "pet", "nii.gz", None, None, "18FFDG", "coregiso"),
        ("sub-ADNI002S0413_ses-M000_pet.json", "/p", "pet", "json", None, None, "18FFDG", "coregiso"),
        ("sub-ADNI002S0413_ses-M006_pet.nii.gz", "/p", "pet", "nii.gz", None, None, "18FFDG", "coregiso")],
        LAYOUT)
    clin = spark.createDataFrame([("ADNI3", "002_S_0413", "bl", "CN")], CLIN)
    out = cohort.included_subjects(lay, clin, ["ADNI3"]).collect()
    # sidecars count: the session appears once per file
    assert [(r["participant_id"], r["session_id"]) for r in out] == [("sub-ADNI002S0413", "ses-M000")] * 2


def test_included_subjects_strict_names(spark):
    lay = spark.createDataFrame([("bad_sub-ADNI002S0413_ses-M000_pet.nii.gz", "/p", "pet", "nii.gz",
                                  None, None, "18FFDG", "coregiso")], LAYOUT)
    clin = spark.createDataFrame([("ADNI3", "002_S_0413", "bl", "CN")], CLIN)
    with pytest.raises(Exception):
        cohort.included_subjects(lay, clin, ["ADNI3"]).collect()


def test_empty_image_list(spark):
    lay = spark.createDataFrame([], LAYOUT)
    clin = spark.createDataFrame([("ADNI3", "002_S_0413", "bl", "CN")], CLIN)
    assert cohort.included_subjects(lay, clin, ["ADNI3"]).count() == 0


def test_image_filter_reaches_parquet_scan(spark, tmp_dir):
    import os
    from cohortlake.sources import readers
    p = os.path.join(tmp_dir, "layout.parquet")
    spark.createDataFrame([("sub-ADNI002S0413_ses-M132_T1w.nii.gz", "/derivatives/x", "T1w", "nii.gz",
                            "Crop", "1x1x1", None, None, "extra")], LAYOUT + ", unused string") \
        .write.parquet(p)
    lay = readers.read_bids_parquet(spark, p)
    clin = spark.createDataFrame([("ADNI3", "002_S_0413", "m132", "CN")], CLIN)
    q = cohort.collect_cohort(lay.drop("unused"), clin, ["ADNI3"])
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain("formatted")
    text = buf.getvalue()
    pushed = [line for line in text.splitlines() if line.startswith("PushedFilters")]
    schema = [line for line in text.splitlines() if line.startswith("ReadSchema")]
    assert any("EqualTo(suffix,T1w)" in x and "StringContains(path,derivatives)" in x
               and "EqualTo(desc,Crop)" in x for x in pushed), pushed
    assert schema and all("unused" not in x for x in schema)
    assert q.count() == 1
