"""Identifier expressions: the source tool's unit values plus edge cases."""


from cohortlake.functions import ids, text


def one(spark, col, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("o")).first()["o"]


def test_to_ptid_reference_values(spark):
    df = spark.createDataFrame([("sub-ADNI001S0023",), ("sub-ADNI002S0045",), ("other",),
                                ("sub-ADNI002S0045\n",)], "s string")
    out = [r[0] for r in df.select(ids.to_ptid("s")).collect()]
    # "$" must not match before a final newline: that value stays unchanged
    assert out == ["001_S_0023", "002_S_0045", "other", "sub-ADNI002S0045\n"]


def test_valid_dx(spark):
    df = spark.createDataFrame([("cn",), ("mci",), ("dementia",), ("invalid",)], "s string")
    assert [r[0] for r in df.select(ids.valid_dx("s")).collect()] == [True, True, True, False]


def test_entities_lenient_and_strict(spark):
    sub, ses = ids.extract_entities("s")
    assert one(spark, sub, "x_sub-ADNI002S0413_ses-M132_T1w.nii.gz") == "sub-ADNI002S0413"
    assert one(spark, ses, "sub-ADNI002S0413_ses-M132_T1w.nii.gz") == "ses-M132"
    assert one(spark, sub, "no-entities.nii.gz") is None
    ssub, _ = ids.extract_entities("s", strict=True)
    assert one(spark, ssub, "sub-A1_ses-M1.nii") == "sub-A1"
    import pytest
    with pytest.raises(Exception):
        one(spark, ssub, "x_sub-A1_ses-M1.nii")


def test_to_subject_replaces_all(spark):
    assert one(spark, ids.to_subject("s"), "002_S_0413") == "sub-ADNI002S0413"
    assert one(spark, ids.to_subject("s"), "1_S_2 3_S_4") == "sub-ADNI1S2 sub-ADNI3S4"
    assert one(spark, ids.to_subject("s"), "002_X_0413") == "002_X_0413"


def test_visit_to_session(spark):
    df = spark.createDataFrame([("bl",), ("m06",), ("m6",), ("m132",), ("m1000",), ("sc",),
                                (None,), ("mm3",)], "s string")
    out = [r[0] for r in df.select(ids.visit_to_session("s")).collect()]
    assert out == ["ses-M000", "ses-M006", "ses-M006", "ses-M132", "ses-M1000", "ses-M0sc",
                   None, "ses-M0m3"]


def test_strip_lower_whitespace_kinds(spark):
    df = spark.createDataFrame([(" CN ",), ("\tDementia\n",), (" MCI ",), (None,)], "s string")
    out = [r[0] for r in df.select(text.strip_lower("s")).collect()]
    assert out == ["cn", "dementia", "mci", None]


def test_birth_year_only(spark):
    df = spark.createDataFrame([("19450615",), ("",), (None,)], "s string")
    assert [r[0] for r in df.select(text.birth_year_only("s")).collect()] == ["19450101", "", None]


def test_size_to_bytes(spark):
    df = spark.createDataFrame([("1.5G",), ("4.0K",), ("512",), ("20M",), ("2T",), ("x",)], "s string")
    out = [r[0] for r in df.select(text.size_to_bytes("s")).collect()]
    assert out == [1024 ** 3, 4096, 512, 20 * 1024 ** 2, 2 * 1024 ** 4, None]
