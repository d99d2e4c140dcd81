"""Property checks: scalar rules against Python models of the source tool's
behaviour, and results independent of the shuffle partition count."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as E
from cohortlake.functions import ids, names, text
from conftest import SF_SMALL

codes = st.one_of(st.just("bl"), st.just("sc"),
                  st.builds(lambda n, m: ("m" * m) + str(n), st.integers(0, 99999), st.integers(0, 2)),
                  st.text(alphabet="bmsc0123456789", max_size=6))


def session_model(code):
    if code is None:
        return None
    if code == "bl":
        return "ses-M000"
    x = code[1:] if code.startswith("m") else code
    return "ses-M" + x.rjust(3, "0")


def ptid_model(s):
    return re.sub(r"^sub-ADNI(\d{3})([A-Za-z])(\d{4})\Z", r"\1_\2_\3", s, flags=re.ASCII)


subjects = st.one_of(
    st.builds(lambda a, c, b: f"sub-ADNI{a:03d}{c}{b:04d}", st.integers(0, 999),
              st.sampled_from("SsXz"), st.integers(0, 9999)),
    st.text(alphabet="sub-ADNI0123456789S_", max_size=20))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), codes), min_size=1, max_size=40))
def test_visit_to_session_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(ids.visit_to_session("s")).collect()]
    assert got == [session_model(v) for v in values]


@settings(max_examples=8, deadline=None)
@given(st.lists(subjects, min_size=1, max_size=40))
def test_to_ptid_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(ids.to_ptid("s")).collect()]
    assert got == [ptid_model(v) for v in values]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet=" \t\nCNMIDemtia", max_size=12), min_size=1, max_size=40))
def test_strip_lower_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(text.strip_lower("s")).collect()]
    assert got == [v.strip().lower() for v in values]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="ab_.DCMdcm0123", min_size=1, max_size=10), min_size=1, max_size=40))
def test_suffix_stem_model(spark, values):
    from pathlib import PurePosixPath
    df = spark.createDataFrame([(v,) for v in values], "s string")
    rows = df.select(names.suffix("s"), names.stem("s")).collect()
    for v, r in zip(values, rows):
        if "/" in v or v in (".", ".."):
            continue
        p = PurePosixPath(v)
        assert (r[0], r[1]) == (p.suffix, p.stem), v


def test_same_results_for_1_and_200_shuffle_partitions(spark):
    qs = E.queries()
    names_ = ["cohort_inner_join", "subject_split_rows", "tree_top4", "running_peak",
              "tsv_chunks", "max_files_per_dir", "deid_plan", "split_balance"]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = {}
    try:
        for parts in ("1", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            for n in names_:
                df = qs[n](spark, SF_SMALL)
                cols = sorted(df.columns)
                results.setdefault(n, []).append(sorted(map(tuple, df.select(*cols).collect()),
                                                        key=repr))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for n, (a, b) in results.items():
        assert a == b, n
