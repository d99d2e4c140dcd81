"""Element operators against direct Python simulations; streaming peak."""

import random


from cohortlake.operators import deid, elements
from cohortlake.streaming import peak


def test_first_files_per_dir_matches_loop(spark):
    rnd = random.Random(5)
    rows = [(f"d{rnd.randint(0, 4)}", f"f{i:04d}", rnd.random() > 0.3) for i in range(400)]
    rows += [("hot", f"h{i:05d}", i % 5 != 0) for i in range(3000)]
    df = spark.createDataFrame(rows, "dir string, name string, ok boolean")
    for k in (0, 1, 3):
        got = sorted(tuple(r) for r in elements.first_files_per_dir(df, k).collect())
        exp = []
        for d in sorted({r[0] for r in rows}):
            n_ok = 0
            for _, name, ok in sorted(r for r in rows if r[0] == d):
                exp.append((d, name, "ok" if ok else "error"))
                n_ok += ok
                if ok and n_ok >= max(k, 1):
                    break
        assert got == sorted(exp)


def test_tree_listing_counts_per_parent(spark):
    recs = [([], i + 1, "IMAGE" if i % 4 else "SERIES") for i in range(12)] + \
           [([5], i + 1, "IMAGE") for i in range(3)] + [([2], 1, "SERIES")]
    df = spark.createDataFrame([("dd", *r) for r in recs],
                               "dicomdir_path string, parent_pos array<int>, pos int, record_type string")
    out = elements.tree_listing(df).orderBy("level", "pos", "line").collect()
    top = [r["text"] for r in out if r["level"] == 0]
    assert top.count("|-SERIES") == 3
    assert top.count("|-IMAGE") == 4 and "|-(...)" in top and "Ignoring the remaining images..." in top
    assert [r["text"] for r in out if r["level"] == 1] == ["  |-IMAGE"] * 3    # nothing below an image


def test_report_order_and_deid(spark):
    rows = [("f", [0], 0, "(0010,0010)", "PN", "PatientName", "Doe", "s1"),
            ("f", [1], 0, "(0010,0020)", "LO", "PatientID", "s1", "s1"),
            ("f", [2], 0, "(0010,0030)", "DA", "PatientBirthDate", "19450615", "s1"),
            ("f", [3], 0, "(0010,1002)", "SQ", "OtherPatientIDsSequence", None, "s1"),
            ("f", [3, 0, 0], 1, "(0010,0020)", "LO", "PatientID", "s1", "s1"),
            ("f", [3, 0, 1], 1, "(0010,0010)", "PN", "PatientName", "Doe", "s1"),
            ("f", [10], 0, "(0020,0011)", "IS", "SeriesNumber", "3", "s1")]
    df = spark.createDataFrame(rows, "file_path string, elem_pos array<int>, depth int, tag string, "
                                     "vr string, keyword string, value string, subject string")
    lines = [r["text"] for r in elements.report_lines(df, None, True).orderBy("sort_key").collect()]
    assert lines[3].startswith("(0010,1002)") and lines[4].startswith("    (0010,0020)")
    assert lines[-1].startswith("(0020,0011)")   # [10] after [3,0,1]
    idm = spark.createDataFrame([("s1", "ANON1")], "old_id string, new_id string")
    out = {(tuple(r["elem_pos"])): r["value"] for r in deid.anonymize_elements(df, idm).collect()}
    assert (1,) not in out and out[(0,)] == "ANON1" and out[(2,)] == "19450101"
    assert out[(3, 0, 0)] == "s1"     # nested identifiers stay (top level only)
    deep = {(tuple(r["elem_pos"])): r["value"] for r in deid.anonymize_elements(df, idm, deep=True).collect()}
    assert (3, 0, 0) not in deep and deep[(3, 0, 1)] == "ANON1"
    assert deid.nested_identifier_audit(df).count() == 2


def test_peak_stream_equals_batch(spark, tmp_dir):
    import os
    src = os.path.join(tmp_dir, "samples")
    df = spark.createDataFrame([(i, f"d{i % 3}", float((i * 37) % 11), i) for i in range(60)],
                               "event_id long, dir string, bytes double, ts long")
    df.coalesce(2).write.parquet(src)
    stream = peak.stream_samples(spark, src, df.schema)
    got = peak.run_until_caught_up(peak.peak_aggregate(stream, order_cols=("ts",)),
                                   os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck"))
    exp = peak.peak_aggregate(df, order_cols=("ts",))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))


def test_peak_stream_incremental_restart(spark, tmp_dir):
    import os
    src = os.path.join(tmp_dir, "in")
    schema = "event_id long, dir string, bytes double, ts long"
    all_rows = [(i, f"d{i % 4}", float((i * 53) % 17), i) for i in range(80)]
    for k in range(3):
        spark.createDataFrame(all_rows[k * 20:(k + 1) * 20], schema).coalesce(1) \
            .write.mode("append").parquet(src)
    out, ck = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck")

    def run():
        s = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src))
        return peak.run_until_caught_up(peak.peak_aggregate(s, order_cols=("ts",)), out, ck)

    got = run()
    exp = peak.peak_aggregate(spark.createDataFrame(all_rows[:60], schema), order_cols=("ts",))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))
    assert spark.read.parquet(out).select("_batch").distinct().count() == 3
    spark.createDataFrame(all_rows[60:], schema).coalesce(1).write.mode("append").parquet(src)
    got = run()   # resumes from the checkpoint: only the new file is read
    exp = peak.peak_aggregate(spark.createDataFrame(all_rows, schema), order_cols=("ts",))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))


def test_report_positions_beyond_six_digits_and_missing_keywords(spark):
    from cohortlake.operators.elements import report_lines
    places = [100000, 999999, 1000000, 1000001, 12345678]
    df = spark.createDataFrame([("f", [p], 0, "(0009,0010)", None, None, None) for p in places],
                               "file_path string, elem_pos array<int>, depth int, tag string, vr string, keyword string, value string")
    rows = report_lines(df, None, all_tags=True).orderBy("sort_key").collect()
    assert len({r.sort_key for r in rows}) == len(places) and all(r.text is not None for r in rows)
    keyed = sorted((r.sort_key for r in rows))
    assert keyed == [r.sort_key for r in rows] and keyed[2].endswith("1000000") and keyed[4].endswith("12345678")
