"""Jobs over real file trees written in a fresh temp folder."""

import json
import os


from cohortlake.operators import sets
from cohortlake.plans import jobs
from cohortlake.sources import listing


def touch(root, rel, data=b"x"):
    p = os.path.join(root, rel)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "wb") as f:
        f.write(data)
    return p


def test_bids_layout_and_sessions_with(spark, tmp_dir):
    for rel in ["sub-01/ses-M000/anat/sub-01_ses-M000_T1w.nii.gz",
                "sub-01/ses-M000/pet/sub-01_ses-M000_trc-18FFDG_rec-coregiso_pet.nii.gz",
                "sub-01/ses-M006/anat/sub-01_ses-M006_T1w.nii.gz",
                "sub-02/ses-M000/anat/sub-02_ses-M000_T1w.json",
                "sub-02/ses-M000/pet/sub-02_ses-M000_pet.nii.gz",
                "sub-02/ses-M000/pet/deeper/x.txt",
                "derivatives/sub-03/ses-M000/anat/sub-03_ses-M000_desc-Crop_res-1x1x1_T1w.nii.gz"]:
        touch(tmp_dir, rel)
    lst = listing.file_listing(spark, tmp_dir)
    assert lst.count() == 7
    lay = {r["filename"]: r for r in listing.bids_layout(lst).collect()}
    pet = lay["sub-01_ses-M000_trc-18FFDG_rec-coregiso_pet.nii.gz"]
    assert (pet["suffix"], pet["extension"], pet["tracer"], pet["reconstruction"]) == \
        ("pet", "nii.gz", "18FFDG", "coregiso")
    crop = lay["sub-03_ses-M000_desc-Crop_res-1x1x1_T1w.nii.gz"]
    assert (crop["suffix"], crop["desc"], crop["res"]) == ("T1w", "Crop", "1x1x1")
    got = [(r[0], r[1]) for r in jobs.sessions_with(spark, tmp_dir, ["anat", "pet"]).collect()]
    assert got == [("sub-01", "ses-M000"), ("sub-02", "ses-M000")]
    assert [tuple(r) for r in jobs.sessions_with(spark, tmp_dir, ["anat"]).collect()][:3] == \
        [("sub-01", "ses-M000"), ("sub-01", "ses-M006"), ("sub-02", "ses-M000")]


def test_missing_roots_are_reported(spark, tmp_dir):
    assert listing.missing_roots(spark, [tmp_dir, tmp_dir + "/nope"]) == [tmp_dir + "/nope"]
    assert listing.file_listing(spark, [tmp_dir + "/nope"]).count() == 0


def test_keep_list_candidates(spark, tmp_dir):
    for d in ["s1", "s2", "s3"]:
        touch(tmp_dir, f"tree/{d}/f")
    keep = os.path.join(tmp_dir, "QCpassed.txt")
    with open(keep, "w") as f:
        f.write("s1\n\nS3\n")
    folders = listing.top_level_folders(listing.file_listing(spark, os.path.join(tmp_dir, "tree")))
    out = sorted(r[0] for r in sets.not_in_keep_list(folders, spark.read.text(keep)
                                                     .withColumnRenamed("value", "name")).collect())
    assert out == ["s2", "s3"]


def test_check_manifest(spark, tmp_dir):
    for rel in ["DICOM/IM_0001", "DICOM/IM_0002", "DICOM/x.dcm", "DICOM/notes.txt", "DICOM/IM_12a"]:
        touch(tmp_dir, rel)
    root = listing.qualified_root(listing.file_listing(spark, tmp_dir), tmp_dir)
    recs = spark.createDataFrame([
        ([], 1, "PATIENT", []), ([], 2, "IMAGE", ["DICOM", "IM_0001"]),
        ([], 3, "IMAGE", ["DICOM", "IM_0003"]), ([], 4, "IMAGE", ["DICOM", "x.dcm"])],
        "parent_pos array<int>, pos int, record_type string, referenced_file_id array<string>")
    res = jobs.check_manifest(spark, tmp_dir, recs, print_only=["dicomdir", "dicomfiles"])
    st = {r["path"].replace(root, ""): r["status"] for r in res["status"].collect()}
    assert st == {"/DICOM/IM_0001": "common", "/DICOM/x.dcm": "common",
                  "/DICOM/IM_0002": "only_on_disk", "/DICOM/IM_0003": "only_in_manifest"}
    s = res["summary"].first()
    assert (s["n_only_on_disk"], s["n_only_in_manifest"], s["n_common"], s["state"]) == (1, 1, 2, "out_of_date")
    assert res["selected"].count() == 2
    assert jobs.check_manifest(spark, tmp_dir, None) == {"state": "no_index"}


def test_anonymize_plan(spark, tmp_dir):
    inp, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    touch(inp, "P1/S1/DICOMDIR")
    touch(inp, "P1/S1/DICOM/IM_0001")
    touch(inp, "P1/S1/DICOM/a/IM_0002")
    touch(inp, "P1/S1/DICOM/readme.txt")
    touch(inp, "P1/S2/DICOM/IM_0003")          # no DICOMDIR
    touch(inp, "P1/S3/DICOMDIR")               # already done
    touch(inp, "P9/S1/DICOMDIR")               # unmapped: never touched
    touch(out, "N1/S3/DICOMDIR")
    ids = os.path.join(tmp_dir, "ids.csv")
    with open(ids, "w") as f:
        f.write("P1,N0\nP1,N1\nP5,N5\n")
    res = jobs.anonymize(spark, inp, ids, out)
    rows = res["plan"].collect()
    acts = sorted((r["session"] or "", (r["source"] or "").split("/")[-1], r["action"]) for r in rows)
    assert acts == [
        ("", "", "skip_no_subject"),
        ("S1", "DICOMDIR", "anonymize"),
        ("S1", "IM_0001", "anonymize"),
        ("S1", "IM_0002", "anonymize"),
        ("S1", "S1", "not_mapped"),
        ("S1", "readme.txt", "copy"),
        ("S2", "IM_0003", "anonymize"),
        ("S2", "S2", "warn_no_dicomdir"),
        ("S3", "S3", "skip_exists")]
    summary = {r["action"]: r["n"] for r in res["summary"].collect()}
    assert summary["copy"] == 1 and summary["anonymize"] == 4
    names = {(r["session"], r["action"]) for r in rows}
    assert ("S3", "skip_exists") in names and ("S2", "warn_no_dicomdir") in names
    assert ("S1", "copy") in names
    assert {r["action"] for r in rows if r["old_id"] == "P9"} == {"not_mapped"}
    assert {r["new_id"] for r in rows} == {"N1", "N5", None}
    tgt = [r["target"] for r in rows if r["action"] == "anonymize" and r["source"].endswith("IM_0002")][0]
    assert tgt.endswith("/N1/S1/DICOM/a/IM_0002")


from cohortlake.operators.headers import decode_json_elements as fake_decoder  # noqa: E402


def test_tag_report_with_decoder(spark, tmp_dir):
    el = [{"elem_pos": [0], "tag": "(0010,0010)", "vr": "PN", "keyword": "PatientName", "value": "X"},
          {"elem_pos": [1], "tag": "(0010,1002)", "vr": "SQ", "keyword": "OtherPatientIDsSequence", "value": None},
          {"elem_pos": [1, 0, 0], "tag": "(0010,0020)", "vr": "LO", "keyword": "PatientID", "value": "7"}]
    d = os.path.join(tmp_dir, "d")
    touch(d, "a1", json.dumps({"elements": el}).encode())
    touch(d, "a2", json.dumps({"error": "unreadable"}).encode())
    touch(d, "a3", json.dumps({"elements": el}).encode())
    touch(d, "a4.dcm", json.dumps({"elements": el}).encode())
    touch(d, "skip.txt", b"{}")
    res = jobs.tag_report(spark, [d, d + "/missing"], fake_decoder, ["PatientID"], max_files=2)
    assert res["missing"] == [d + "/missing"]
    files = sorted((r["name"], r["status"]) for r in res["files"].collect())
    assert files == [("a1", "ok"), ("a2", "error"), ("a3", "ok")]
    lines = sorted((r["file_path"].split("/")[-1], r["sort_key"], r["text"]) for r in res["lines"].collect())
    assert lines == [("a1", "000001.000000.000000", "    (0010,0020) LO: PatientID = 7"),
                     ("a3", "000001.000000.000000", "    (0010,0020) LO: PatientID = 7")]


def test_readable_files_keep_list_and_multi_root(spark, tmp_dir):
    a, b = os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "b")
    for rel in ["IM_0001", "x.dcm", "y.DCM", "notes.txt", "sub/IM_0002"]:
        touch(a, rel)
    touch(b, "DICOMDIR")
    lst = listing.file_listing(spark, [a, b])                    # G3: union of roots
    assert lst.count() == 6
    root_a = listing.qualified_root(listing.file_listing(spark, a), a)
    names = sorted(r["name"] for r in listing.readable_files(lst, root_a).collect())
    assert names == ["IM_0001", "x.dcm"]                         # S9 / X11, direct children only
    keep = os.path.join(tmp_dir, "keep.txt")
    with open(keep, "w") as f:
        f.write("a\n")
    from cohortlake.sources import readers
    assert [r[0] for r in readers.read_keep_list(spark, keep).collect()] == ["a"]   # S12
    tree = jobs.directory_tree(spark.createDataFrame(
        [("d", [], 1, "PATIENT"), ("d", [1], 1, "STUDY")],
        "dicomdir_path string, parent_pos array<int>, pos int, record_type string"))
    assert sorted(r["text"] for r in tree.collect()) == ["  |-STUDY", "|-PATIENT"]   # C6


def test_dir_sizes_count_subfolders(spark):
    from cohortlake.operators.listing import dir_sizes
    files = spark.createDataFrame([("/d/a", 1), ("/d/a", 2), ("/d/a/b", 4), ("/d/a/b/c", 8), ("/d/ab", 16), (None, 32)],
                                  "dir string, size long")
    got = {r["dir"]: (r["bytes"], r["n_files"]) for r in dir_sizes(files).collect()}
    below = {"/d/a": (15, 4), "/d/a/b": (12, 2), "/d/a/b/c": (8, 1)}
    assert got == below | {"/d": (31, 5), "/d/ab": (16, 1), None: (32, 1)}
    assert {r["dir"]: (r["bytes"], r["n_files"]) for r in dir_sizes(files, root="/d/a/").collect()} == below


def test_deid_plan_second_subject_of_a_target_is_skipped(spark):
    from cohortlake.operators import deid
    paths = [f"in/{s}/{e}/DICOM/IM_0001" for s, e in (("p", "S1"), ("q", "S1"), ("q", "S2"))]
    paths += [x.replace("DICOM/IM_0001", "DICOMDIR") for x in paths]
    listing = spark.createDataFrame([(p,) for p in paths], "path string")
    lines = spark.createDataFrame([("q", "old", 0), ("p", "X", 1), ("q", "X", 2)], "old_id string, new_id string, pos long")
    for ids, first, second in ((deid.last_wins(lines, keep_pos=True), "q", "p"), (deid.last_wins(lines), "p", "q")):
        rows = deid.deid_plan(listing, ids, listing.limit(0), "in", "out").collect()
        taken = [(r["old_id"], r["session"], r["target"]) for r in rows if r["action"] == "skip_target_taken"]
        assert taken == [(second, "S1", "out/X/S1")]
        done = [(r["old_id"], r["session"]) for r in rows if r["action"] == "anonymize"]
        assert sorted(set(done)) == sorted([(first, "S1"), ("q", "S2")])
        assert len({r["target"] for r in rows if r["action"] == "anonymize"}) == 4


def test_trees_are_written_by_many_tasks(spark, tmp_dir, monkeypatch):
    """One input split of many entries is dealt out."""
    import os

    from cohortlake.sources import demo
    monkeypatch.setattr(demo, "ENTRIES_PER_TASK", 20)
    dealt, real = [], type(spark.range(1)).repartitionByRange
    monkeypatch.setattr(type(spark.range(1)), "repartitionByRange", lambda df, n, *c: (dealt.append(n), real(df, n, *c))[1])
    entries = spark.range(0, 1000, 1, 1).selectExpr("concat('a', id % 3, '/f', id) AS rel", "'file' AS kind", "id % 7 AS size")
    demo.write_tree(entries, f"{tmp_dir}/t")
    assert dealt == [max(50, spark.sparkContext.defaultParallelism)]
    assert sum(len(f) for _, _, f in os.walk(f"{tmp_dir}/t")) == 1000
