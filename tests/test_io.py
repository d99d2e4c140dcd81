"""Readers and writers: round trips and the id-map rules."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from cohortlake.operators import deid
from cohortlake.sinks import write_tsv, write_tsv_chunks
from cohortlake.sources import readers


def test_parquet_and_tsv_roundtrip(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "col1 long, col2 string")
    p = os.path.join(tmp_dir, "x.parquet")
    df.write.parquet(p)
    back = readers.read_bids_parquet(spark, p)
    assert sorted(map(tuple, back.collect())) == [(1, "a"), (2, "b"), (3, "c")]
    t = os.path.join(tmp_dir, "x.tsv")
    write_tsv(df, t)
    txt = spark.read.option("sep", "\t").option("header", True).schema("col1 long, col2 string").csv(t)
    assert sorted(map(tuple, txt.collect())) == [(1, "a"), (2, "b"), (3, "c")]


def test_empty_index_is_an_error(spark, tmp_dir):
    p = os.path.join(tmp_dir, "e.parquet")
    spark.createDataFrame([], "filename string").write.parquet(p)
    with pytest.raises(ValueError):
        readers.read_bids_parquet(spark, p)


def test_extension_dot_normalised(spark, tmp_dir):
    p = os.path.join(tmp_dir, "l.parquet")
    spark.createDataFrame([(".nii.gz",), ("nii.gz",)], "extension string").write.parquet(p)
    assert {r[0] for r in readers.read_bids_parquet(spark, p).collect()} == {"nii.gz"}


def test_nested_columns_cannot_be_written_as_tsv(spark, tmp_dir):
    df = spark.createDataFrame([([1.0], "cn")], "raw array<double>, dx string")
    with pytest.raises(ValueError):
        write_tsv(df, os.path.join(tmp_dir, "n"))


def test_clinical_csv_keeps_codes_as_text(spark, tmp_dir):
    p = os.path.join(tmp_dir, "c.csv")
    with open(p, "w") as f:
        f.write("RID,DX,VISCODE,PTID,COLPROT,EXTRA\n1,CN,m06,002_S_0413,ADNI3,x\n2,MCI,bl,011_S_0002,ADNI2,y\n")
    df = readers.read_clinical_csv(spark, p)
    assert df.columns == ["COLPROT", "PTID", "VISCODE", "DX"]
    assert dict(df.dtypes)["VISCODE"] == "string"
    assert df.filter("PTID = '002_S_0413'").first()["VISCODE"] == "m06"


def test_id_map_last_wins_and_rejects(spark, tmp_dir):
    p = os.path.join(tmp_dir, "ids.csv")
    with open(p, "w") as f:
        f.write("a,A1\nb,B1,extra\nshort\na,A2\nc,\n")
    rows = readers.read_id_map_rows(spark, p)
    m = {r["old_id"]: r["new_id"] for r in deid.last_wins(rows).collect()}
    assert m == {"a": "A2", "b": "B1"}
    assert readers.rejected_id_map_rows(rows).count() == 2


def test_tsv_chunks_have_headers_and_sizes(spark, tmp_dir):
    df = spark.range(25).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).repartition(4)
    out = os.path.join(tmp_dir, "chunks")
    write_tsv_chunks(df, out, ["k"], lines_per_chunk=10)
    dirs = sorted(glob.glob(os.path.join(out, "chunk_id=*")))
    assert [os.path.basename(d) for d in dirs] == ["chunk_id=1", "chunk_id=2", "chunk_id=3"]
    for d, expect in zip(dirs, [range(0, 10), range(10, 20), range(20, 25)]):
        files = [f for f in glob.glob(os.path.join(d, "part-*")) if os.path.getsize(f) > 0]
        assert len(files) == 1
        lines = open(files[0]).read().splitlines()
        assert lines[0] == "k\tv"
        assert [int(x.split("\t")[0]) for x in lines[1:]] == list(expect)


def test_tag_file(tmp_dir):
    p = os.path.join(tmp_dir, "tags.yml")
    with open(p, "w") as f:
        f.write("- PatientID\n- (0010, 0030)\n")
    assert readers.read_tag_file(p) == ["PatientID", "(0010, 0030)"]
    assert readers.read_tag_file(None) == []
