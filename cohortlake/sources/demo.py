"""Adapters: the driver's TPC-H-style tables re-shaped into this library's
inputs (file index, clinical visits, element tables, listings, ...).

They are plain expressions so the same definitions can be written in SQL
for the oracle; every adapter's size grows with the table it reads.
"""

from __future__ import annotations

import fcntl
import math
import os
import random
import shutil
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlake.operators.position import _with_bin, with_position
from cohortlake.session import materialize, shared_dir, ship_package, written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(col) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("string")


def _three(col) -> Column:
    """A number in three digits or more, never cut."""
    return F.when(F.length(_s(col)) >= 3, _s(col)).otherwise(F.lpad(_s(col), 3, "0"))


def _pseudonym(key: str) -> Column:
    """A different pseudonym for every key."""
    return F.concat(F.lit("ANON"), _s(F.col(key) * 7919))


# ---------------------------------------------------------------- visits
def visits(spark: SparkSession, sf_dir: str, reused: bool = False) -> DataFrame:
    """One row per order = one visit of subject ``o_custkey``; ``visit`` is
    the 0-based visit number in (date, orderkey) order.  ``reused``: the
    caller reads it more than once (index and clinical adapters), so it is
    computed once and kept."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    v = with_position(o, ["o_orderdate", "o_orderkey"], ["o_custkey"], pos_col="visit")
    v = (v.withColumn("mo", F.col("visit") * 6)
          .withColumn("A", _three(F.floor(F.col("o_custkey") / 10000)))
          .withColumn("B", F.lpad(_s(F.col("o_custkey") % 10000), 4, "0")))
    return materialize(v) if reused else v


def layout(v: DataFrame) -> DataFrame:
    """File index (``bids_layout``) with pet columns."""
    subject = F.concat(F.lit("sub-ADNI"), "A", F.lit("S"), "B")
    pet = F.col("o_orderkey") % 3 == 0
    return v.select(
        F.concat(subject, F.lit("_ses-M"), _three("mo"), F.lit("_T1w.nii.gz")).alias("filename"),
        F.concat(F.when(F.col("o_orderkey") % 5 == 0, F.lit("/raw/")).otherwise(F.lit("/derivatives/")),
                 subject).alias("path"),
        F.when(pet, F.lit("pet")).otherwise(F.lit("T1w")).alias("suffix"),
        F.lit("nii.gz").alias("extension"),
        F.lit("Crop").alias("desc"),
        F.lit("1x1x1").alias("res"),
        F.when(pet, F.when(F.col("o_orderkey") % 2 == 0, F.lit("18FFDG")).otherwise(F.lit("18FAV45")))
         .alias("tracer"),
        F.when(pet, F.lit("coregiso")).alias("reconstruction"),
    )


def clinical(v: DataFrame) -> DataFrame:
    """Clinical visit table with the source CSV's column names."""
    dx = (F.when(F.col("o_orderstatus") == "F", F.lit(" CN "))
           .when(F.col("o_orderstatus") == "O", F.lit("MCI"))
           .when(F.col("o_orderstatus") == "P", F.lit("\tDementia")))
    return v.select(
        F.concat(F.lit("ADNI"), _s(1 + F.year("o_orderdate") % 4)).alias("COLPROT"),
        F.concat("A", F.lit("_S_"), "B").alias("PTID"),
        F.when(F.col("visit") == 0, F.lit("bl")).otherwise(F.concat(F.lit("m"), _s("mo"))).alias("VISCODE"),
        dx.alias("DX"),
    )


# ---------------------------------------------------------------- manifest
def manifest_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files an index lists: orders keys not divisible by 11."""
    o = table(spark, sf_dir, "orders").select("o_orderkey").filter(F.col("o_orderkey") % 11 != 0)
    return o.select(_file_path("o_orderkey").alias("path"), (F.col("o_orderkey") % 20).alias("dir"))


def disk_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files present: the distinct order keys of lineitem."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey").distinct()
    return li.select(_file_path("l_orderkey").alias("path"), (F.col("l_orderkey") % 20).alias("dir"))


def _deep_path(key: str) -> Column:
    k = F.col(key)
    return F.concat(F.lit("v"), _s(F.floor(k / 8192)), F.lit("/d"), _s(F.floor(k / 64)), F.lit("/IM_"), _s(k))


def deep_disk_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files present in many small folders: the distinct order keys of lineitem."""
    return table(spark, sf_dir, "lineitem").select("l_orderkey").distinct().select(_deep_path("l_orderkey").alias("path"))


def deep_manifest_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index of them that has some too few, some too many, and some twice."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k")).distinct().filter(F.col("k") % 1009 != 0)
    extra = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k")).filter(F.col("o_orderkey") % 2003 == 0)
    return li.unionByName(extra).select(_deep_path("k").alias("path"))


def _file_path(key: str) -> Column:
    return F.concat(F.lit("dir"), _s(F.col(key) % 20), F.lit("/IM_"), _s(key))


# ---------------------------------------------------------------- listings
def session_dirs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(participant, session, child folder) from events."""
    e = table(spark, sf_dir, "events")
    return e.select(_s("user_id").alias("participant_id"),
                    F.date_format("ts", "yyyy-MM-dd").alias("session_id"),
                    F.col("event_type").alias("folder"))


def keep_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "labels").filter(F.col("quality") == 1)
            .select(_s("doc_id").alias("name")))


def top_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(_s("doc_id").alias("name"))


def size_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("event_id", "ts", _s("user_id").alias("dir"), F.col("value").alias("bytes"))


def dir_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files per folder with a read status (bad when doc_id % 7 == 0)."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("source").alias("dir"), _s("doc_id").alias("name"),
                    F.col("n_chars").alias("size"),
                    (F.col("doc_id") % 7 != 0).alias("ok"))


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of six kinds and size texts of four kinds, from part."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    kind = k % 6
    name = (F.when(kind == 0, F.concat(F.lit("IM_"), F.lpad(_s(k % 10000), 4, "0")))
             .when(kind == 1, F.concat(F.lit("IM_"), F.lpad(_s(k % 100000), 5, "0")))
             .when(kind == 2, F.concat(F.lit("IM_"), _s(k % 10)))
             .when(kind == 3, F.concat(_s(k), F.lit(".DCM")))
             .when(kind == 4, F.concat(F.lit("12_"), F.lpad(_s(k % 10000), 4, "0")))
             .otherwise(F.lit("DICOMDIR")))
    sz = F.col("p_size") % 4
    size_text = (F.when(sz == 0, F.lit("1.5G")).when(sz == 1, F.lit("4.0K"))
                  .when(sz == 2, F.lit("512")).otherwise(F.lit("20M")))
    return p.select(k.alias("p_partkey"), name.alias("name"), size_text.alias("size_text"))


# ---------------------------------------------------------------- elements
# The header elements each customer "file" carries, in tag order.
ELEMENT_DEFS = [
    # pos, tag, vr, keyword
    (0, "(0004,1130)", "CS", "FileSetID"),
    (1, "(0010,0010)", "PN", "PatientName"),
    (2, "(0010,0020)", "LO", "PatientID"),
    (3, "(0010,0030)", "DA", "PatientBirthDate"),
    (4, "(0010,1002)", "SQ", "OtherPatientIDsSequence"),
]


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dicom_elements``: six rows per customer file, one of them nested
    (a PatientID inside item 0 of the sequence)."""
    c = table(spark, sf_dir, "customer")
    key = _s("c_custkey")
    birth = F.when(F.col("c_custkey") % 13 == 0, F.lit("")).otherwise(
        F.concat(_s(1920 + F.col("c_custkey") % 80), F.lit("0615")))
    values = {"FileSetID": F.col("c_mktsegment"), "PatientName": F.col("c_name"),
              "PatientID": key, "PatientBirthDate": birth,
              "OtherPatientIDsSequence": F.lit(None).cast("string")}

    def elem(pos: list[int], tag, vr, kw, value):
        return F.struct(F.array(*[F.lit(p) for p in pos]).alias("elem_pos"),
                        F.lit(len(pos) // 2).alias("depth"), F.lit(tag).alias("tag"),
                        F.lit(vr).alias("vr"), F.lit(kw).alias("keyword"),
                        value.cast("string").alias("value"))

    items = [elem([p], t, vr, kw, values[kw]) for p, t, vr, kw in ELEMENT_DEFS]
    items.append(elem([4, 0, 0], "(0010,0020)", "LO", "PatientID", key))
    return (c.select(F.concat(F.lit("files/"), key, F.lit(".dcm")).alias("file_path"),
                     key.alias("subject"), F.inline(F.array(*items))))


def dicomdir_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dicomdir_records``: one top-level record per order of a customer."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    r = with_position(o, ["o_orderkey"], ["o_custkey"], pos_col="p0")
    return r.select(
        F.concat(F.lit("dicomdir/"), _s("o_custkey")).alias("dicomdir_path"),
        F.array().cast("array<int>").alias("parent_pos"),
        (F.col("p0") + 1).alias("pos"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("SERIES")).otherwise(F.lit("IMAGE"))
         .alias("record_type"),
        F.array(F.lit("DICOM"), F.concat(F.lit("IM_"), _s("o_orderkey"))).alias("referenced_file_id"),
    )


def elements_with_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``elements`` and two free texts per customer file: a comment that names the
    customer, or another one, or nobody; and a private tag, some with the name in it."""
    c = table(spark, sf_dir, "customer")
    k, name = F.col("c_custkey"), F.col("c_name")
    other = F.regexp_replace(name, r"\d", "7")        # a name of the same form, of few or no customers
    comment = (F.when(k % 3 == 0, F.concat(F.lit("Seen: "), F.upper(name), F.lit(", again")))
                .when(k % 3 == 1, F.concat(F.lit("see "), other)).otherwise(F.lit("nothing of note")))
    private = F.when(k % 5 == 0, F.concat(F.lit("ref("), name, F.lit(")"))).otherwise(F.concat(F.lit("x"), name, F.lit("9")))

    def row(pos, depth, tag, vr, keyword, value):
        return F.struct(F.array(*[F.lit(p) for p in pos]).alias("elem_pos"), F.lit(depth).alias("depth"), F.lit(tag).alias("tag"),
                        F.lit(vr).alias("vr"), F.lit(keyword).cast("string").alias("keyword"), value.alias("value"))

    texts = c.select(F.concat(F.lit("files/"), _s(k), F.lit(".dcm")).alias("file_path"), _s(k).alias("subject"),
                     F.inline(F.array(row([9], 0, "(0020,4000)", "LT", "ImageComments", comment),
                                      row([4, 0, 7], 1, "(0009,1001)", "UN", None, private))))
    return elements(spark, sf_dir).unionByName(texts)


def _index_lines(spark: SparkSession, sf_dir: str, lasts: bool = False) -> DataFrame:
    """Each order line with the number of its order among the customer's, and its own
    among the order's (from 0).  A window numbers them in one pass and spills
    where a customer has many.  ``lasts``: with the highest of both numbers too."""
    def number(group, order):
        return (F.row_number().over(Window.partitionBy(group).orderBy(order)) - 1).cast("long")

    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").withColumn("study", number("o_custkey", "o_orderkey"))
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    li = li.withColumn("image", number("l_orderkey", "l_linenumber"))
    if lasts:
        o = o.withColumn("last_study", F.count(F.lit(1)).over(Window.partitionBy("o_custkey")) - 1)
        li = li.withColumn("last", F.count(F.lit(1)).over(Window.partitionBy("l_orderkey")) - 1)
    return o.join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left")


def _line_type() -> Column:
    return F.when(F.col("l_linenumber") == 2, F.lit("PRESENTATION")).otherwise(F.lit("IMAGE"))


def index_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Element rows of one index file per customer: a patient record, in it a study per
    order, in that a record per line, and in each study a sequence of another kind
    whose items look like records."""
    lines = materialize(_index_lines(spark, sf_dir))
    path = F.concat(F.lit("index/"), _s("o_custkey"))

    def rows(df, *items):
        made = [F.struct(F.array(*[x if isinstance(x, Column) else F.lit(x) for x in pos]).cast("array<int>").alias("elem_pos"),
                         F.lit(tag).alias("tag"), value.cast("string").alias("value")) for pos, tag, value in items]
        return df.select(path.alias("file_path"), F.inline(F.array(*made)))

    none, s, m = F.lit(None), F.col("study"), F.col("image")
    top = rows(lines.select("o_custkey").distinct(), ([0], "(0004,1130)", F.lit("SET")), ([1], "(0004,1220)", none),
               ([1, 0, 0], "(0004,1430)", F.lit("PATIENT")), ([1, 0, 1], "(0004,1220)", none))
    study = rows(lines.select("o_custkey", "study").distinct(),
                 ([1, 0, 1, s, 0], "(0004,1430)", F.lit("STUDY")), ([1, 0, 1, s, 1], "(0004,1220)", none),
                 ([1, 0, 1, s, 2], "(0088,0200)", none), ([1, 0, 1, s, 2, 0, 0], "(0004,1430)", F.lit("DECOY")))
    image = rows(lines.filter("image is not null"), ([1, 0, 1, s, 1, m, 0], "(0004,1430)", _line_type()),
                 ([1, 0, 1, s, 1, m, 1], "(0004,1500)", F.concat(F.lit("DICOM\\IM_"), _s(m))))
    return top.unionByName(study).unionByName(image)


def index_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of ``index_elements`` as flat lists linked by offsets, in one pass over the
    lines: a study's first row carries its record too, a customer's first study the patient's."""
    lines = _index_lines(spark, sf_dir, lasts=True)
    none, study, m = F.lit(None), F.col("study"), F.col("image")
    k, known, first = study * 4096 + 2, F.col("o_custkey").isNotNull(), m.isNull() | (m == 0)

    def record(when, offset, after, lower, kind):
        return F.when(when, F.struct(offset.cast("long").alias("offset"), after.cast("long").alias("next_offset"),
                                     lower.cast("long").alias("lower_offset"), kind.alias("record_type")))

    made = F.array(record(first & (study == 0), F.lit(1), none, F.lit(2), F.lit("PATIENT")),
                   record(first & known, k, F.when(study < F.col("last_study"), k + 4096),
                          F.when(F.col("last").isNotNull(), k + 1), F.lit("STUDY")),
                   record(m.isNotNull() & known, k + 1 + m, F.when(m < F.col("last"), k + 2 + m), none, _line_type()))
    return lines.select(F.concat(F.lit("index/"), _s("o_custkey")).alias("dicomdir_path"),
                        F.inline(F.filter(made, lambda r: r.isNotNull()))).withColumn("referenced_file_id", none.cast("array<string>"))


def rename_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long element rows for the sort template: four keywords per order."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    kv = F.array(
        F.struct(F.lit("PatientID").alias("keyword"), _s("o_custkey").alias("value")),
        F.struct(F.lit("SeriesNumber").alias("keyword"), _s(F.col("o_orderkey") % 1000).alias("value")),
        F.struct(F.lit("SeriesDescription").alias("keyword"), F.col("o_orderpriority").alias("value")),
        F.struct(F.lit("InstanceNumber").alias("keyword"), _s("o_orderkey").alias("value")),
    )
    return o.select(F.concat(F.lit("in/"), _s("o_orderkey")).alias("file_path"), F.inline(kv))


def id_map_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id-map lines (old, new, position in file): from events."""
    e = table(spark, sf_dir, "events")
    return e.select(_s("user_id").alias("old_id"), _s("event_id").alias("new_id"),
                    F.col("event_id").alias("pos"))


def customer_id_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudonyms for customers not divisible by 5 (others are unmapped)."""
    c = table(spark, sf_dir, "customer").select("c_custkey").filter(F.col("c_custkey") % 5 != 0)
    return c.select(_s("c_custkey").alias("old_id"),
                    _pseudonym("c_custkey").alias("new_id"))


def subject_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File listing below ``input/<subject>/<session>/``: a DICOMDIR (when
    ``o_orderkey % 4 != 0``) and, when ``o_orderkey % 9 != 0``, one file per
    lineitem inside ``DICOM/`` (image, upper-case .DCM, or text note)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    sess = F.concat(F.lit("input/"), _s("o_custkey"), F.lit("/S"), _s("o_orderkey"))
    dicomdir = (o.filter(F.col("o_orderkey") % 4 != 0)
                 .select(F.concat(sess, F.lit("/DICOMDIR")).alias("path")))
    n = F.col("l_linenumber")
    name = (F.when(n % 3 == 0, F.concat(F.lit("IM_"), F.lpad(_s(n), 4, "0")))
             .when(n % 3 == 1, F.concat(F.lit("img"), _s(n), F.lit(".DCM")))
             .otherwise(F.concat(F.lit("note"), _s(n), F.lit(".txt"))))
    files = (o.filter(F.col("o_orderkey") % 9 != 0)
              .join(li, F.col("o_orderkey") == F.col("l_orderkey"))
              .select(F.concat(sess, F.lit("/DICOM/"), name).alias("path")))
    return dicomdir.unionByName(files)


def done_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Output listing: sessions already written (``o_orderkey % 17 == 0``)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").filter(
        (F.col("o_orderkey") % 17 == 0) & (F.col("o_custkey") % 5 != 0))
    new_id = _pseudonym("o_custkey")
    return o.select(F.concat(F.lit("output/"), new_id, F.lit("/S"), _s("o_orderkey"),
                             F.lit("/DICOMDIR")).alias("path"))


def volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """64 float32 values per embedding row = one 4x4x4 volume; label as dx."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "embedding", _s("label").alias("dx"))


# ---------------------------------------------------------------- file trees
def order_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rel, kind, size): a file per order below its customer's folder, or (every
    fourth order) a folder of its own, with an index file or empty."""
    k = F.col("o_orderkey")
    home = F.concat(F.lit("part"), _s(F.col("o_custkey") % 40), F.lit("/"), _s("o_custkey"))
    rel = (F.when(k % 4 != 0, F.concat(home, F.lit("/IM_"), _s(k)))
            .when(k % 8 == 4, F.concat(home, F.lit("/S"), _s(k), F.lit("/DICOMDIR")))
            .otherwise(F.concat(home, F.lit("/S"), _s(k))))
    return table(spark, sf_dir, "orders").select(
        rel.alias("rel"), F.when(k % 8 == 0, F.lit("dir")).otherwise(F.lit("file")).alias("kind"),
        F.when(k % 8 != 0, k % 7).alias("size"))


def bids_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rel, kind, size): per visit an image (T1w, or pet with its tracer) and, for every
    fourth, a sidecar file; subjects without sessions are not among them."""
    v = visits(spark, sf_dir)
    subject = F.concat(F.lit("sub-ADNI"), "A", F.lit("S"), "B")
    session = F.concat(F.lit("ses-M"), _three("mo"))
    pet = F.col("o_orderkey") % 3 == 0
    tracer = F.when(F.col("o_orderkey") % 2 == 0, F.lit("18FFDG")).otherwise(F.lit("18FAV45"))
    name = F.concat(subject, F.lit("_"), session, F.when(pet, F.concat(F.lit("_trc-"), tracer, F.lit("_pet"))).otherwise(F.lit("_T1w")))
    home = F.concat(subject, F.lit("/"), session, F.lit("/"), F.when(pet, F.lit("pet")).otherwise(F.lit("anat")), F.lit("/"))
    files = F.filter(F.array(F.struct(F.lit(".nii.gz").alias("e"), (F.col("o_orderkey") % 5).alias("size")),
                             F.when(F.col("o_orderkey") % 4 == 0, F.struct(F.lit(".json").alias("e"), F.lit(2).cast("long").alias("size")))),
                     lambda x: x.isNotNull())
    return (v.select(F.concat(home, name).alias("base"), F.inline(files))
            .select(F.concat("base", "e").alias("rel"), F.lit("file").alias("kind"), "size"))


def _header(*items) -> Column:
    """A header file's JSON of (tag, vr, keyword, value)."""
    made = [F.struct(F.array(F.lit(i)).alias("elem_pos"), F.lit(t).alias("tag"), F.lit(v).alias("vr"), F.lit(k).alias("keyword"),
                     x.cast("string").alias("value")) for i, (t, v, k, x) in enumerate(items)]
    return F.to_json(F.struct(F.array(*made).alias("elements")))


def patient_trees(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Input and output trees (rel, kind, content) of one session per customer: an index
    file (k % 4 <> 0), an image (k % 9 <> 0) and notes beside some; sessions of
    k % 17 = 0 stand in the output already."""
    c = table(spark, sf_dir, "customer")
    k, session = F.col("c_custkey"), F.concat(F.lit("/S"), _s("c_nationkey"))
    home = F.concat(_s(k), session)
    name, birth = F.col("c_name"), F.concat(_s(1920 + k % 80), F.lit("0615"))
    index = _header(("(0004,1130)", "CS", "FileSetID", F.col("c_mktsegment")), ("(0010,0010)", "PN", "PatientName", name))
    image = _header(("(0010,0010)", "PN", "PatientName", name), ("(0010,0020)", "LO", "PatientID", k),
                    ("(0010,0030)", "DA", "PatientBirthDate", birth), ("(0028,0010)", "US", "Rows", k % 512))

    def files(rows, rel, content):
        return rows.select(rel.alias("rel"), F.lit("file").alias("kind"), content.alias("content"))

    here = (files(c.filter(k % 4 != 0), F.concat(home, F.lit("/DICOMDIR")), index)
            .unionByName(files(c.filter(k % 9 != 0), F.concat(home, F.lit("/DICOM/IM_0001")), image))
            .unionByName(files(c.filter((k % 9 != 0) & (k % 6 == 0)), F.concat(home, F.lit("/DICOM/note.txt")), F.lit("note"))))
    done = files(c.filter((k % 17 == 0) & (k % 5 != 0)), F.concat(_pseudonym("c_custkey"), session, F.lit("/DICOMDIR")), F.lit("{}"))
    return here, done


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index records over ``order_tree``: its images but some, and some that are not there."""
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").filter(((k % 4 != 0) & (k % 11 != 0)) | ((k % 4 == 0) & (k % 13 == 0)))
    return o.select(F.array().cast("array<int>").alias("parent_pos"), k.alias("pos"), F.lit("IMAGE").alias("record_type"),
                    F.array(F.concat(F.lit("part"), _s(F.col("o_custkey") % 40)), _s("o_custkey"), F.concat(F.lit("IM_"), _s(k)))
                    .alias("referenced_file_id"))


def vector_visits(spark: SparkSession, sf_dir: str, volume_dir: str) -> tuple[DataFrame, DataFrame]:
    """File index and clinical table of three visits per subject, a volume each."""
    e = table(spark, sf_dir, "embeddings")
    subject, visit = F.floor(F.col("vec_id") / 3), F.col("vec_id") % 3
    a, b = _three(F.floor(subject / 10000)), F.lpad(_s(subject % 10000), 4, "0")
    months = _three(visit * 6)
    layout = e.select(F.concat(F.lit("sub-ADNI"), a, F.lit("S"), b, F.lit("_ses-M"), months, F.lit("_T1w.nii.gz")).alias("filename"),
                      F.concat(F.lit(volume_dir + "/"), _s("vec_id"), F.lit(".nii.gz")).alias("path"),
                      F.lit("T1w").alias("suffix"), F.lit("nii.gz").alias("extension"), F.lit("Crop").alias("desc"), F.lit("1x1x1").alias("res"),
                      F.lit(None).cast("string").alias("tracer"), F.lit(None).cast("string").alias("reconstruction"))
    dx = F.element_at(F.array(F.lit("CN"), F.lit("MCI"), F.lit("Dementia")), (F.col("label") % 3 + 1).cast("int"))
    clinical_ = e.select(F.lit("ADNI3").alias("COLPROT"), F.concat(a, F.lit("_S_"), b).alias("PTID"),
                         F.when(visit == 0, F.lit("bl")).otherwise(F.concat(F.lit("m"), _s(visit * 6))).alias("VISCODE"), dx.alias("DX"))
    return layout, clinical_


def header_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rel, kind, content): a header file per document in a folder per source; every
    seventh is unreadable."""
    d = table(spark, sf_dir, "documents")
    element = F.struct(F.array(F.lit(0)).alias("elem_pos"), F.lit("(0010,0020)").alias("tag"), F.lit("LO").alias("vr"),
                       F.lit("PatientID").alias("keyword"), _s("n_chars").alias("value"))
    good = F.to_json(F.struct(F.array(element).alias("elements")))
    return d.select(F.concat("source", F.lit("/"), _s("doc_id")).alias("rel"), F.lit("file").alias("kind"),
                    F.when(F.col("doc_id") % 7 != 0, good).otherwise(F.lit('{"error": "cut off"}')).alias("content"))


#: Entries that a task writes, and of a tree that stand at one time.
ENTRIES_PER_TASK, PORTION = 5000, 200_000


#: Names in one folder of a pool.
POOLED = 512


def _moved(old: str, new: str) -> None:
    """A file renamed.  Renames between folders wait for each other on the whole file system, links do not."""
    try:
        os.link(old, new)
    except FileNotFoundError:
        raise
    except OSError:         # it stands already, or there are no links here
        os.rename(old, new)
    else:
        os.unlink(old)


class _Pool:
    """Files and empty folders of trees that were read, kept for the next tree to be made of
    (local file systems).  Where many have just been removed, a file system may search long
    for each new one.  They lie in folders of ``POOLED`` names; a task takes such a folder by
    renaming it, so that no other does."""

    KINDS = ("file", "dir")

    def __init__(self, root: str):
        self.root, self.there = root, os.path.isdir(root)
        self.into, self.n = {}, dict.fromkeys(self.KINDS, 0)
        self.open, self.names, self.listed = {}, {k: [] for k in self.KINDS}, {}

    def put(self, kind: str, path: str) -> None:
        if self.n[kind] % POOLED == 0:
            self.into[kind] = f"{self.root}/{kind}/{uuid.uuid4().hex}"
            os.makedirs(self.into[kind])
        (_moved if kind == "file" else os.rename)(path, f"{self.into[kind]}/{self.n[kind]}")
        self.n[kind] += 1

    def put_tree(self, path: str) -> None:
        """All of the folder ``path``, and itself."""
        for at, folders, files in os.walk(path, topdown=False):
            for name in files:
                self.put("file", f"{at}/{name}")
            for name in folders:
                self.put("dir", f"{at}/{name}")
        self.put("dir", path)

    def take(self, kind: str) -> str | None:
        """A file or folder to be renamed, or none where the pool is empty."""
        while self.there and not self.names[kind]:
            self._release(kind)
            if kind not in self.listed:
                home = f"{self.root}/{kind}"
                self.listed[kind] = os.listdir(home) if os.path.isdir(home) else []
                random.shuffle(self.listed[kind])
            if not self.listed[kind]:
                return None
            name = self.listed[kind].pop()
            os.makedirs(f"{self.root}/taken", exist_ok=True)
            try:
                os.rename(f"{self.root}/{kind}/{name}", f"{self.root}/taken/{name}")
            except FileNotFoundError:       # another task has it
                continue
            self.open[kind] = name
            self.names[kind] = os.listdir(f"{self.root}/taken/{name}")
        return f"{self.root}/taken/{self.open[kind]}/{self.names[kind].pop()}" if self.there else None

    def _release(self, kind: str) -> None:
        name = self.open.pop(kind, None)
        if name is not None:
            try:
                os.rmdir(f"{self.root}/taken/{name}")
            except OSError:                 # not empty: others may have the rest
                os.rename(f"{self.root}/taken/{name}", f"{self.root}/{kind}/{name}")

    def close(self) -> None:
        for kind in self.KINDS:
            self._release(kind)

    # ------------------------------------------------ new entries, of old ones as far as there are any
    def folder(self, path: str) -> None:
        """Makes ``path`` and only what is missing above it: tasks would wait for each other there.
        A renamed folder would take the place of an empty one, so one task at a time looks and makes it."""
        if os.path.isdir(path):
            return
        if not self.there:
            return os.makedirs(path, exist_ok=True)
        self.folder(os.path.dirname(path))
        old = self.take("dir")
        with open(f"{self.root}/lock", "a") as lock:
            fcntl.flock(lock, fcntl.LOCK_EX)
            if os.path.isdir(path):
                if old:
                    self.names["dir"].append(os.path.basename(old))
            elif old:
                os.rename(old, path)
            else:
                os.mkdir(path)

    def file(self, path: str, data: bytes) -> None:
        old = self.take("file")
        while old and os.stat(old).st_nlink > 1:        # left by a task that was lost between link and unlink
            os.unlink(old)
            old = self.take("file")
        if old:
            with open(old, "r+b") as f:
                f.write(data)
                f.truncate()
            _moved(old, path)
        else:
            with open(path, "wb") as f:
                f.write(data)


def _at_once(remove: Callable, folders: list[str]) -> None:
    """Removals wait for the disk, so a task has some going at a time."""
    with ThreadPoolExecutor(32) as threads:
        list(threads.map(remove, folders))


def _pool_of(root: str) -> str:
    return f"{root}.pool"


def write_tree(entries: DataFrame, out_dir: str) -> None:
    """Write the files (``size`` bytes each, or ``content``) and folders of ``entries``
    (rel, kind, size or content) below ``out_dir``, by as many tasks as there are entries for."""
    from cohortlake.operators.tensors import _filesystem
    base = out_dir.rstrip("/")
    spark = entries.sparkSession
    ship_package(spark)
    content = "content" if "content" in entries.columns else "size"
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(entries.count() / ENTRIES_PER_TASK))

    def run(batches):
        from pyarrow import fs
        filesystem, root = _filesystem(base)
        pool = _Pool(_pool_of(root)) if isinstance(filesystem, fs.LocalFileSystem) else None
        made = set()
        for batch in batches:
            for rel, kind, what in zip(*[batch.column(n).to_pylist() for n in ("rel", "kind", content)]):
                folder = rel if kind == "dir" else rel.rpartition("/")[0]
                if folder not in made:
                    if pool:
                        pool.folder(f"{root}/{folder}")
                    else:
                        filesystem.create_dir(f"{root}/{folder}", recursive=True)
                    made.add(folder)
                if kind != "dir":
                    data = what if isinstance(what, bytes) else b"x" * what
                    if pool:
                        pool.file(f"{root}/{rel}", data)
                    else:
                        with filesystem.open_output_stream(f"{root}/{rel}", compression=None) as f:
                            f.write(data)
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})
        if pool:
            pool.close()

    (entries.select("rel", "kind", F.col(content) if content == "size" else F.col(content).cast("binary").alias(content))
     .repartitionByRange(tasks, "rel")      # a folder is written by one task or few, whatever its size
     .mapInArrow(run, "n long").write.format("noop").mode("overwrite").save())


def remove_tree(entries: DataFrame, out_dir: str, keep: bool = False) -> None:
    """Remove what ``write_tree`` wrote, the folders of the first two levels by tasks.
    ``keep``: on a local file system they are put into a pool that the next tree written to
    ``out_dir`` is made of; without it, the pool is removed too."""
    from pyarrow import fs

    from cohortlake.operators.tensors import _filesystem
    base = out_dir.rstrip("/")
    spark = entries.sparkSession
    inside = F.when(F.col("kind") == "dir", F.col("rel")).otherwise(F.regexp_extract("rel", "^(.*)/[^/]*$", 1))
    folders = entries.select(F.substring_index(inside, "/", 2).alias("folder")).where("folder <> ''").distinct()

    def run(batches):
        filesystem, root = _filesystem(base)
        pool = _Pool(_pool_of(root)) if keep and isinstance(filesystem, fs.LocalFileSystem) else None
        for batch in batches:
            # a folder of the first level may hold others of them, or be gone with a lost task's work
            there = [f"{root}/{f}" for f in batch.column(0).to_pylist()
                     if "/" in f and filesystem.get_file_info(f"{root}/{f}").type == fs.FileType.Directory]
            if pool:
                for folder in there:
                    pool.put_tree(folder)
            else:
                _at_once(filesystem.delete_dir, there)
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    n = spark.sparkContext.defaultParallelism
    folders.repartition(n).mapInArrow(run, "n long").write.format("noop").mode("overwrite").save()
    filesystem, root = _filesystem(base)
    filesystem.delete_dir(root)
    pool = _pool_of(root)
    if not keep and isinstance(filesystem, fs.LocalFileSystem) and os.path.isdir(pool):
        lots = [(f"{pool}/{kind}/{name}",) for kind in _Pool.KINDS if os.path.isdir(f"{pool}/{kind}") for name in os.listdir(f"{pool}/{kind}")]

        def remove(batches):
            for batch in batches:
                _at_once(lambda folder: shutil.rmtree(folder, ignore_errors=True), batch.column(0).to_pylist())
                yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

        spark.createDataFrame(lots, "folder string").repartition(n).mapInArrow(remove, "n long").write.format("noop").mode("overwrite").save()
        shutil.rmtree(pool)


def tree_in_portions(entries: DataFrame, out_dir: str, read: Callable[[], DataFrame], portion: int | None = None) -> DataFrame:
    """What ``read()`` finds below ``out_dir`` of the tree of ``entries``, which is written,
    read and removed in portions: whole ranges of paths, so that folders stay together.
    A portion is made of the files and folders of the one before (``_Pool``).  Folders above several portions are found in each of them."""
    spark = entries.sparkSession
    entries = written(entries, "tree-entries")
    n = math.ceil(entries.count() / (portion or PORTION))
    if n > 1:
        rows = _with_bin(entries, ["rel"], n).withColumnRenamed("_bin", "_portion")
        path = shared_dir(spark, "tree-portions")
        rows.repartition("_portion").write.partitionBy("_portion").parquet(path)
        read_again = spark.read.schema(entries.schema)
        parts = [read_again.parquet(f"{path}/_portion={r[0]}")
                 for r in spark.read.parquet(path).select("_portion").distinct().orderBy("_portion").collect()]
    else:
        parts = [entries]
    found = shared_dir(spark, "tree-found")
    for i, part in enumerate(parts):
        write_tree(part, out_dir)
        rows = read()
        rows.write.parquet(f"{found}/portion={i}")
        remove_tree(part, out_dir, keep=i + 1 < len(parts))
    return spark.read.schema(rows.schema).parquet(*[f"{found}/portion={i}" for i in range(len(parts))])
