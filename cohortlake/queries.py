"""Registered queries: one per operator of the inventory, each reading the
driver's tables through the adapters in ``sources.demo``.

Each entry is ``(spark, sf_dir) -> DataFrame``; computed columns carry the
same names as in the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.functions import ids, names, tensor, text
from cohortlake.operators import deid, digests, elements, headers, leaks, listing, position, records, sets, split, strata, tensors, waves
from cohortlake.plans import cohort, jobs
from cohortlake.session import materialize, shared_dir
from cohortlake.sources import bids, demo, readers, walk
from cohortlake.streaming import peak

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# Phase lists used by the two cohort jobs over the adapters.
COHORT_PHASES = ["ADNI2", "ADNI3"]
INCLUDED_PHASES = ["ADNI1", "ADNI2", "ADNI3", "ADNI4", "ADNIGO"]


@query
def cohort_inner_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filtered T1w images joined to visits of phases ADNI2/ADNI3."""
    v = demo.visits(spark, sf_dir, reused=True)
    return cohort.collect_cohort(demo.layout(v), demo.clinical(v), phases=COHORT_PHASES)


# ------------------------------------------------------------------ helpers
def _cohort(spark: SparkSession, sf_dir: str, persist: bool = False) -> DataFrame:
    v = demo.visits(spark, sf_dir, reused=True)
    c = cohort.collect_cohort(demo.layout(v), demo.clinical(v), phases=COHORT_PHASES)
    # the split reads the cohort once for the assignment and once per routing branch
    return materialize(c) if persist else c


def _layout_with_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    lay = demo.layout(demo.visits(spark, sf_dir))
    sub, ses = ids.extract_entities("filename")
    return lay.withColumn("ptid", ids.to_ptid(sub)).withColumn("session", ses)


SPLIT_ORDER = ["session", "path", "filename"]
TRAIN, VAL = 0.8, 0.1


@query
def included_subjects_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pet images (18FFDG, coregiso) semi-joined to visits of five phases."""
    v = demo.visits(spark, sf_dir, reused=True)
    return cohort.included_subjects(demo.layout(v), demo.clinical(v), INCLUDED_PHASES,
                                    suffix="pet", trc="18FFDG", rec="coregiso")


@query
def entity_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 lenient (NULL when absent) and X2 on every index row."""
    lay = demo.layout(demo.visits(spark, sf_dir))
    sub, ses = ids.extract_entities("filename")
    psub, _ = ids.extract_entities("path")
    return lay.select("filename", "path", sub.alias("subject"), ses.alias("session"),
                      ids.to_ptid(sub).alias("ptid"), psub.alias("path_subject"))


@query
def visit_session_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X4 on codes of every length, ``bl``, ``sc`` and NULL."""
    o = demo.table(spark, sf_dir, "orders").select("o_orderkey")
    k = F.col("o_orderkey")
    code = (F.when(k % 7 == 0, F.lit("bl")).when(k % 11 == 0, F.lit(None).cast("string"))
             .when(k % 13 == 0, F.lit("sc")).otherwise(F.concat(F.lit("m"), k.cast("string"))))
    return o.select("o_orderkey", code.alias("viscode")).withColumn(
        "session", ids.visit_to_session("viscode"))


@query
def dx_normalise_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised diagnosis counts per phase with validity."""
    c = demo.clinical(demo.visits(spark, sf_dir))
    return (c.select(F.col("COLPROT").alias("phase"), text.strip_lower("DX").alias("dx"))
            .groupBy("phase", "dx").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("is_valid", ids.valid_dx("dx")))


@query
def pet_image_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X6 pet branch: scan parameters must all match."""
    lay = demo.layout(demo.visits(spark, sf_dir))
    return cohort.select_images(lay, "pet", trc="18FFDG", rec="coregiso", desc="Crop", res="1x1x1")


@query
def subject_split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 + J3/J4: cohort rows routed to train (all rows) / val, test (first row)."""
    return split.split_train_val_test(_cohort(spark, sf_dir, True), TRAIN, VAL, order_cols=SPLIT_ORDER)


@query
def subject_split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, A2 over W1: rows and subjects per split."""
    rows = split.split_train_val_test(_cohort(spark, sf_dir, True), TRAIN, VAL, order_cols=SPLIT_ORDER)
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"),
                                     F.countDistinct("ptid").alias("n_subjects"))


@query
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-pass hash split of customers."""
    c = demo.table(spark, sf_dir, "customer").select("c_custkey")
    return split.hash_split(c, TRAIN, VAL, key="c_custkey").select("c_custkey", "split")


@query
def first_row_per_subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: first index row per subject by (session, path, filename)."""
    return split.first_row_per_subject(_layout_with_ids(spark, sf_dir), "ptid", SPLIT_ORDER)


@query
def session_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most three sessions per subject."""
    return split.cap_sessions(_cohort(spark, sf_dir), 3, "ptid", SPLIT_ORDER)


@query
def split_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balance of account balance and segment across the exact split."""
    subjects = (demo.table(spark, sf_dir, "orders")
                .select(F.col("o_custkey").cast("string").alias("ptid")).distinct())
    assign = split.assign_splits(subjects, TRAIN, VAL)
    cust = demo.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("ptid"), "c_acctbal", "c_mktsegment")
    x = assign.join(cust, "ptid")
    return split.balance_report(x, ["c_acctbal"], ["c_mktsegment"])


@query
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user, type, day) keys of events that repeat."""
    e = demo.table(spark, sf_dir, "events").select(
        "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    return position.duplicate_keys(e, ["user_id", "event_type", "day"])


@query
def tensor_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 on array columns: value / 255 as float32."""
    e = demo.table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.posexplode(tensor.scale_voxels("embedding")).alias("idx", "value")) \
        .withColumn("idx", F.col("idx").cast("long"))


@query
def tensor_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8 slices of 8 flattened back in C order."""
    e = demo.table(spark, sf_dir, "embeddings")
    flat = tensor.flatten_c_order(tensor.nest("embedding", 8))
    return e.select("vec_id", F.posexplode(flat).alias("idx", "value")) \
        .withColumn("idx", F.col("idx").cast("long"))


@query
def tensor_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunk (of 128 rows, from 0) of each tensor row in id order."""
    e = demo.table(spark, sf_dir, "embeddings").select("vec_id")
    return listing.with_chunks(e, ["vec_id"], 128, first_chunk=0)


@query
def tsv_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: chunk (of 10 lines, from 1) of each order line in key order."""
    o = demo.table(spark, sf_dir, "orders").select("o_orderkey")
    return listing.with_chunks(o, ["o_orderkey"], 10, first_chunk=1)


def _manifest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sets.compare_files(demo.disk_paths(spark, sf_dir), demo.manifest_paths(spark, sf_dir),
                              carry=["dir"])


@query
def manifest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1: each path with its set (only on disk / only in index / common)."""
    return _manifest_status(spark, sf_dir)


@query
def manifest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per folder and up-to-date state."""
    return sets.manifest_summary(_manifest_status(spark, sf_dir), "dir")


@query
def only_on_disk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``dicomfiles`` selection."""
    return sets.select_sets(_manifest_status(spark, sf_dir), ["dicomfiles"])


@query
def sessions_with_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 + K7: sessions having both ``view`` and ``purchase`` folders."""
    return sets.sessions_with_all(demo.session_dirs(spark, sf_dir), ["view", "purchase"])


@query
def not_in_keep_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top folders not on the keep-list."""
    return sets.not_in_keep_list(demo.top_folders(spark, sf_dir), demo.keep_list(spark, sf_dir))


@query
def dir_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and files per folder."""
    return listing.dir_sizes(demo.dir_files(spark, sf_dir))


@query
def running_peak(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running maximum size per folder in (ts, event_id) order."""
    s = demo.size_samples(spark, sf_dir)
    return listing.running_peak(s, ["ts", "event_id"]).select("event_id", "dir", "bytes", "peak_bytes")


@query
def size_to_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size text to bytes."""
    n = demo.file_names(spark, sf_dir)
    return n.select("p_partkey", "size_text", text.size_to_bytes("size_text").alias("bytes"))


@query
def dicom_name_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index-check name rule."""
    n = demo.file_names(spark, sf_dir)
    return n.select("p_partkey", "name", names.is_dicom_name_prefix("name").alias("is_dicom"))


@query
def dicom_name_stem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """De-identification name rule (on the stem)."""
    n = demo.file_names(spark, sf_dir)
    return n.select("p_partkey", "name", names.stem("name").alias("stem"),
                    names.is_dicom_name_stem("name").alias("is_dicom"))


@query
def readable_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X11: ``.dcm`` exactly or no suffix."""
    n = demo.file_names(spark, sf_dir)
    return n.select("p_partkey", "name", names.suffix("name").alias("ext"),
                    names.is_readable_name("name").alias("readable"))


# Fixed value: the tag list used by the selection queries (keyword and tag text).
TAG_LIST = ["PatientID", "(0010, 0030)"]


def _elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = demo.elements(spark, sf_dir)
    return e.withColumn("sort_key", elements.position_key()).drop("elem_pos")


@query
def tag_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matching elements at any depth."""
    e = demo.elements(spark, sf_dir)
    return elements.select_tags(e, TAG_LIST).select(
        "file_path", elements.position_key().alias("sort_key"), "depth", "tag", "vr", "keyword", "value")


@query
def tag_select_top_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matching non-sequence elements at the top level."""
    e = demo.elements(spark, sf_dir)
    return elements.select_tags_top_level(e, TAG_LIST).select(
        "file_path", elements.position_key().alias("sort_key"), "tag", "vr", "keyword", "value")


@query
def tag_report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indented pre-order report of all elements."""
    return elements.report_lines(demo.elements(spark, sf_dir), None, all_tags=True)


@query
def max_files_per_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First five readable files per folder, with failures before them."""
    return elements.first_files_per_dir(demo.dir_files(spark, sf_dir), 5)


@query
def tree_top4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record tree with the first four images per level."""
    # records feed two branches (images, other records): numbered once
    return elements.tree_listing(materialize(demo.dicomdir_records(spark, sf_dir))).drop("sort_key")


@query
def dicomdir_referenced_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files named by IMAGE records below their index's folder."""
    r = demo.dicomdir_records(spark, sf_dir).withColumnRenamed("dicomdir_path", "directory")
    return readers.dicomdir_file_paths(r, "directory")


@query
def rename_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8 + A9: sort-target path per file and target collisions."""
    return listing.sort_targets(demo.rename_elements(spark, sf_dir))


@query
def id_map_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 + A4: one new id per old id, the last line winning."""
    return deid.last_wins(demo.id_map_rows(spark, sf_dir))


@query
def deid_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 + X15: header edits for files of mapped subjects."""
    return deid.anonymize_elements(_elements(spark, sf_dir), demo.customer_id_map(spark, sf_dir))


@query
def deid_nested_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers left inside sequences."""
    return deid.nested_identifier_audit(_elements(spark, sf_dir)).select(
        "file_path", "sort_key", "keyword", "value")


@query
def deid_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3/D4 with J6, J7, J9: per-file action plan."""
    # the listing is read twice (session flags, file rows): computed once
    tree = materialize(demo.subject_tree(spark, sf_dir), spread=True)
    return deid.deid_plan(tree, demo.customer_id_map(spark, sf_dir), demo.done_sessions(spark, sf_dir))


@query
def peak_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current and peak size per folder, Structured Streaming over the
    events file, run until caught up."""
    schema = demo.table(spark, sf_dir, "events").schema
    s = peak.stream_samples(spark, sf_dir, schema, file_glob="events.parquet")
    samples = s.select(F.col("user_id").cast("string").alias("dir"), "ts", "event_id",
                       F.col("value").alias("bytes"))
    agg = peak.peak_aggregate(samples, order_cols=("ts", "event_id"))
    return peak.run_until_caught_up(agg)


# Fixed value: sample volume shape (non-cubic, 64 voxels per embedding row).
VOLUME_SHAPE = (2, 4, 8)


@query
def volume_tensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embedding rows written as NIfTI files to the shared folder, then
    decoded, scaled and flattened by the tensor job."""
    vols = demo.volumes(spark, sf_dir)
    out = shared_dir(spark, "volumes")
    tensors.write_sample_volumes(vols, out, VOLUME_SHAPE).write.format("noop").mode("overwrite").save()
    paths = vols.select("vec_id", "dx", F.concat(F.lit(out + "/"), F.col("vec_id").cast("string"),
                                                F.lit(".nii.gz")).alias("path"))
    t = tensors.volumes_to_tensors(paths, keep=["vec_id"])
    return t.select("vec_id", F.posexplode("raw").alias("idx", "value")) \
        .withColumn("idx", F.col("idx").cast("long"))


@query
def subject_split_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 + W9: the split with at most three sessions per subject in train."""
    return split.split_train_val_test(_cohort(spark, sf_dir, True), TRAIN, VAL,
                                      order_cols=SPLIT_ORDER, caps={"train": 3})


@query
def deid_elements_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 with ``deep=True``: the header edit applied inside sequences too."""
    return deid.anonymize_elements(_elements(spark, sf_dir), demo.customer_id_map(spark, sf_dir),
                                   deep=True)


@query
def dicom_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's header elements written as a JSON file to the shared
    folder, then read back by the element job through its decoder argument."""
    e = demo.elements(spark, sf_dir)
    out = shared_dir(spark, "headers")
    headers.write_header_files(e, out).write.format("noop").mode("overwrite").save()
    paths = e.select("subject").distinct().select(
        "subject", F.concat(F.lit(out + "/"), F.col("subject"), F.lit(".json")).alias("file_path"))
    decoded = headers.header_elements(paths.select(F.col("file_path").alias("path")), headers.decode_json_elements)
    return decoded.join(paths, "file_path").select(
        "subject", elements.position_key().alias("sort_key"), "depth", "tag", "vr", "keyword", "value")


def _walked(spark: SparkSession, sf_dir: str, out: str) -> DataFrame:
    """Entries of the written tree of orders, walked portion by portion."""
    found = demo.tree_in_portions(demo.order_tree(spark, sf_dir), out, lambda: walk.tree_entries(spark, out))
    return walk.each_folder_once(found)


@query
def tree_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 with S7 and S9's name rules: a tree of files and folders (some empty) written
    from orders to the shared folder, walked by the executors."""
    file = F.col("kind") == "file"
    return _walked(spark, sf_dir, shared_dir(spark, "tree")).select(
        "rel", "kind", "size", F.coalesce(file & names.is_dicom_name_prefix("name"), F.lit(False)).alias("is_dicom"),
        F.coalesce(file & names.is_readable_name("name"), F.lit(False)).alias("readable"))


@query
def record_tree_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W6/C6 on three levels: patient, study per order, record per line, read from the
    nested elements of one index file per customer."""
    # the element rows stand for files already decoded: made once, read by several branches
    found = records.records_from_elements(materialize(demo.index_elements(spark, sf_dir)))
    return elements.tree_listing(materialize(found)).drop("pos")


@query
def record_tree_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W6/C6 on the same records as a flat list linked by offsets."""
    return elements.tree_listing(records.records_from_offsets(demo.index_offsets(spark, sf_dir))).drop("pos")


@query
def tensor_chunk_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2/K3: volumes in vec_id order written as numbered files of 128, read back with
    each row's file number and place."""
    from cohortlake.sinks import chunks
    vols = demo.volumes(spark, sf_dir)
    out = shared_dir(spark, "volumes")
    tensors.write_sample_volumes(vols, out, VOLUME_SHAPE).write.format("noop").mode("overwrite").save()
    paths = vols.select("vec_id", "dx", F.concat(F.lit(out + "/"), F.col("vec_id").cast("string"), F.lit(".nii.gz")).alias("path"))
    made = shared_dir(spark, "chunks")
    chunks.write_tensor_chunks(paths, made, ["vec_id"])
    return chunks.read_tensor_chunks(spark, made).select("chunk", "row", "dx", F.col("raw")[0].alias("first"), F.size("raw").cast("long").alias("n"))


def _strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that ordered, with two attributes to balance by."""
    seen = demo.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return (demo.table(spark, sf_dir, "customer").join(seen, "c_custkey", "left_semi")
            .select(F.col("c_custkey").cast("string").alias("ptid"), F.col("c_mktsegment").alias("segment"),
                    F.floor(F.col("c_acctbal") / 2500).cast("long").alias("band")))


@query
def split_stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 + W1: subjects dealt to splits of exact size, alike in segment and balance band."""
    return strata.assign_stratified(_strata(spark, sf_dir), ["segment", "band"], TRAIN, VAL)


@query
def split_stratified_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per stratum and split, subjects and how far they are off the split's share."""
    got = strata.assign_stratified(_strata(spark, sf_dir), ["segment", "band"], TRAIN, VAL)
    return (strata.stratum_gaps(got, ["segment", "band"])
            .withColumn("gap", F.round("gap", 6)))


@query
def first_files_waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five readable files per folder of a written tree, decoded in waves."""
    out = shared_dir(spark, "header_tree")
    demo.write_tree(demo.header_tree(spark, sf_dir), out)
    files = (walk.tree_entries(spark, out).where("kind = 'file'").where(names.is_readable_name("name"))
             .select(F.col("parent").alias("dir"), "name", "path"))
    status, read, _ = waves.read_first_files(files, lambda p: headers.header_elements(p, headers.decode_json_elements), 5)
    value = read.groupBy(F.col("file_path").alias("path")).agg(F.max("value").alias("value"))
    return status.join(value, "path", "left").select(F.element_at(F.split("dir", "/"), -1).alias("dir"), "name", "status", "value")


@query
def bids_tree_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 + S4: a BIDS tree written from the visits, read with filters that prune its
    listing: images of two kinds in the first three sessions."""
    out = shared_dir(spark, "bids")

    def first():
        b = bids.read_bids_tree(spark, out)
        return b.where(F.col("session").isin("ses-M000", "ses-M006", "ses-M012") & F.col("suffix").isin("T1w", "pet")
                       & (F.col("extension") == "nii.gz"))

    return (demo.tree_in_portions(demo.bids_tree(spark, sf_dir), out, first)
            .select("filename", "subject", "session", "datatype", "suffix", "tracer", "size"))


@query
def manifest_digest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 by folder digests: each path with its set; only folders that differ are joined by path."""
    return digests.compare_by_digest(demo.deep_disk_paths(spark, sf_dir), demo.deep_manifest_paths(spark, sf_dir))


@query
def manifest_digest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 by folder digests."""
    return digests.summary_by_digest(demo.deep_disk_paths(spark, sf_dir), demo.deep_manifest_paths(spark, sf_dir))


@query
def manifest_digest_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which folders agree with the index in all that is below them."""
    disk, index = demo.deep_disk_paths(spark, sf_dir), demo.deep_manifest_paths(spark, sf_dir)
    return digests.differing_trees(disk, index.distinct())


@query
def identifiers_in_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customers' names and ids found in comments, private tags and nested elements."""
    e = materialize(demo.elements_with_comments(spark, sf_dir), spread=True)
    return (leaks.identifiers_in_text(e, keywords=["PatientName", "PatientID"])
            .withColumn("sort_key", elements.position_key()).drop("elem_pos"))


@query
def anonymize_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4 on files: input and output trees and an id map written from customers, the
    planned header files decoded and edited."""
    base = shared_dir(spark, "anonymize")
    here, done = demo.patient_trees(spark, sf_dir)
    demo.write_tree(here, f"{base}/in")
    demo.write_tree(done, f"{base}/out")
    demo.customer_id_map(spark, sf_dir).write.csv(f"{base}/ids")
    got = jobs.anonymize(spark, f"{base}/in", f"{base}/ids", f"{base}/out", decoder=headers.decode_json_elements)["elements"]
    return got.select(F.regexp_extract("target", "/out/(.*)$", 1).alias("target"), "tag", "keyword", "value", "new_id")


@query
def check_manifest_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7 on files: a written tree against the records of its index."""
    out = shared_dir(spark, "tree")
    got = jobs.check_manifest(spark, out, demo.order_records(spark, sf_dir), entries=_walked(spark, sf_dir, out))["status"]
    return got.select(F.expr("substring(path, length(dir) + 2)").alias("rel"), "status")


@query
def training_set_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2 on files: volumes and tables to splits and numbered tensor files, read back."""
    from cohortlake.plans import training
    from cohortlake.sinks import chunks
    base = shared_dir(spark, "training")
    volumes = f"{base}/derivatives"
    tensors.write_sample_volumes(demo.volumes(spark, sf_dir), volumes, VOLUME_SHAPE).write.format("noop").mode("overwrite").save()
    layout, visits = demo.vector_visits(spark, sf_dir, volumes)
    paths = training.build_training_set(layout, visits, f"{base}/set", train=TRAIN, val=VAL, ordered=True)
    return chunks.read_tensor_chunks(spark, paths["tensors"]).select("split", "chunk", "row", "dx", F.col("raw")[0].alias("first"))


@query
def volume_slab_tensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volumes decoded slab by slab, two slabs a file."""
    vols = demo.volumes(spark, sf_dir)
    out = shared_dir(spark, "volumes")
    tensors.write_sample_volumes(vols, out, VOLUME_SHAPE).write.format("noop").mode("overwrite").save()
    paths = vols.select("vec_id", "dx", F.concat(F.lit(out + "/"), F.col("vec_id").cast("string"), F.lit(".nii.gz")).alias("path"))
    slabs = tensors.volume_slabs(paths, buffer_bytes=200, keep=["vec_id"])
    return (slabs.select("vec_id", "start", F.posexplode("raw").alias("at", "value"))
            .select("vec_id", (F.col("start") + F.col("at")).alias("idx"), "value"))
