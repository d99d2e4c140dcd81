"""De-identification on element tables and the file action plan
(D1-D4, J6, J7, J9, A4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.functions.names import base_name, is_dicom_name_stem
from cohortlake.functions.text import birth_year_only

# What the header edit touches.
REMOVED_KEYWORDS = ["PatientID", "FileSetID"]
RENAMED_KEYWORD = "PatientName"
BIRTH_DATE_KEYWORD = "PatientBirthDate"
IDENTIFYING_KEYWORDS = ["PatientName", "PatientID", "PatientBirthDate", "FileSetID"]


def last_wins(rows: DataFrame, key: str = "old_id", value: str = "new_id",
              pos: str = "pos", keep_pos: bool = False) -> DataFrame:
    """A4: one value per key, the one at the highest position (later lines
    overwrite earlier ones).  Rows without both fields are rejected.
    ``keep_pos`` adds the position where the key first stands."""
    ok = rows.filter(F.col(key).isNotNull() & F.col(value).isNotNull())
    first = [F.min(pos).alias(pos)] if keep_pos else []
    return ok.groupBy(key).agg(F.max_by(value, pos).alias(value), *first)


def anonymize_elements(elements: DataFrame, id_map: DataFrame, subject_col: str = "subject",
                       deep: bool = False) -> DataFrame:
    """For files of mapped subjects, PatientName := new id, PatientID and
    FileSetID removed, birth date cut to the year (``YYYY0101``).  Top level
    only (as the source tool) unless ``deep``.  Files of unmapped subjects
    are not processed."""
    m = id_map.select(F.col("old_id").alias(subject_col), "new_id")
    e = elements.join(m, subject_col, "inner")
    scope = F.lit(True) if deep else (F.col("depth") == 0)
    kept = e.filter(~(scope & F.col("keyword").isin(REMOVED_KEYWORDS)))
    value = (F.when(scope & (F.col("keyword") == RENAMED_KEYWORD), F.col("new_id"))
              .when(scope & (F.col("keyword") == BIRTH_DATE_KEYWORD), birth_year_only("value"))
              .otherwise(F.col("value")))
    cols = [c for c in elements.columns if c != "value"]
    return kept.select(*cols, value.alias("value"), "new_id")


def nested_identifier_audit(elements: DataFrame) -> DataFrame:
    """Identifying elements inside sequences, which D1 leaves in place."""
    return elements.filter((F.col("depth") > 0) & F.col("keyword").isin(IDENTIFYING_KEYWORDS))


def _parts(listing: DataFrame, root: str) -> DataFrame:
    """(old_id, session, rest) of paths ``<root>/<subject>/<session>/<rest>``;
    paths elsewhere are dropped.  The filter is on the raw path (one anchored
    match) so the split is computed once, not once per derived column."""
    prefix = root.rstrip("/") + "/"
    p = F.col("path")
    inside = p.rlike(r"^\Q" + prefix + r"\E[^/]+/[^/]+/.")
    parts = F.split(p.substr(len(prefix) + 1, 1 << 30), "/", 3)
    return (listing.filter(inside).select("path", parts.alias("_p"))
            .select("path", F.col("_p")[0].alias("old_id"), F.col("_p")[1].alias("session"),
                    F.col("_p")[2].alias("rest")))


def deid_plan(input_files: DataFrame, id_map: DataFrame, output_files: DataFrame,
              input_root: str = "input", output_root: str = "output") -> DataFrame:
    """D3/D4 with J6, J7, J9: what de-identification would do, as a table
    ``(old_id, new_id, session, source, target, action)``; nothing is
    written.  Actions: ``anonymize`` (DICOMDIR and DICOM-named files below
    ``DICOM/``), ``copy`` (other files below ``DICOM/``, unchanged),
    ``skip_no_subject`` (map entry without a folder), ``skip_exists``
    (session already in the output), ``skip_target_taken`` (another subject of
    the same new id, earlier in ``pos`` order of the map or, without that column,
    in old_id order, has a session of that name), ``warn_no_dicomdir``, ``warn_no_dicom``,
    ``not_mapped`` (a session of a folder without a map entry: reported,
    never touched)."""
    src = _parts(input_files, input_root)
    order = F.struct(*(["pos"] if "pos" in id_map.columns else []), "old_id")
    ids = id_map.select("old_id", "new_id", order.alias("_order"))
    done = (_parts(output_files, output_root)
            .select(F.col("old_id").alias("new_id"), "session").distinct()
            .withColumn("_done", F.lit(True)))
    # one row per session: what it holds (J9) and whether it is done (J7);
    # the full outer join also yields one row (session NULL) per map entry
    # without any folder (J6).  Folders without a map entry get no new id.
    flags = src.groupBy("old_id", "session").agg(
        F.max(F.col("rest") == "DICOMDIR").alias("has_dicomdir"),
        F.max(F.col("rest").startswith("DICOM/")).alias("has_dicom"))
    sess = (flags.join(ids, "old_id", "full_outer")
            .join(done, ["new_id", "session"], "left")
            .withColumn("_done", F.coalesce(F.col("_done"), F.lit(False))))
    # one subject's session per target: the first one in map order
    live = F.col("new_id").isNotNull() & F.col("session").isNotNull() & ~F.col("_done")
    first = sess.filter(live).groupBy("new_id", "session").agg(F.min("_order").alias("_first"))
    sess = (sess.join(first, ["new_id", "session"], "left")
            .withColumn("_taken", F.coalesce(F.col("_order") != F.col("_first"), F.lit(False))))
    root_in, root_out = F.lit(input_root.rstrip("/")), F.lit(output_root.rstrip("/"))
    mapped = F.col("new_id").isNotNull()
    has_session = F.col("session").isNotNull()
    live = live & ~F.col("_taken")

    # session-level rows and map entries without a folder, in one pass
    acts = F.filter(F.array(
        F.when(~mapped & has_session, F.lit("not_mapped")),
        F.when(mapped & ~has_session, F.lit("skip_no_subject")),
        F.when(mapped & has_session & F.col("_done"), F.lit("skip_exists")),
        F.when(F.col("_taken"), F.lit("skip_target_taken")),
        F.when(live & ~F.col("has_dicomdir"), F.lit("warn_no_dicomdir")),
        F.when(live & ~F.col("has_dicom"), F.lit("warn_no_dicom"))),
        lambda a: a.isNotNull())
    session_rows = (sess.select("old_id", "new_id", "session", F.explode(acts).alias("action"))
                    .select("old_id", "new_id", "session",
                            F.when(F.col("session").isNotNull(),
                                   F.concat_ws("/", root_in, "old_id", "session")).alias("source"),
                            F.when(F.col("action").isin("skip_exists", "skip_target_taken"),
                                   F.concat_ws("/", root_out, "new_id", "session")).alias("target"),
                            "action"))

    files = (src.filter((F.col("rest") == "DICOMDIR") | F.col("rest").startswith("DICOM/"))
             .join(sess.filter(live).select("old_id", "session", "new_id"),
                   ["old_id", "session"], "inner"))
    action = (F.when(F.col("rest") == "DICOMDIR", F.lit("anonymize"))
               .when(is_dicom_name_stem(base_name("rest")), F.lit("anonymize"))
               .otherwise(F.lit("copy")))
    file_rows = files.select(
        "old_id", "new_id", "session", F.col("path").alias("source"),
        F.concat_ws("/", root_out, "new_id", "session", "rest").alias("target"),
        action.alias("action"))
    return session_rows.unionByName(file_rows)
