r"""DuckDB SQL oracles for the registered queries.

Written independently of the Spark code: the adapters of FIXTURES.md are
CTEs here, and each query is plain SQL over the driver's views.  Column
names equal the Spark query's; integer aggregates are cast to BIGINT.
"""

from __future__ import annotations


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


# ------------------------------------------------------------------ adapters
VISITS = r"""
vv AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority, visit,
         visit * 6 AS mo,
         CASE WHEN o_custkey >= 10000000 THEN CAST(o_custkey // 10000 AS VARCHAR)
              ELSE lpad(CAST(o_custkey // 10000 AS VARCHAR), 3, '0') END AS A,
         lpad(CAST(o_custkey % 10000 AS VARCHAR), 4, '0') AS B
  FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS visit
        FROM orders) t)
"""

LAYOUT = r"""
layout AS (
  SELECT 'sub-ADNI' || A || 'S' || B || '_ses-M' || CASE WHEN mo >= 1000 THEN CAST(mo AS VARCHAR) ELSE lpad(CAST(mo AS VARCHAR), 3, '0') END || '_T1w.nii.gz' AS filename,
         CASE WHEN o_orderkey % 5 = 0 THEN '/raw/' ELSE '/derivatives/' END || 'sub-ADNI' || A || 'S' || B AS path,
         CASE WHEN o_orderkey % 3 = 0 THEN 'pet' ELSE 'T1w' END AS suffix,
         'nii.gz' AS extension, 'Crop' AS "desc", '1x1x1' AS res,
         CASE WHEN o_orderkey % 3 = 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN '18FFDG' ELSE '18FAV45' END END AS tracer,
         CASE WHEN o_orderkey % 3 = 0 THEN 'coregiso' END AS reconstruction
  FROM vv)
"""

CLINICAL = r"""
clinical AS (
  SELECT 'ADNI' || CAST(1 + year(o_orderdate) % 4 AS VARCHAR) AS COLPROT,
         A || '_S_' || B AS PTID,
         CASE WHEN visit = 0 THEN 'bl' ELSE 'm' || CAST(mo AS VARCHAR) END AS VISCODE,
         CASE o_orderstatus WHEN 'F' THEN ' CN ' WHEN 'O' THEN 'MCI' WHEN 'P' THEN chr(9) || 'Dementia' END AS DX
  FROM vv)
"""

ENTITY = "'(sub-[A-Z0-9]+)_(ses-[A-Za-z][0-9]+)'"
PTID_RE = "'^sub-ADNI([0-9]{3})([A-Za-z])([0-9]{4})$'"


def _session(code: str) -> str:
    x = f"regexp_replace({code}, '^m', '')"
    return (f"CASE WHEN {code} = 'bl' THEN 'ses-M000' ELSE 'ses-M' || "
            f"(CASE WHEN length({x}) >= 3 THEN {x} ELSE lpad({x}, 3, '0') END) END")


VISITS_NORM = r"""
visits AS (
  SELECT * FROM (
    SELECT COLPROT AS phase,
           regexp_replace(PTID, """ + PTID_RE + r""", '\1_\2_\3') AS ptid,
           """ + _session("VISCODE") + r""" AS session,
           lower(regexp_replace(DX, '^\s+|\s+$', '', 'g')) AS dx
    FROM clinical) t
  WHERE phase IN ('ADNI2', 'ADNI3') AND dx IN ('cn', 'mci', 'dementia'))
"""

IMAGES_T1 = r"""
images AS (
  SELECT *,
         regexp_replace(nullif(regexp_extract(filename, """ + ENTITY + r""", 1), ''), """ + PTID_RE + r""", '\1_\2_\3') AS ptid,
         nullif(regexp_extract(filename, """ + ENTITY + r""", 2), '') AS session
  FROM layout
  WHERE suffix = 'T1w' AND extension = 'nii.gz' AND contains(path, 'derivatives')
    AND "desc" = 'Crop' AND res = '1x1x1')
"""

COHORT = r"""
cohort AS (
  SELECT i.filename, i.path, i.suffix, i.extension, i."desc", i.res, i.tracer, i.reconstruction,
         i.ptid, i.session, v.phase, v.dx
  FROM images i JOIN visits v ON i.ptid = v.ptid AND i.session = v.session)
"""

ORACLE: dict[str, str] = {}

ORACLE["cohort_inner_join"] = _with(VISITS, LAYOUT, CLINICAL, IMAGES_T1, VISITS_NORM, COHORT) + \
    "SELECT * FROM cohort"

ORACLE["included_subjects_semi"] = _with(VISITS, LAYOUT, CLINICAL, r"""
l AS (
  SELECT regexp_extract(filename, '^(sub-[A-Z0-9]+)_(ses-[A-Za-z][0-9]+)', 1) AS participant_id,
         regexp_extract(filename, '^(sub-[A-Z0-9]+)_(ses-[A-Za-z][0-9]+)', 2) AS session_id
  FROM layout WHERE suffix = 'pet' AND tracer = '18FFDG' AND reconstruction = 'coregiso')
""", r"""
r AS (
  SELECT regexp_replace(PTID, '([0-9]+)_(S)_([0-9]+)', 'sub-ADNI\1\2\3', 'g') AS participant_id,
         """ + _session("VISCODE") + r""" AS session_id
  FROM clinical WHERE COLPROT IN ('ADNI1', 'ADNI2', 'ADNI3', 'ADNI4', 'ADNIGO'))
""") + r"""
SELECT participant_id, session_id FROM l
WHERE EXISTS (SELECT 1 FROM r WHERE r.participant_id = l.participant_id AND r.session_id = l.session_id)
"""

ORACLE["entity_extract"] = _with(VISITS, LAYOUT) + r"""
SELECT filename, path,
       nullif(regexp_extract(filename, """ + ENTITY + r""", 1), '') AS subject,
       nullif(regexp_extract(filename, """ + ENTITY + r""", 2), '') AS session,
       regexp_replace(nullif(regexp_extract(filename, """ + ENTITY + r""", 1), ''), """ + PTID_RE + r""", '\1_\2_\3') AS ptid,
       nullif(regexp_extract(path, """ + ENTITY + r""", 1), '') AS path_subject
FROM layout
"""

ORACLE["visit_session_label"] = r"""
SELECT o_orderkey, viscode, """ + _session("viscode") + r""" AS session
FROM (SELECT o_orderkey,
             CASE WHEN o_orderkey % 7 = 0 THEN 'bl' WHEN o_orderkey % 11 = 0 THEN NULL
                  WHEN o_orderkey % 13 = 0 THEN 'sc' ELSE 'm' || CAST(o_orderkey AS VARCHAR) END AS viscode
      FROM orders) t
"""

ORACLE["dx_normalise_counts"] = _with(VISITS, CLINICAL) + r"""
SELECT phase, dx, count(*) AS n, dx IN ('cn', 'mci', 'dementia') AS is_valid
FROM (SELECT COLPROT AS phase, lower(regexp_replace(DX, '^\s+|\s+$', '', 'g')) AS dx FROM clinical) t
GROUP BY phase, dx
"""

ORACLE["pet_image_filter"] = _with(VISITS, LAYOUT) + r"""
SELECT *,
       regexp_replace(nullif(regexp_extract(filename, """ + ENTITY + r""", 1), ''), """ + PTID_RE + r""", '\1_\2_\3') AS ptid,
       nullif(regexp_extract(filename, """ + ENTITY + r""", 2), '') AS session
FROM layout
WHERE suffix = 'pet' AND extension = 'nii.gz' AND contains(path, 'derivatives')
  AND "desc" = 'Crop' AND res = '1x1x1' AND tracer = '18FFDG' AND reconstruction = 'coregiso'
"""


def _assign(subjects_sql: str) -> str:
    return r"""
subj AS (""" + subjects_sql + r"""),
rk AS (SELECT ptid, row_number() OVER (ORDER BY md5(ptid || ':22'), ptid) - 1 AS pos,
              CAST(count(*) OVER () AS DOUBLE) AS n FROM subj),
asg AS (SELECT ptid,
               CASE WHEN pos < round_even(n * 0.8, 0) THEN 'train'
                    WHEN pos < round_even(n * 0.8, 0) + round_even(n * 0.1, 0) THEN 'val'
                    ELSE 'test' END AS split
        FROM rk)
"""


SPLIT_ROWS = r"""
routed AS (SELECT c.*, a.split FROM cohort c JOIN asg a ON c.ptid = a.ptid),
split_rows AS (
  SELECT * FROM routed WHERE split = 'train'
  UNION ALL
  SELECT * EXCLUDE (r) FROM (
    SELECT *, row_number() OVER (PARTITION BY ptid, split ORDER BY session, path, filename) AS r
    FROM routed WHERE split <> 'train') t
  WHERE r = 1)
"""

_COHORT_CTES = (VISITS, LAYOUT, CLINICAL, IMAGES_T1, VISITS_NORM, COHORT)

ORACLE["subject_split_rows"] = _with(*_COHORT_CTES, _assign(
    "SELECT DISTINCT ptid FROM cohort WHERE ptid IS NOT NULL"), SPLIT_ROWS) + "SELECT * FROM split_rows"

ORACLE["subject_split_sizes"] = _with(*_COHORT_CTES, _assign(
    "SELECT DISTINCT ptid FROM cohort WHERE ptid IS NOT NULL"), SPLIT_ROWS) + r"""
SELECT split, count(*) AS n_rows, count(DISTINCT ptid) AS n_subjects FROM split_rows GROUP BY split
"""

ORACLE["hash_split"] = r"""
SELECT c_custkey,
       CASE WHEN u < 0.8 THEN 'train' WHEN u < CAST(0.8 AS DOUBLE) + CAST(0.1 AS DOUBLE) THEN 'val'
            ELSE 'test' END AS split
FROM (SELECT c_custkey,
             CAST(('0x' || substr(md5(CAST(c_custkey AS VARCHAR) || ':22'), 1, 8))::BIGINT AS DOUBLE)
               / 4294967296.0 AS u
      FROM customer) t
"""

LAYOUT_IDS = r"""
layout_ids AS (
  SELECT *,
         regexp_replace(nullif(regexp_extract(filename, """ + ENTITY + r""", 1), ''), """ + PTID_RE + r""", '\1_\2_\3') AS ptid,
         nullif(regexp_extract(filename, """ + ENTITY + r""", 2), '') AS session
  FROM layout)
"""

ORACLE["first_row_per_subject"] = _with(VISITS, LAYOUT, LAYOUT_IDS) + r"""
SELECT * EXCLUDE (r) FROM (
  SELECT *, row_number() OVER (PARTITION BY ptid ORDER BY session, path, filename) AS r FROM layout_ids) t
WHERE r = 1
"""

ORACLE["session_cap"] = _with(*_COHORT_CTES) + r"""
SELECT * EXCLUDE (r) FROM (
  SELECT *, row_number() OVER (PARTITION BY ptid ORDER BY session, path, filename) AS r FROM cohort) t
WHERE r <= 3
"""

ORACLE["split_balance"] = _with(_assign("SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS ptid FROM orders"), r"""
x AS (SELECT a.split, c.c_acctbal, c.c_mktsegment
      FROM asg a JOIN customer c ON a.ptid = CAST(c.c_custkey AS VARCHAR))
""", r"""
long AS (
  SELECT split, 'n' AS metric, CAST(count(*) AS DOUBLE) AS value FROM x GROUP BY split
  UNION ALL SELECT split, 'mean:c_acctbal', avg(c_acctbal) FROM x GROUP BY split
  UNION ALL SELECT split, 'std:c_acctbal', stddev_samp(c_acctbal) FROM x GROUP BY split
  UNION ALL
  SELECT s.split, 'share:c_mktsegment=' || coalesce(s.c_mktsegment, 'NULL'),
         CAST(s.k AS DOUBLE) / t.tot
  FROM (SELECT split, c_mktsegment, count(*) AS k FROM x GROUP BY split, c_mktsegment) s
  JOIN (SELECT split, count(*) AS tot FROM x GROUP BY split) t ON s.split = t.split)
""") + r"""
SELECT split, metric, round(value, 6) AS value FROM long
UNION ALL
SELECT 'max_gap', metric,
       round(max(value) - CASE WHEN starts_with(metric, 'share:') AND count(*) < (SELECT count(DISTINCT split) FROM x)
                               THEN 0 ELSE min(value) END, 6)
FROM long GROUP BY metric
"""

ORACLE["duplicate_keys"] = r"""
SELECT user_id, event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n
FROM events GROUP BY user_id, event_type, strftime(ts, '%Y-%m-%d') HAVING count(*) > 1
"""

ORACLE["tensor_scale"] = r"""
SELECT vec_id, CAST(i - 1 AS BIGINT) AS idx, CAST(CAST(embedding[i] AS DOUBLE) / 255.0 AS FLOAT) AS value
FROM embeddings, range(1, 1 + len(embedding)) r(i)
"""

ORACLE["tensor_flatten"] = r"""
SELECT vec_id, CAST(i - 1 AS BIGINT) AS idx, embedding[i] AS value
FROM embeddings, range(1, 1 + len(embedding)) r(i)
"""

ORACLE["volume_tensors"] = ORACLE["tensor_scale"]

ORACLE["tensor_chunks"] = r"""
SELECT vec_id, pos // 128 AS chunk_id, pos % 128 + 1 AS line_in_chunk
FROM (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS pos FROM embeddings) t
"""

ORACLE["tsv_chunks"] = r"""
SELECT o_orderkey, pos // 10 + 1 AS chunk_id, pos % 10 + 1 AS line_in_chunk
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM orders) t
"""

MANIFEST = r"""
m AS (SELECT DISTINCT 'dir' || CAST(o_orderkey % 20 AS VARCHAR) || '/IM_' || CAST(o_orderkey AS VARCHAR) AS path,
                      o_orderkey % 20 AS dir
      FROM orders WHERE o_orderkey % 11 <> 0),
d AS (SELECT DISTINCT 'dir' || CAST(l_orderkey % 20 AS VARCHAR) || '/IM_' || CAST(l_orderkey AS VARCHAR) AS path,
                      l_orderkey % 20 AS dir
      FROM lineitem),
status AS (
  SELECT path, dir, 'common' AS status FROM d WHERE EXISTS (SELECT 1 FROM m WHERE m.path = d.path)
  UNION ALL
  SELECT path, dir, 'only_on_disk' FROM d WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.path = d.path)
  UNION ALL
  SELECT path, dir, 'only_in_manifest' FROM m WHERE NOT EXISTS (SELECT 1 FROM d WHERE m.path = d.path))
"""

ORACLE["manifest_status"] = _with(MANIFEST) + "SELECT * FROM status"

ORACLE["manifest_summary"] = _with(MANIFEST) + r"""
SELECT dir,
       count(*) FILTER (WHERE status = 'only_on_disk') AS n_only_on_disk,
       count(*) FILTER (WHERE status = 'only_in_manifest') AS n_only_in_manifest,
       count(*) FILTER (WHERE status = 'common') AS n_common,
       CASE WHEN count(*) FILTER (WHERE status <> 'common') = 0 THEN 'up_to_date' ELSE 'out_of_date' END AS state
FROM status GROUP BY dir
"""

ORACLE["only_on_disk"] = _with(MANIFEST) + "SELECT * FROM status WHERE status = 'only_on_disk'"

ORACLE["sessions_with_all"] = r"""
SELECT CAST(user_id AS VARCHAR) AS participant_id, strftime(ts, '%Y-%m-%d') AS session_id
FROM events WHERE event_type = 'view'
INTERSECT
SELECT CAST(user_id AS VARCHAR), strftime(ts, '%Y-%m-%d') FROM events WHERE event_type = 'purchase'
"""

ORACLE["not_in_keep_list"] = r"""
SELECT CAST(doc_id AS VARCHAR) AS name FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.quality = 1 AND l.doc_id = d.doc_id)
"""

ORACLE["dir_size"] = r"""
SELECT source AS dir, CAST(sum(n_chars) AS BIGINT) AS bytes, count(*) AS n_files FROM documents GROUP BY source
"""

ORACLE["running_peak"] = r"""
SELECT event_id, CAST(user_id AS VARCHAR) AS dir, value AS bytes,
       max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS peak_bytes
FROM events
"""

NAMES = r"""
names AS (
  SELECT p_partkey,
         CASE p_partkey % 6
              WHEN 0 THEN 'IM_' || lpad(CAST(p_partkey % 10000 AS VARCHAR), 4, '0')
              WHEN 1 THEN 'IM_' || lpad(CAST(p_partkey % 100000 AS VARCHAR), 5, '0')
              WHEN 2 THEN 'IM_' || CAST(p_partkey % 10 AS VARCHAR)
              WHEN 3 THEN CAST(p_partkey AS VARCHAR) || '.DCM'
              WHEN 4 THEN '12_' || lpad(CAST(p_partkey % 10000 AS VARCHAR), 4, '0')
              ELSE 'DICOMDIR' END AS name,
         CASE p_size % 4 WHEN 0 THEN '1.5G' WHEN 1 THEN '4.0K' WHEN 2 THEN '512' ELSE '20M' END AS size_text
  FROM part),
parts AS (
  SELECT *, regexp_extract(name, '^.+(\.[^.]+)$', 1) AS sfx FROM names),
parts2 AS (
  SELECT *, substr(name, 1, length(name) - length(sfx)) AS stm FROM parts)
"""

ORACLE["size_to_bytes"] = _with(NAMES) + r"""
SELECT p_partkey, size_text,
       CAST(nullif(regexp_extract(size_text, '^([0-9]+)(\.[0-9]*)?[KMGT]?$', 1), '') AS BIGINT)
       * CASE regexp_extract(size_text, '([KMGT])$', 1)
              WHEN 'K' THEN 1024 WHEN 'M' THEN 1048576 WHEN 'G' THEN 1073741824
              WHEN 'T' THEN 1099511627776 ELSE 1 END AS bytes
FROM names
"""

# the source rules written as they read: name[:2] letters, name[2] '_', name[3:7] digits
ORACLE["dicom_name_prefix"] = _with(NAMES) + r"""
SELECT p_partkey, name,
       lower(sfx) = '.dcm'
       OR (regexp_matches(substr(name, 1, 2), '^[A-Za-z]{2}$') AND substr(name, 3, 1) = '_'
           AND regexp_matches(substr(name, 4, 4), '^[0-9]+$')) AS is_dicom
FROM parts
"""

ORACLE["dicom_name_stem"] = _with(NAMES) + r"""
SELECT p_partkey, name, stm AS stem,
       lower(sfx) = '.dcm'
       OR (length(stm) = 7 AND regexp_matches(substr(stm, 1, 2), '^[A-Za-z]{2}$') AND substr(stm, 3, 1) = '_'
           AND regexp_matches(substr(stm, 4), '^[0-9]+$')) AS is_dicom
FROM parts2
"""

ORACLE["readable_name"] = _with(NAMES) + r"""
SELECT p_partkey, name, sfx AS ext, (sfx = '.dcm' OR sfx = '') AS readable FROM parts
"""

ELEMENTS = r"""
elements AS (
  SELECT 'files/' || CAST(c_custkey AS VARCHAR) || '.dcm' AS file_path, CAST(c_custkey AS VARCHAR) AS subject,
         '000000' AS sort_key, 0 AS depth, '(0004,1130)' AS tag, 'CS' AS vr, 'FileSetID' AS keyword,
         c_mktsegment AS value FROM customer
  UNION ALL
  SELECT 'files/' || CAST(c_custkey AS VARCHAR) || '.dcm', CAST(c_custkey AS VARCHAR),
         '000001', 0, '(0010,0010)', 'PN', 'PatientName', c_name FROM customer
  UNION ALL
  SELECT 'files/' || CAST(c_custkey AS VARCHAR) || '.dcm', CAST(c_custkey AS VARCHAR),
         '000002', 0, '(0010,0020)', 'LO', 'PatientID', CAST(c_custkey AS VARCHAR) FROM customer
  UNION ALL
  SELECT 'files/' || CAST(c_custkey AS VARCHAR) || '.dcm', CAST(c_custkey AS VARCHAR),
         '000003', 0, '(0010,0030)', 'DA', 'PatientBirthDate',
         CASE WHEN c_custkey % 13 = 0 THEN '' ELSE CAST(1920 + c_custkey % 80 AS VARCHAR) || '0615' END
  FROM customer
  UNION ALL
  SELECT 'files/' || CAST(c_custkey AS VARCHAR) || '.dcm', CAST(c_custkey AS VARCHAR),
         '000004', 0, '(0010,1002)', 'SQ', 'OtherPatientIDsSequence', NULL FROM customer
  UNION ALL
  SELECT 'files/' || CAST(c_custkey AS VARCHAR) || '.dcm', CAST(c_custkey AS VARCHAR),
         '000004.000000.000000', 1, '(0010,0020)', 'LO', 'PatientID', CAST(c_custkey AS VARCHAR) FROM customer)
"""

ORACLE["tag_select"] = _with(ELEMENTS) + r"""
SELECT file_path, sort_key, depth, tag, vr, keyword, value FROM elements
WHERE keyword IN ('PatientID') OR upper(regexp_replace(tag, '\s+', '', 'g')) IN ('(0010,0030)')
"""

ORACLE["tag_select_top_level"] = _with(ELEMENTS) + r"""
SELECT file_path, sort_key, tag, vr, keyword, value FROM elements
WHERE (keyword IN ('PatientID') OR upper(regexp_replace(tag, '\s+', '', 'g')) IN ('(0010,0030)'))
  AND vr <> 'SQ' AND depth = 0
"""

ORACLE["tag_report_text"] = _with(ELEMENTS) + r"""
SELECT file_path, sort_key,
       repeat(' ', 4 * depth) || tag || ' ' || vr || ': ' || keyword || ' = ' || coalesce(value, '') AS text
FROM elements
"""

ORACLE["max_files_per_dir"] = r"""
SELECT dir, name, CASE WHEN ok THEN 'ok' ELSE 'error' END AS status
FROM (SELECT *, coalesce(sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (
                  PARTITION BY dir ORDER BY name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ok_before
      FROM (SELECT source AS dir, CAST(doc_id AS VARCHAR) AS name, doc_id % 7 <> 0 AS ok FROM documents) f) t
WHERE ok_before < 5
"""

RECORDS = r"""
records AS (
  SELECT 'dicomdir/' || CAST(o_custkey AS VARCHAR) AS dicomdir_path,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS pos,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'SERIES' ELSE 'IMAGE' END AS record_type,
         o_orderkey
  FROM orders)
"""

ORACLE["tree_top4"] = _with(RECORDS, r"""
img AS (SELECT *, row_number() OVER (PARTITION BY dicomdir_path ORDER BY pos) AS n
        FROM records WHERE record_type = 'IMAGE')
""") + r"""
SELECT dicomdir_path, 0 AS level, pos, 0 AS line, '|-' || record_type AS text FROM records WHERE record_type <> 'IMAGE'
UNION ALL
SELECT dicomdir_path, 0, pos, 0, CASE WHEN n <= 4 THEN '|-IMAGE' ELSE '|-(...)' END FROM img WHERE n <= 5
UNION ALL
SELECT dicomdir_path, 0, pos, 1, 'Ignoring the remaining images...' FROM img WHERE n = 5
"""

ORACLE["dicomdir_referenced_files"] = _with(RECORDS) + r"""
SELECT DISTINCT dicomdir_path || '/DICOM/IM_' || CAST(o_orderkey AS VARCHAR) AS path
FROM records WHERE record_type = 'IMAGE'
"""

ORACLE["rename_template"] = r"""
SELECT file_path, target, count(*) OVER (PARTITION BY target) AS n_same_target
FROM (SELECT 'in/' || CAST(o_orderkey AS VARCHAR) AS file_path,
             printf('%s_%03d', CAST(o_custkey AS VARCHAR), o_orderkey % 1000) || '/' ||
             printf('%s_%03d_%s_%05d.dcm', CAST(o_custkey AS VARCHAR), o_orderkey % 1000,
                    o_orderpriority, o_orderkey) AS target
      FROM orders) t
"""

ORACLE["id_map_last_wins"] = r"""
SELECT CAST(user_id AS VARCHAR) AS old_id, CAST(arg_max(event_id, event_id) AS VARCHAR) AS new_id
FROM events GROUP BY user_id
"""

IDS = r"""
ids AS (SELECT CAST(c_custkey AS VARCHAR) AS old_id,
               'ANON' || CAST(c_custkey * 7919 AS VARCHAR) AS new_id
        FROM customer WHERE c_custkey % 5 <> 0)
"""

ORACLE["deid_elements"] = _with(ELEMENTS, IDS) + r"""
SELECT e.file_path, e.subject, e.sort_key, e.depth, e.tag, e.vr, e.keyword,
       CASE WHEN e.depth = 0 AND e.keyword = 'PatientName' THEN i.new_id
            WHEN e.depth = 0 AND e.keyword = 'PatientBirthDate' AND length(e.value) > 0
              THEN substr(e.value, 1, 4) || '0101'
            ELSE e.value END AS value,
       i.new_id
FROM elements e JOIN ids i ON e.subject = i.old_id
WHERE NOT (e.depth = 0 AND e.keyword IN ('PatientID', 'FileSetID'))
"""

ORACLE["deid_nested_audit"] = _with(ELEMENTS) + r"""
SELECT file_path, sort_key, keyword, value FROM elements
WHERE depth > 0 AND keyword IN ('PatientName', 'PatientID', 'PatientBirthDate', 'FileSetID')
"""

ORACLE["deid_plan"] = _with(IDS, r"""
tree AS (
  SELECT 'input/' || CAST(o_custkey AS VARCHAR) || '/S' || CAST(o_orderkey AS VARCHAR) || '/DICOMDIR' AS path,
         CAST(o_custkey AS VARCHAR) AS old_id, 'S' || CAST(o_orderkey AS VARCHAR) AS session,
         'DICOMDIR' AS rest, 'DICOMDIR' AS name
  FROM orders WHERE o_orderkey % 4 <> 0
  UNION ALL
  SELECT 'input/' || CAST(o_custkey AS VARCHAR) || '/S' || CAST(o_orderkey AS VARCHAR) || '/DICOM/' || name,
         CAST(o_custkey AS VARCHAR), 'S' || CAST(o_orderkey AS VARCHAR), 'DICOM/' || name, name
  FROM (SELECT o_custkey, o_orderkey,
               CASE WHEN l_linenumber % 3 = 0 THEN 'IM_' || lpad(CAST(l_linenumber AS VARCHAR), 4, '0')
                    WHEN l_linenumber % 3 = 1 THEN 'img' || CAST(l_linenumber AS VARCHAR) || '.DCM'
                    ELSE 'note' || CAST(l_linenumber AS VARCHAR) || '.txt' END AS name
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderkey % 9 <> 0) f)
""", r"""
done AS (SELECT DISTINCT 'ANON' || CAST(o_custkey * 7919 AS VARCHAR) AS new_id,
                'S' || CAST(o_orderkey AS VARCHAR) AS session
         FROM orders WHERE o_orderkey % 17 = 0 AND o_custkey % 5 <> 0),
flags AS (SELECT old_id, session, bool_or(rest = 'DICOMDIR') AS has_dicomdir,
                 bool_or(starts_with(rest, 'DICOM/')) AS has_dicom
          FROM tree GROUP BY old_id, session),
sess AS (SELECT f.*, i.new_id FROM flags f JOIN ids i ON f.old_id = i.old_id),
ex AS (SELECT * FROM sess s WHERE EXISTS (SELECT 1 FROM done d WHERE d.new_id = s.new_id AND d.session = s.session)),
todo AS (SELECT * FROM sess s WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.new_id = s.new_id AND d.session = s.session)),
named AS (SELECT *, regexp_extract(name, '^.+(\.[^.]+)$', 1) AS sfx FROM tree),
stems AS (SELECT *, substr(name, 1, length(name) - length(sfx)) AS stm FROM named)
""") + r"""
SELECT old_id, new_id, CAST(NULL AS VARCHAR) AS session, CAST(NULL AS VARCHAR) AS source,
       CAST(NULL AS VARCHAR) AS target, 'skip_no_subject' AS action
FROM ids WHERE NOT EXISTS (SELECT 1 FROM tree t WHERE t.old_id = ids.old_id)
UNION ALL
SELECT old_id, CAST(NULL AS VARCHAR), session, 'input/' || old_id || '/' || session, NULL, 'not_mapped'
FROM flags f WHERE NOT EXISTS (SELECT 1 FROM ids i WHERE i.old_id = f.old_id)
UNION ALL
SELECT old_id, new_id, session, 'input/' || old_id || '/' || session, 'output/' || new_id || '/' || session,
       'skip_exists' FROM ex
UNION ALL
SELECT old_id, new_id, session, 'input/' || old_id || '/' || session, NULL, 'warn_no_dicomdir'
FROM todo WHERE NOT has_dicomdir
UNION ALL
SELECT old_id, new_id, session, 'input/' || old_id || '/' || session, NULL, 'warn_no_dicom'
FROM todo WHERE NOT has_dicom
UNION ALL
SELECT s.old_id, t.new_id, s.session, s.path, 'output/' || t.new_id || '/' || s.session || '/' || s.rest,
       CASE WHEN s.rest = 'DICOMDIR' THEN 'anonymize'
            WHEN lower(s.sfx) = '.dcm' OR (length(s.stm) = 7 AND regexp_matches(s.stm, '^[A-Za-z]{2}_[0-9]{4}$'))
              THEN 'anonymize'
            ELSE 'copy' END
FROM stems s JOIN todo t ON s.old_id = t.old_id AND s.session = t.session
"""

ORACLE["peak_stream"] = r"""
SELECT CAST(user_id AS VARCHAR) AS dir, max(value) AS peak_bytes,
       first(value ORDER BY ts DESC, event_id DESC) AS current_bytes, count(*) AS n_samples
FROM events GROUP BY user_id
"""

ORACLE["subject_split_capped"] = _with(*_COHORT_CTES, _assign(
    "SELECT DISTINCT ptid FROM cohort WHERE ptid IS NOT NULL"), r"""
routed AS (SELECT c.*, a.split FROM cohort c JOIN asg a ON c.ptid = a.ptid)
""") + r"""
SELECT * EXCLUDE (r) FROM (
  SELECT *, row_number() OVER (PARTITION BY ptid ORDER BY session, path, filename) AS r FROM routed) t
WHERE (split = 'train' AND r <= 3) OR (split <> 'train' AND r = 1)
"""

ORACLE["deid_elements_deep"] = _with(ELEMENTS, IDS) + r"""
SELECT e.file_path, e.subject, e.sort_key, e.depth, e.tag, e.vr, e.keyword,
       CASE WHEN e.keyword = 'PatientName' THEN i.new_id
            WHEN e.keyword = 'PatientBirthDate' AND length(e.value) > 0 THEN substr(e.value, 1, 4) || '0101'
            ELSE e.value END AS value,
       i.new_id
FROM elements e JOIN ids i ON e.subject = i.old_id
WHERE e.keyword NOT IN ('PatientID', 'FileSetID')
"""

ORACLE["dicom_headers"] = _with(ELEMENTS) + r"""
SELECT subject, sort_key, depth, tag, vr, keyword, value FROM elements
"""

ORACLE["tree_walk"] = r"""
WITH given AS (
  SELECT o_orderkey AS k, 'part' || CAST(o_custkey % 40 AS VARCHAR) AS top, CAST(o_custkey AS VARCHAR) AS cust FROM orders),
file AS (
  SELECT top || '/' || cust || CASE WHEN k % 4 <> 0 THEN '/IM_' || k ELSE '/S' || k || '/DICOMDIR' END AS rel,
         k % 7 AS size, k % 4 <> 0 AS image
  FROM given WHERE k % 8 <> 0),
dir AS (
  SELECT DISTINCT top AS rel FROM given
  UNION SELECT top || '/' || cust FROM given
  UNION SELECT top || '/' || cust || '/S' || k FROM given WHERE k % 4 = 0)
SELECT rel, 'file' AS kind, size, image AS is_dicom, true AS readable FROM file
UNION ALL
SELECT rel, 'dir', NULL, false, false FROM dir
"""

# the tree walked from its roots: each node's lines, then those below it
_RECORD_TREE = r"""
WITH RECURSIVE line AS (
  SELECT o_custkey AS cust, o_orderkey AS k, l_linenumber AS n,
         row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber) AS pos
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
node AS (
  SELECT o_custkey AS cust, 'p' AS id, NULL AS up, 1 AS pos, 'PATIENT' AS kind FROM orders GROUP BY o_custkey
  UNION ALL
  SELECT o_custkey, 's' || o_orderkey, 'p', row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey), 'STUDY' FROM orders
  UNION ALL
  SELECT cust, 'i' || k || '/' || n, 's' || k, pos, CASE WHEN n = 2 THEN 'PRESENTATION' ELSE 'IMAGE' END FROM line),
counted AS (
  SELECT *, CASE WHEN kind = 'IMAGE' THEN sum(CASE WHEN kind = 'IMAGE' THEN 1 ELSE 0 END) OVER (
              PARTITION BY cust, up ORDER BY pos) END AS nth
  FROM node),
walked AS (
  SELECT cust, id, 0 AS level, lpad(CAST(pos AS VARCHAR), 6, '0') AS sort_key, kind, nth FROM counted WHERE up IS NULL
  UNION ALL
  SELECT c.cust, c.id, w.level + 1, w.sort_key || '.' || lpad(CAST(c.pos AS VARCHAR), 6, '0'), c.kind, c.nth
  FROM walked w JOIN counted c ON c.cust = w.cust AND c.up = w.id WHERE w.kind <> 'IMAGE')
SELECT 'index/' || CAST(cust AS VARCHAR) AS dicomdir_path, level, sort_key, 0 AS line,
       repeat('  ', level) || CASE WHEN nth = 5 THEN '|-(...)' ELSE '|-' || kind END AS text
FROM walked WHERE nth IS NULL OR nth <= 5
UNION ALL
SELECT 'index/' || CAST(cust AS VARCHAR), level, sort_key, 1, repeat('  ', level) || 'Ignoring the remaining images...'
FROM walked WHERE nth = 5
"""

ORACLE["record_tree_nested"] = _RECORD_TREE
ORACLE["record_tree_offsets"] = _RECORD_TREE

ORACLE["tensor_chunk_files"] = r"""
SELECT pos // 128 AS chunk, pos % 128 AS row, CAST(label AS VARCHAR) AS dx,
       CAST(CAST(embedding[1] AS DOUBLE) / 255.0 AS FLOAT) AS first, CAST(len(embedding) AS BIGINT) AS n
FROM (SELECT *, row_number() OVER (ORDER BY vec_id) - 1 AS pos FROM embeddings) t
"""

_STRATIFIED = r"""
WITH subj AS (
  SELECT CAST(c_custkey AS VARCHAR) AS ptid, c_mktsegment AS segment, CAST(floor(c_acctbal / 2500) AS BIGINT) AS band
  FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)),
t AS (
  SELECT count(*) AS n, CAST(round_even(count(*) * CAST(0.8 AS DOUBLE), 0) AS BIGINT) AS n_train,
         CAST(round_even(count(*) * CAST(0.1 AS DOUBLE), 0) AS BIGINT) AS n_val FROM subj),
goal AS (SELECT n, n_val, n - n_train - n_val AS n_test FROM t),
cell AS (SELECT segment, band, count(*) AS m FROM subj GROUP BY segment, band),
v1 AS (
  SELECT cell.*, goal.*, m * n_val // n AS v, m * n_val % n AS rv, m * n_test // n AS u, m * n_test % n AS ru FROM cell, goal),
v2 AS (
  SELECT *, v + CASE WHEN row_number() OVER (ORDER BY CASE WHEN m < v + 1 THEN 1 ELSE 0 END, rv DESC, segment NULLS FIRST, band NULLS FIRST)
                          <= n_val - sum(v) OVER () THEN 1 ELSE 0 END AS val FROM v1),
v3 AS (
  SELECT *, u + CASE WHEN row_number() OVER (ORDER BY CASE WHEN m - val < u + 1 THEN 1 ELSE 0 END, rv + ru - (val - v) * n DESC,
                                             segment NULLS FIRST, band NULLS FIRST)
                          <= n_test - sum(u) OVER () THEN 1 ELSE 0 END AS test FROM v2),
assigned AS (
  SELECT ptid, segment, band,
         CASE WHEN place < m - val - test THEN 'train' WHEN place < m - test THEN 'val' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY segment, band ORDER BY md5(ptid || ':22'), ptid) - 1 AS place FROM subj) r
  JOIN v3 USING (segment, band))
"""

ORACLE["split_stratified"] = _STRATIFIED + "SELECT * FROM assigned"

ORACLE["split_stratified_gaps"] = _STRATIFIED + r"""
SELECT c.segment, c.band, s.split, count(a.ptid) AS n,
       round(count(a.ptid) - CAST(c.m AS DOUBLE) * s.k / (SELECT count(*) FROM assigned), 6) AS gap
FROM cell c CROSS JOIN (SELECT split, count(*) AS k FROM assigned GROUP BY split) s
LEFT JOIN assigned a ON a.segment = c.segment AND a.band = c.band AND a.split = s.split
GROUP BY c.segment, c.band, c.m, s.split, s.k
"""

ORACLE["first_files_waves"] = r"""
SELECT dir, name, CASE WHEN ok THEN 'ok' ELSE 'error' END AS status, CASE WHEN ok THEN CAST(n_chars AS VARCHAR) END AS value
FROM (SELECT *, coalesce(sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (
                  PARTITION BY dir ORDER BY name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ok_before
      FROM (SELECT source AS dir, CAST(doc_id AS VARCHAR) AS name, doc_id % 7 <> 0 AS ok, n_chars FROM documents) f) t
WHERE ok_before < 5
"""

ORACLE["bids_tree_get"] = _with(VISITS) + r"""
SELECT subject || '_' || session || CASE WHEN pet THEN '_trc-' || tracer || '_pet' ELSE '_T1w' END || '.nii.gz' AS filename,
       subject, session, CASE WHEN pet THEN 'pet' ELSE 'anat' END AS datatype, CASE WHEN pet THEN 'pet' ELSE 'T1w' END AS suffix,
       CASE WHEN pet THEN tracer END AS tracer, size
FROM (SELECT 'sub-ADNI' || A || 'S' || B AS subject,
             'ses-M' || CASE WHEN mo >= 1000 THEN CAST(mo AS VARCHAR) ELSE lpad(CAST(mo AS VARCHAR), 3, '0') END AS session,
             o_orderkey % 3 = 0 AS pet, CASE WHEN o_orderkey % 2 = 0 THEN '18FFDG' ELSE '18FAV45' END AS tracer,
             o_orderkey % 5 AS size, visit
      FROM vv) t
WHERE visit < 3
"""

_DEEP = r"""
WITH p AS (SELECT k, 'v' || (k // 8192) || '/d' || (k // 64) AS dir, 'v' || (k // 8192) AS top FROM (
             SELECT l_orderkey AS k FROM lineitem UNION SELECT o_orderkey FROM orders)),
d AS (SELECT DISTINCT l_orderkey AS k FROM lineitem),
m AS (SELECT k FROM d WHERE k % 1009 <> 0 UNION SELECT o_orderkey FROM orders WHERE o_orderkey % 2003 = 0),
status AS (
  SELECT dir || '/IM_' || p.k AS path, dir, top,
         CASE WHEN d.k IS NOT NULL AND m.k IS NOT NULL THEN 'common' WHEN d.k IS NOT NULL THEN 'only_on_disk' ELSE 'only_in_manifest' END AS status
  FROM p LEFT JOIN d ON d.k = p.k LEFT JOIN m ON m.k = p.k WHERE d.k IS NOT NULL OR m.k IS NOT NULL)
"""

ORACLE["manifest_digest_status"] = _DEEP + "SELECT path, dir, status FROM status"

ORACLE["manifest_digest_summary"] = _DEEP + r"""
SELECT dir, count(*) FILTER (WHERE status = 'only_on_disk') AS n_only_on_disk,
       count(*) FILTER (WHERE status = 'only_in_manifest') AS n_only_in_manifest,
       count(*) FILTER (WHERE status = 'common') AS n_common,
       CASE WHEN count(*) FILTER (WHERE status <> 'common') = 0 THEN 'up_to_date' ELSE 'out_of_date' END AS state
FROM status GROUP BY dir
"""

ORACLE["manifest_digest_trees"] = _DEEP + r"""
SELECT f AS dir, count(*) FILTER (WHERE status <> 'only_in_manifest') AS n_on_disk,
       count(*) FILTER (WHERE status <> 'only_on_disk') AS n_in_manifest, count(*) FILTER (WHERE status <> 'common') = 0 AS same
FROM (SELECT *, unnest(['', top, dir]) AS f FROM status) t GROUP BY f
"""

ORACLE["identifiers_in_text"] = _with(ELEMENTS, r"""
texts AS (
  SELECT file_path, sort_key, keyword, value FROM elements WHERE depth > 0 OR keyword NOT IN ('PatientName', 'PatientID')
  UNION ALL
  SELECT 'files/' || c_custkey || '.dcm', '000009', 'ImageComments',
         CASE c_custkey % 3 WHEN 0 THEN 'Seen: ' || upper(c_name) || ', again' WHEN 1 THEN 'see ' || regexp_replace(c_name, '[0-9]', '7', 'g')
              ELSE 'nothing of note' END FROM customer
  UNION ALL
  SELECT 'files/' || c_custkey || '.dcm', '000004.000000.000007', NULL,
         CASE WHEN c_custkey % 5 = 0 THEN 'ref(' || c_name || ')' ELSE 'x' || c_name || '9' END FROM customer),
wanted AS (
  SELECT 'files/' || c_custkey || '.dcm' AS owner, 'PatientName' AS found_keyword, lower(c_name) AS found FROM customer
  UNION SELECT 'files/' || c_custkey || '.dcm', 'PatientID', CAST(c_custkey AS VARCHAR) FROM customer WHERE length(CAST(c_custkey AS VARCHAR)) >= 4),
hit AS (
  SELECT t.*, w.*, strpos(lower(value), found) AS p FROM texts t JOIN wanted w ON contains(lower(value), found))
""") + r"""
SELECT DISTINCT file_path, sort_key, keyword, value, found, found_keyword, owner FROM hit
WHERE NOT regexp_matches(substr(lower(value), p - 1, CASE WHEN p > 1 THEN 1 ELSE 0 END), '[a-z0-9]')
  AND NOT regexp_matches(substr(lower(value), p + length(found), 1), '[a-z0-9]')
"""

ORACLE["anonymize_job"] = r"""
WITH todo AS (
  SELECT *, 'ANON' || CAST(c_custkey * 7919 AS VARCHAR) AS new_id FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey % 17 <> 0)
SELECT new_id || '/S' || c_nationkey || '/DICOMDIR' AS target, '(0010,0010)' AS tag, 'PatientName' AS keyword, new_id AS value, new_id
FROM todo WHERE c_custkey % 4 <> 0
UNION ALL
SELECT new_id || '/S' || c_nationkey || '/DICOM/IM_0001', e.tag, e.keyword,
       CASE e.keyword WHEN 'PatientName' THEN new_id WHEN 'PatientBirthDate' THEN CAST(1920 + c_custkey % 80 AS VARCHAR) || '0101'
            ELSE CAST(c_custkey % 512 AS VARCHAR) END, new_id
FROM todo, (VALUES ('(0010,0010)', 'PatientName'), ('(0010,0030)', 'PatientBirthDate'), ('(0028,0010)', 'Rows')) e(tag, keyword)
WHERE c_custkey % 9 <> 0
"""

ORACLE["check_manifest_job"] = r"""
SELECT 'part' || (o_custkey % 40) || '/' || o_custkey || '/IM_' || o_orderkey AS rel,
       CASE WHEN o_orderkey % 4 = 0 THEN 'only_in_manifest' WHEN o_orderkey % 11 = 0 THEN 'only_on_disk' ELSE 'common' END AS status
FROM orders WHERE o_orderkey % 4 <> 0 OR o_orderkey % 13 = 0
"""

ORACLE["training_set_job"] = _with(r"""
visit AS (
  SELECT *, lpad(CAST(vec_id // 3 // 10000 AS VARCHAR), 3, '0') || '_S_' || lpad(CAST(vec_id // 3 % 10000 AS VARCHAR), 4, '0') AS ptid,
         CASE label % 3 WHEN 0 THEN 'cn' WHEN 1 THEN 'mci' ELSE 'dementia' END AS dx
  FROM embeddings)
""", _assign("SELECT DISTINCT ptid FROM visit"), r"""
kept AS (
  SELECT * FROM (SELECT v.*, a.split, row_number() OVER (PARTITION BY v.ptid ORDER BY vec_id % 3) AS nth FROM visit v JOIN asg a ON v.ptid = a.ptid) t
  WHERE split = 'train' OR nth = 1)
""") + r"""
SELECT split, pos // 128 AS chunk, pos % 128 AS row, dx, CAST(CAST(embedding[1] AS DOUBLE) / 255.0 AS FLOAT) AS first
FROM (SELECT *, row_number() OVER (PARTITION BY split ORDER BY ptid, vec_id % 3) - 1 AS pos FROM kept) t
"""

ORACLE["volume_slab_tensors"] = ORACLE["tensor_scale"]
