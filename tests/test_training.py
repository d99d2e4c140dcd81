"""C2 end to end: index + visits + NIfTI files -> TSVs and tensor parquet."""

import glob
import os

import numpy as np
import pyarrow.parquet as pq

from cohortlake.plans.training import build_training_set
from cohortlake.sources import nifti

LAYOUT = "filename string, path string, suffix string, extension string, desc string, res string, " \
         "tracer string, reconstruction string"


def test_build_training_set(spark, tmp_dir):
    vol_dir = os.path.join(tmp_dir, "derivatives")
    os.makedirs(vol_dir)
    rows, clin, vols = [], [], {}
    rng = np.random.default_rng(7)
    for s in range(20):
        for v, code in enumerate(["bl", "m06", "m12"]):
            ses = "ses-M000" if code == "bl" else f"ses-M{code[1:].rjust(3, '0')}"
            name = f"sub-ADNI{s:03d}S{1000 + s:04d}_{ses}_T1w.nii.gz"
            path = os.path.join(vol_dir, name)
            vol = (rng.random((3, 4, 5)) * 300).astype(np.float32)
            with open(path, "wb") as f:
                f.write(nifti.encode(vol))
            vols[path] = vol
            rows.append((name, path, "T1w", "nii.gz", "Crop", "1x1x1", None, None))
            clin.append(("ADNI3", f"{s:03d}_S_{1000 + s:04d}", code, ["CN", "MCI", "Dementia"][s % 3]))
    lay = spark.createDataFrame(rows, LAYOUT)
    cl = spark.createDataFrame(clin, "COLPROT string, PTID string, VISCODE string, DX string")
    out = os.path.join(tmp_dir, "out")
    paths = build_training_set(lay, cl, out, phases=["ADNI3"], train=0.8, val=0.1, n_proc=3,
                               keep_identity=True)
    ds = spark.read.option("sep", "\t").option("header", True).csv(paths["dataset"])
    assert ds.count() == 60
    splits = spark.read.option("sep", "\t").option("header", True).csv(paths["splits"])
    sizes = {r["split"]: r["count"] for r in splits.groupBy("split").count().collect()}
    assert sizes == {"train": 48, "val": 2, "test": 2}     # 16 subjects x 3, then 2 x 1 each
    t = spark.read.parquet(paths["tensors"])
    assert t.count() == 52
    for r in t.collect():
        np.testing.assert_array_equal(np.array(r["raw"], dtype=np.float32), nifti.to_tensor(vols[r["path"]]))
        assert r["shape"] == [3, 4, 5, 1]
    for f in glob.glob(os.path.join(paths["tensors"], "split=*", "*.parquet")):
        assert pq.read_metadata(f).num_rows <= 128


def test_entry_points_from_files(spark, tmp_dir):
    from cohortlake.plans.cohort import included_subjects_tsv
    from cohortlake.plans.training import build_training_set_from_files
    bids = os.path.join(tmp_dir, "bids")
    rows = []
    for s in range(6):
        for code, ses in (("bl", "ses-M000"), ("m06", "ses-M006")):
            for name in (f"sub-ADNI{s:03d}S{s:04d}_{ses}_trc-18FFDG_rec-coregiso_pet.nii.gz",
                         f"sub-ADNI{s:03d}S{s:04d}_{ses}_trc-18FFDG_rec-coregiso_pet.json"):
                p = os.path.join(bids, f"sub-ADNI{s:03d}S{s:04d}", ses, "pet", name)
                os.makedirs(os.path.dirname(p), exist_ok=True)
                with open(p, "wb") as f:
                    f.write(b"{}")
            rows.append((f"{s:03d}_S_{s:04d}", code, "ADNI3" if s % 2 else "ADNI1", "CN"))
    csv = os.path.join(tmp_dir, "clinical.csv")
    with open(csv, "w") as f:
        f.write("PTID,VISCODE,COLPROT,DX,EXTRA\n")
        for r in rows:
            f.write(",".join(r) + ",x\n")
    out = included_subjects_tsv(spark, bids, csv, os.path.join(tmp_dir, "inc"), ["ADNI3"])
    got = spark.read.option("sep", "\t").option("header", True).csv(os.path.join(tmp_dir, "inc"))
    assert got.count() == out.count() == 3 * 2 * 2          # 3 subjects x 2 sessions x 2 files
    assert set(got.columns) == {"participant_id", "session_id"}

    vol_dir = os.path.join(tmp_dir, "derivatives")
    os.makedirs(vol_dir)
    idx = []
    for s in range(10):
        name = f"sub-ADNI{s:03d}S{s:04d}_ses-M000_T1w.nii.gz"
        path = os.path.join(vol_dir, name)
        with open(path, "wb") as f:
            f.write(nifti.encode(np.full((2, 2, 2), float(s), dtype=np.float32)))
        idx.append((name, path, "T1w", ".nii.gz", "Crop", "1x1x1", None, None))
    ip = os.path.join(tmp_dir, "index.parquet")
    spark.createDataFrame(idx, LAYOUT).write.parquet(ip)
    csv2 = os.path.join(tmp_dir, "clinical2.csv")
    with open(csv2, "w") as f:
        f.write("COLPROT,PTID,VISCODE,DX\n")
        for s in range(10):
            f.write(f"ADNI3,{s:03d}_S_{s:04d},bl,MCI\n")
    paths = build_training_set_from_files(spark, ip, csv2, os.path.join(tmp_dir, "ts"))
    assert spark.read.parquet(paths["tensors"]).count() == 10     # one row per subject here
