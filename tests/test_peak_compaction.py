"""The peak stream's output: merged deltas, restarts, replays, broken merges."""

import os

import pytest

from cohortlake.streaming import peak

SCHEMA = "event_id long, dir string, bytes double, ts long"
ROWS = [(i, f"d{i % 5}", float((i * 53) % 17), i) for i in range(120)]


def files(spark, src, rows, n):
    for k in range(n):
        spark.createDataFrame(rows[k * len(rows) // n:(k + 1) * len(rows) // n], SCHEMA).coalesce(1).write.mode("append").parquet(src)


def run(spark, src, out, ck, every):
    s = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    return peak.run_until_caught_up(peak.peak_aggregate(s, order_cols=("ts",)), out, ck, compact_every=every)


def table(df):
    return sorted(map(tuple, df.collect()))


def expected(spark, rows):
    return table(peak.peak_aggregate(spark.createDataFrame(rows, SCHEMA), order_cols=("ts",)))


def folders(path):
    return sorted(d for d in os.listdir(path) if "=" in d) if os.path.isdir(path) else []


def test_deltas_are_merged_and_the_stream_resumes(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, n) for n in ("in", "out", "ck"))
    files(spark, src, ROWS[:60], 5)
    assert table(run(spark, src, out, ck, 2)) == expected(spark, ROWS[:60])
    assert folders(out) == ["_batch=4"] and folders(out + ".base") == ["upto=3"]
    files(spark, src, ROWS[60:], 3)
    assert table(run(spark, src, out, ck, 2)) == expected(spark, ROWS)
    assert len(folders(out)) <= 1 and len(folders(out + ".base")) == 1


def test_a_replayed_batch_changes_nothing(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, n) for n in ("in", "out", "ck"))
    files(spark, src, ROWS, 4)
    schema = run(spark, src, out, ck, 2).schema
    before = table(peak.current_table(spark, out, schema))
    assert folders(out + ".base") == ["upto=3"] and folders(out) == []
    # the last batch once more, after its merge: an older state, which the base outdates
    spark.createDataFrame([("d0", -1.0, -1.0, 1)], schema).write.parquet(f"{out}/_batch=3")
    assert table(peak.current_table(spark, out, schema)) == before
    peak.compact(spark, out, schema)
    assert folders(out) == [] and table(peak.current_table(spark, out, schema)) == before


@pytest.mark.parametrize("complete", [True, False])
def test_a_merge_broken_off(spark, tmp_dir, complete):
    out = os.path.join(tmp_dir, "out")
    schema = peak.peak_aggregate(spark.createDataFrame([], SCHEMA)).schema
    for k in range(3):
        spark.createDataFrame([("d", float(k), float(k), k)], schema).write.parquet(f"{out}/_batch={k}")
    peak.current_table(spark, out, schema).write.parquet(f"{out}.base/upto=2")       # and then it broke off
    if not complete:
        os.unlink(f"{out}.base/upto=2/_SUCCESS")
    assert table(peak.current_table(spark, out, schema)) == [("d", 2.0, 2.0, 2)]
    peak.compact(spark, out, schema)
    assert folders(out) == [] and folders(out + ".base") == ["upto=2"]
    assert table(peak.current_table(spark, out, schema)) == [("d", 2.0, 2.0, 2)]


def test_nothing_written_yet(spark, tmp_dir):
    schema = peak.peak_aggregate(spark.createDataFrame([], SCHEMA)).schema
    assert peak.current_table(spark, os.path.join(tmp_dir, "none"), schema).count() == 0
