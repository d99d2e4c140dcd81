"""Subject split: the source tool's size test plus exact sizes and routing."""

import pytest
from pyspark.sql import functions as F

from cohortlake.operators import split


def subjects(spark, n, rows_per=1):
    data = [(f"sub-ADNI{i:03d}", f"ses-M{j:03d}", i * 10 + j) for i in range(n) for j in range(rows_per)]
    return spark.createDataFrame(data, "ptid string, session string, value long")


def test_reference_sizes(spark):
    rows = split.split_train_val_test(subjects(spark, 100), 0.7, 0.15)
    sizes = {r["split"]: r["count"] for r in rows.groupBy("split").count().collect()}
    assert sum(sizes.values()) == 100
    assert 65 < sizes["train"] < 75 and 10 < sizes["val"] < 20 and 10 < sizes["test"] < 20


@pytest.mark.parametrize("n", [0, 1, 2, 10])
def test_exact_sizes(spark, n):
    a = split.assign_splits(subjects(spark, n), 0.8, 0.1)
    sizes = {r["split"]: r["count"] for r in a.groupBy("split").count().collect()}
    n_train, n_val = round(n * 0.8), round(n * 0.1)
    assert sizes.get("train", 0) == n_train
    assert sizes.get("val", 0) == min(n_val, n - n_train)
    assert sum(sizes.values()) == n


def test_train_keeps_all_rows_val_test_one(spark):
    df = subjects(spark, 50, rows_per=3)
    rows = split.split_train_val_test(df, 0.6, 0.2, order_cols=["session"], validate=True)
    per = rows.groupBy("split", "ptid").count()
    for r in per.collect():
        assert r["count"] == (3 if r["split"] == "train" else 1)
    # val/test keep the first session
    assert rows.filter("split <> 'train'").filter(F.col("session") != "ses-M000").count() == 0
    # disjoint subjects
    assert rows.select("ptid").distinct().count() == 50
    assert rows.groupBy("ptid").agg(F.countDistinct("split").alias("k")).filter("k > 1").count() == 0


def test_repeatable_across_partitioning(spark):
    df = subjects(spark, 200)
    a = {r["ptid"]: r["split"] for r in split.assign_splits(df, 0.8, 0.1).collect()}
    b = {r["ptid"]: r["split"] for r in split.assign_splits(df.repartition(13), 0.8, 0.1).collect()}
    assert a == b


def test_null_subject_takes_no_slot(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "ptid string")
    a = split.assign_splits(df, 0.5, 0.25)
    assert a.count() == 2


@pytest.mark.parametrize("train,val", [(0.3, 0.1), (0.8, 0.2), (0.9, 0.3)])
def test_bad_fractions(spark, train, val):
    with pytest.raises(ValueError):
        split.check_fractions(train, val)


def test_hash_split_is_stable_when_subjects_are_added(spark):
    small = split.hash_split(subjects(spark, 100), 0.8, 0.1)
    big = split.hash_split(subjects(spark, 300), 0.8, 0.1)
    a = {r["ptid"]: r["split"] for r in small.collect()}
    b = {r["ptid"]: r["split"] for r in big.collect()}
    assert all(b[k] == v for k, v in a.items())


def test_caps_and_balance(spark):
    df = subjects(spark, 30, rows_per=5).withColumn("sex", F.when(F.col("value") % 2 == 0, "F").otherwise("M"))
    rows = split.split_train_val_test(df, 0.6, 0.2, order_cols=["session"], caps={"train": 3})
    assert rows.filter("split = 'train'").groupBy("ptid").count().agg(F.max("count")).first()[0] == 3
    rep = split.balance_report(rows, ["value"], ["sex"])
    metrics = {(r["split"], r["metric"]) for r in rep.collect()}
    assert ("max_gap", "mean:value") in metrics and ("train", "share:sex=F") in metrics


def test_gap_counts_a_category_that_a_split_lacks(spark):
    rows = [("train", "F")] * 3 + [("train", "M")] * 7 + [("val", "M")] * 2 + [("test", "M")]
    rep = split.balance_report(spark.createDataFrame(rows, "split string, sex string"), [], ["sex"])
    gap = {r["metric"]: r["value"] for r in rep.filter("split = 'max_gap'").collect()}
    assert gap["share:sex=F"] == 0.3 and gap["share:sex=M"] == 0.3
