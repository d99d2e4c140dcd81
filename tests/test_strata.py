"""Stratified splits: exact sizes, shares per stratum, hot and tiny strata."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortlake.operators import split, strata


def subjects(n, kinds, seed):
    r = random.Random(seed)
    pool = [None] + [f"k{i}" for i in range(kinds)]
    return [(f"s{i}", "hot" if i % 3 == 0 else r.choice(pool), r.randrange(3)) for i in range(n)]


@pytest.mark.parametrize("n,kinds,train,val,seed", [(500, 5, 0.8, 0.1, 1), (97, 40, 0.7, 0.15, 2), (301, 200, 0.6, 0.2, 3), (7, 5, 0.5, 0.25, 4)])
def test_sizes_and_shares(spark, n, kinds, train, val, seed):
    rows = subjects(n, kinds, seed)
    df = spark.createDataFrame(rows + rows[:20] + [(None, "hot", 1)], "ptid string, kind string, age int")
    got = strata.assign_stratified(df, ["kind", "age"], train, val).collect()
    assert sorted(r["ptid"] for r in got) == sorted(r[0] for r in rows)
    sizes = Counter(r["split"] for r in got)
    exact = Counter(r["split"] for r in split.assign_splits(df, train, val).collect())
    assert sizes == exact
    of = Counter((r["kind"], r["age"]) for r in got)
    each = Counter((r["kind"], r["age"], r["split"]) for r in got)
    for (kind, age), m in of.items():
        for s, most in (("val", 1), ("test", 1), ("train", 2)):
            assert abs(each[kind, age, s] - m * exact[s] / n) < most
    again = strata.assign_stratified(df.repartition(3), ["kind", "age"], train, val).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, got), key=str)


def test_gaps_say_what_plain_splits_miss(spark):
    rows = subjects(400, 6, 7)
    df = spark.createDataFrame(rows, "ptid string, kind string, age int")
    worst = lambda d: strata.stratum_gaps(d, ["kind"]).agg(F.max(F.abs("gap"))).first()[0]
    plain = split.assign_splits(df, 0.8, 0.1).join(df, "ptid")
    assert worst(strata.assign_stratified(df, ["kind"], 0.8, 0.1)) <= 1 < worst(plain)


def test_quantile_bins(spark):
    df = spark.range(1000).selectExpr("id", "cast(id * id as double) as x", "case when id % 10 = 0 then null else id end as y")
    df = df.withColumn("x", F.when(F.col("id") == 3, F.lit(float("nan"))).otherwise(F.col("x")))
    got = Counter(r[0] for r in strata.with_quantile_bin(df, "x", 4, "b").select("b").collect())
    assert got.pop(None) == 1 and set(got) == {0, 1, 2, 3} and max(got.values()) - min(got.values()) < 10
    assert Counter(r[0] for r in strata.with_quantile_bin(df, "y", 2, "b").select("b").collect())[None] == 100


def test_no_subjects(spark):
    df = spark.createDataFrame([], "ptid string, kind string")
    assert strata.assign_stratified(df, ["kind"], 0.8, 0.1).count() == 0
