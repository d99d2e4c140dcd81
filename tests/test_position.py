"""Position and running aggregates against single-task windows, with a hot key."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortlake.operators.position import (assert_unique, duplicate_keys, first_k_per_group,
                                           running_max, with_hash_position, with_position)


def skewed(spark, n=3000, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        g = "hot" if i % 3 == 0 else (None if i % 97 == 0 else f"g{rnd.randint(0, 40)}")
        rows.append((i, g, rnd.randint(0, 500), float(rnd.random())))
    return spark.createDataFrame(rows, "id long, g string, t int, v double")


def test_global_position_matches_row_number(spark):
    df = skewed(spark)
    got = with_position(df, ["t", "id"], pos_col="pos", total_col="n", num_partitions=7)
    exp = df.withColumn("pos", F.row_number().over(Window.orderBy("t", "id")) - 1)
    a = {r["id"]: (r["pos"], r["n"]) for r in got.collect()}
    b = {r["id"]: r["pos"] for r in exp.collect()}
    assert {k: v[0] for k, v in a.items()} == b
    assert {v[1] for v in a.values()} == {3000}


def test_grouped_position_matches_row_number_with_hot_group(spark):
    df = skewed(spark)
    for parts in (1, 5, 16):
        got = with_position(df, ["t", "id"], ["g"], pos_col="pos", num_partitions=parts)
        exp = df.withColumn("pos", F.row_number().over(
            Window.partitionBy("g").orderBy("t", "id")) - 1)
        assert sorted((r["id"], r["pos"]) for r in got.collect()) == \
            sorted((r["id"], r["pos"]) for r in exp.collect())


def test_running_max_matches_window(spark):
    df = skewed(spark)
    got = running_max(df, "v", ["t", "id"], ["g"], num_partitions=9)
    w = Window.partitionBy("g").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.withColumn("running_max", F.max("v").over(w))
    assert sorted((r["id"], r["running_max"]) for r in got.collect()) == \
        sorted((r["id"], r["running_max"]) for r in exp.collect())


def test_empty_input(spark):
    df = spark.createDataFrame([], "id long, g string")
    assert with_position(df, ["id"]).count() == 0
    assert with_position(df, ["id"], ["g"]).count() == 0


def test_first_k_plans_partial_limit(spark):
    df = skewed(spark)
    out = first_k_per_group(df, ["g"], ["t", "id"], 3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    counts = {r["g"]: r["count"] for r in out.groupBy("g").count().collect()}
    assert max(counts.values()) == 3


def test_assert_unique(spark):
    df = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    assert duplicate_keys(df, ["k"]).collect()[0]["n"] == 2
    import pytest
    with pytest.raises(ValueError):
        assert_unique(df, ["k"])
    assert_unique(df.distinct(), ["k"])


def test_grouped_position_is_bigint(spark):
    df = skewed(spark)
    got = with_position(df, ["t", "id"], ["g"], pos_col="pos")
    exp = df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy("t", "id")) - 1)
    assert sorted((r["id"], r["pos"]) for r in got.collect()) == \
        sorted((r["id"], r["pos"]) for r in exp.collect())
    assert dict(got.dtypes)["pos"] == "bigint"


def test_null_group_can_be_hot(spark):
    rows = [(i, None if i < 50 else "a", i % 7) for i in range(80)]
    df = spark.createDataFrame(rows, "id long, g string, t int")
    got = with_position(df, ["t", "id"], ["g"])
    exp = df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy("t", "id")) - 1)
    assert sorted((r["id"], r["pos"]) for r in got.collect()) == \
        sorted((r["id"], r["pos"]) for r in exp.collect())


def test_hash_position_matches_row_number(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("k")) \
        .withColumn("h", F.md5(F.concat("k", F.lit(":22"))))
    got = with_hash_position(df, "h", ["k"], pos_col="pos", total_col="n", prefix_len=2)
    exp = df.withColumn("pos", F.row_number().over(Window.orderBy("h", "k")) - 1)
    assert sorted((r["k"], r["pos"], r["n"]) for r in got.collect()) == \
        sorted((r["k"], r["pos"], 5000) for r in exp.collect())


def test_positions_over_every_kind_of_first_column(spark):
    """Texts with a common start, dates, timestamps, decimals, NULL, NaN and
    infinities sort into bins as Spark sorts them."""
    nums = [0.0, -1.5, float("nan"), float("inf"), float("-inf"), None, 1e308, -1e308, 3.25, float("nan")]
    rows = [(i, nums[i % 10], None if i % 41 == 0 else f"sub-ADNI{(i * 7919) % 400:03d}" + "\u00e9" * (i % 3))
            for i in range(400)]
    df = spark.createDataFrame(rows, "id long, x double, s string").selectExpr(
        "*", "date_add(date'2001-01-01', cast(id * 37 % 900 as int)) d",
        "timestamp_seconds(id * 7717 % 100000) ts", "cast(timestamp_seconds(id * 31 % 977) as timestamp_ntz) tz",
        "cast(id * 13 % 101 as decimal(20, 3)) m", "id % 2 = 0 b", "cast(s as binary) y")
    for c in ("x", "s", "d", "ts", "tz", "m", "b", "y"):
        got = with_position(df, [c, "id"], pos_col="pos", num_partitions=11)
        exp = df.withColumn("pos", F.row_number().over(Window.orderBy(c, "id")) - 1)
        assert {r["id"]: r["pos"] for r in got.collect()} == {r["id"]: r["pos"] for r in exp.collect()}, c


def test_equal_or_missing_first_values(spark):
    df = spark.range(30).selectExpr("id", "cast(null as int) t", "5 five")
    for c in ("t", "five"):
        got = with_position(df, [c, "id"], pos_col="pos")
        assert all(r["pos"] == r["id"] for r in got.collect())


def test_building_a_position_starts_no_job(spark):
    sc = spark.sparkContext
    df = skewed(spark)
    sc.setJobGroup("build", "build only")
    try:
        with_position(df, ["t", "id"], ["g"])
        with_position(df, ["t", "id"])
        running_max(df, "v", ["t", "id"], ["g"])
        assert list(sc.statusTracker().getJobIdsForGroup("build")) == []
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_hot_group_is_spread_over_bins(spark):
    from cohortlake.operators.position import _with_bin
    df = skewed(spark, n=6000)                      # "hot" holds a third of the rows
    per_bin = _with_bin(df, ["t", "id"], 24, ["g"]).filter(F.col("g") == "hot").groupBy("_bin").count().collect()
    assert len(per_bin) >= 8
    assert max(r["count"] for r in per_bin) < 600


def outlying(spark, n=30000):
    """One far outlier, and a value that a third of the rows share."""
    return spark.range(n).selectExpr("id", "case when id = 0 then 1e15 when id % 3 = 0 then 7 else id * 37 % 1000 end as t",
                                     "id % 500 as g", "double(id * 7919 % 104729) as v")


def test_bins_are_even_whatever_the_values(spark):
    """Rows per task of the final window, for outliers and ties."""
    df = outlying(spark)
    for out in (with_position(df, ["t", "id"], pos_col="pos"), with_position(df, ["t", "id"], ["g"], pos_col="pos"),
                running_max(df.withColumn("one", F.lit(1)), "v", ["t", "id"], ["one"])):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            per_task = sorted(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        assert sum(per_task) == 30000 and per_task[-1] < 3 * per_task[len(per_task) // 2]


def test_outliers_and_ties_change_no_result(spark):
    df = outlying(spark, 3000)
    got = with_position(df, ["t", "id"], pos_col="pos")
    exp = df.withColumn("pos", F.row_number().over(Window.orderBy("t", "id")) - 1)
    assert sorted(map(tuple, got.select("id", "pos").collect())) == sorted(map(tuple, exp.select("id", "pos").collect()))


def test_few_markers(spark):
    """Small groups lie in one bin, so they cost no marker row."""
    from cohortlake.operators.position import _with_bin
    df = outlying(spark, 20000)
    per_group = _with_bin(df, ["t", "id"], 32, ["g"]).groupBy("g").agg(F.count_distinct("_bin").alias("n"))
    assert per_group.agg(F.sum(F.col("n") - 1)).first()[0] <= 31


def test_order_by_expressions_after_a_name(spark):
    df = skewed(spark).withColumn("extra", F.create_map(F.lit(1), F.col("id")))
    got = with_position(df, ["t", F.desc("id")], ["g"], pos_col="pos", num_partitions=7)
    exp = df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy("t", F.desc("id"))) - 1)
    assert sorted((r["id"], r["pos"]) for r in got.collect()) == sorted((r["id"], r["pos"]) for r in exp.collect())


def test_partial_limit_kept_for_large_k(spark):
    df = skewed(spark)
    key = "spark.sql.optimizer.windowGroupLimitThreshold"       # as get_spark sets it
    spark.conf.set(key, "100000")
    try:
        out = first_k_per_group(df, ["g"], ["t", "id"], 1500)
        assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == df.count()      # every group is smaller than k here
    finally:
        spark.conf.unset(key)


def test_written_tables_go_to_the_configured_shared_folder(spark):
    from cohortlake.session import checkpoint_base, shared_dir
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert checkpoint_base(spark) == base
    assert shared_dir(spark, "x").startswith(base.rstrip("/") + "/tables/")
