"""Subject-level train/val/test splits."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.operators.position import assert_unique, first_k_per_group, with_hash_position
from cohortlake.session import materialize

SPLITS = ["train", "val", "test"]
# Fixed value: the seed of the subject shuffle.
DEFAULT_SEED = 22


def check_fractions(train: float, val: float) -> None:
    """``0.5 < train + val < 1`` (both strict)."""
    if not 0.5 < train + val < 1:
        raise ValueError(f"train + val is {train + val:g}; it has to lie between 0.5 and 1")


def subject_hash(key: str, seed: int = DEFAULT_SEED) -> Column:
    """Hex md5 of ``<subject>:<seed>``: the repeatable shuffle order."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))


def assign_splits(df: DataFrame, train: float, val: float, seed: int = DEFAULT_SEED,
                  key: str = "ptid", prefix_len: int = 3) -> DataFrame:
    """One row per subject with its split.  Subjects are ordered by
    (hash, id); the first ``rint(n*train)`` go to train, the next
    ``rint(n*val)`` to val, the rest to test (half-even rounding, as Python's
    ``round``).  NULL subjects take no slot.  Sizes are exact; positions come
    from hash-prefix buckets (``with_hash_position``), not a one-task window:
    16**``prefix_len`` of them, so raise it for billions of subjects."""
    check_fractions(train, val)
    subjects = (df.select(key).filter(F.col(key).isNotNull()).distinct()
                .withColumn("_h", subject_hash(key, seed)))
    ranked = with_hash_position(subjects, "_h", [key], pos_col="_pos", total_col="_n",
                                prefix_len=prefix_len)
    n = F.col("_n").cast("double")
    n_train = F.rint(n * F.lit(train))
    n_val = F.rint(n * F.lit(val))
    split = (F.when(F.col("_pos") < n_train, F.lit("train"))
              .when(F.col("_pos") < n_train + n_val, F.lit("val"))
              .otherwise(F.lit("test")))
    return ranked.select(key, split.alias("split"))


def hash_split(df: DataFrame, train: float, val: float, seed: int = DEFAULT_SEED,
               key: str = "ptid") -> DataFrame:
    """Side chosen from the subject's hash alone (one pass, no sort).
    Sizes are approximate; a subject keeps its side as others are added."""
    check_fractions(train, val)
    u = F.conv(F.substring(subject_hash(key, seed), 1, 8), 16, 10).cast("double") / F.lit(2.0 ** 32)
    split = (F.when(u < train, F.lit("train")).when(u < train + val, F.lit("val"))
              .otherwise(F.lit("test")))
    return df.withColumn("split", split)


def first_row_per_subject(df: DataFrame, key: str = "ptid",
                          order_cols: Sequence[str] | None = None) -> DataFrame:
    """A3: one row per subject, the first in ``order_cols`` order (by default
    every other column, so the choice is repeatable)."""
    order = list(order_cols) if order_cols else [c for c in df.columns if c != key]
    return first_k_per_group(df, [key], order, 1)


def cap_sessions(df: DataFrame, k: int, key: str = "ptid",
                 order_cols: Sequence[str] | None = None) -> DataFrame:
    """At most ``k`` rows per subject, first in ``order_cols`` order."""
    order = list(order_cols) if order_cols else [c for c in df.columns if c != key]
    return first_k_per_group(df, [key], order, k)


def split_train_val_test(df: DataFrame, train: float, val: float, seed: int = DEFAULT_SEED,
                         key: str = "ptid", order_cols: Sequence[str] | None = None,
                         caps: dict[str, int] | None = None, validate: bool = False) -> DataFrame:
    """W1 + J3/J4: rows routed to their subject's split, in one table with a
    ``split`` column.  Train keeps every row of its subjects, val and test one
    row per subject (A3); ``caps`` (W9) may bound rows per subject per split,
    e.g. ``{"train": 3}``.  Splits with the same cap share one branch, and a
    cap is applied with a partial top-k before the shuffle, so a subject with
    very many rows never lands whole in one task.  ``df`` is read once per
    distinct cap: persist it when it is expensive to recompute.
    ``validate`` (J5) checks the assignment is one row per subject (the
    ``m:1`` side) and capped splits keep at most their cap per subject."""
    # one row per subject, read by every routing branch: computed once
    assign = materialize(assign_splits(df, train, val, seed, key))
    if validate:
        assert_unique(assign, [key], "assignment")
    routed = df.join(assign, key, "inner")
    caps = {"train": None, "val": 1, "test": 1, **(caps or {})}
    order = list(order_cols) if order_cols else [c for c in df.columns if c != key]
    by_cap: dict = {}
    for name in SPLITS:
        by_cap.setdefault(caps.get(name), []).append(name)
    parts = []
    for cap, names in by_cap.items():
        part = routed.filter(F.col("split").isin(names))
        if cap is not None:
            part = first_k_per_group(part, [key], order, cap)
        parts.append(part)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if validate:
        for cap, names in by_cap.items():
            if cap is not None:
                over = (out.filter(F.col("split").isin(names)).groupBy(key)
                        .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > cap))
                if not over.isEmpty():
                    raise ValueError(f"more than {cap} rows per subject in {names}")
    return out.select(*df.columns, "split")


def balance_report(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                   split_col: str = "split", digits: int = 6) -> DataFrame:
    """Per split, size, mean and sample std of numeric attributes and the
    share of each category; plus rows ``split='max_gap'`` with the largest
    difference between splits for each metric (a category that a split lacks
    has share 0 there).  Long form
    ``(split, metric, value)``.

    One pass over ``df``: a grouping-sets aggregate per split and per
    (split, category value).  Its result is small (splits x category values)
    and is the only thing kept and read again."""
    cats = list(categorical)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in numeric:
        aggs += [F.avg(c).alias(f"_mean_{c}"), F.stddev_samp(c).alias(f"_std_{c}")]
    if cats:
        aggs += [F.grouping(c).alias(f"_g{i}") for i, c in enumerate(cats)]
        g = df.groupingSets([[split_col]] + [[split_col, c] for c in cats], split_col, *cats).agg(*aggs)
        whole_split = functools.reduce(operator.and_, [F.col(f"_g{i}") == 1 for i in range(len(cats))])
    else:
        g = df.groupBy(split_col).agg(*aggs)
        whole_split = F.lit(True)
    g = materialize(g)
    n_splits = g.select(F.count_distinct(F.struct(split_col))).scalar()

    def item(cond, metric, value):
        return F.when(cond, F.struct(metric.alias("metric"), value.cast("double").alias("value")))

    g = g.withColumn("_tot", F.max(F.when(whole_split, F.col("_n"))).over(Window.partitionBy(split_col)))
    total = F.col("_tot")
    items = [item(whole_split, F.lit("n"), F.col("_n"))]
    for c in numeric:
        items += [item(whole_split, F.lit(f"mean:{c}"), F.col(f"_mean_{c}")),
                  item(whole_split, F.lit(f"std:{c}"), F.col(f"_std_{c}"))]
    for i, c in enumerate(cats):
        label = F.concat(F.lit(f"share:{c}="), F.coalesce(F.col(c).cast("string"), F.lit("NULL")))
        items.append(item(F.col(f"_g{i}") == 0, label, F.col("_n") / total))
    long = (g.select(split_col, F.explode(F.filter(F.array(*items), lambda x: x.isNotNull())).alias("m"))
            .select(split_col, "m.metric", "m.value"))
    # the gap rows come from windows over this small table in the same chain
    # (a union with an aggregate of it would plan the input twice)
    w = Window.partitionBy("metric")
    lacking = F.col("metric").startswith("share:") & (F.count(F.lit(1)).over(w) < n_splits)
    least = F.when(lacking, F.lit(0.0)).otherwise(F.min("value").over(w))
    long = (long.withColumn("_gap", F.max("value").over(w) - least)
                .withColumn("_first", F.row_number().over(w.orderBy(split_col)) == 1))
    rows = F.array(
        F.struct(F.col(split_col).alias(split_col), F.col("metric"), F.col("value")),
        F.when(F.col("_first"), F.struct(F.lit("max_gap").alias(split_col), F.col("metric"),
                                         F.col("_gap").alias("value"))))
    out = long.select(F.explode(F.filter(rows, lambda x: x.isNotNull())).alias("r")).select("r.*")
    return out.select(split_col, "metric", F.round("value", digits).alias("value"))
