"""Splits that are alike in given attributes (A8 with W1): exact sizes over all, and in
each stratum the share that a split has over all, rounded.

The numbers per stratum come from a grouped aggregate, by largest remainders that share
one total: what a stratum's exact share of val (then of test) is above a whole number is
its claim, and the largest claims round up until the split is full.  Claims are ranked
with the library's positions, so no task holds all strata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.operators.position import with_position
from cohortlake.operators.split import DEFAULT_SEED, check_fractions, subject_hash
from cohortlake.session import materialize


def with_quantile_bin(df: DataFrame, col: str, bins: int, out: str, accuracy: int = 10000) -> DataFrame:
    """Add ``out``: the bin (0 to ``bins`` - 1) of a numeric attribute, cut at its
    quantiles; null and NaN have none.  The ends come from a mergeable sketch."""
    at = [i / bins for i in range(1, bins)]
    known = F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double"))
    ends = df.filter(known).agg(F.percentile_approx(col, at, accuracy).alias("e")).scalar()
    return (df.withColumn("_ends", ends)
            .withColumn(out, F.when(known, F.size(F.filter("_ends", lambda e: e < F.col(col))))).drop("_ends"))


def _targets(total: Column, train: float, val: float) -> tuple[Column, Column]:
    """Subjects of val and of test, as ``assign_splits`` counts them."""
    n = total.cast("double")
    n_train, n_val = F.rint(n * F.lit(train)).cast("long"), F.rint(n * F.lit(val)).cast("long")
    return n_val, total - n_train - n_val


def _claimed(cells: DataFrame, keys: list[str], room: Column, claim: Column, target: Column, total: Column, name: str) -> DataFrame:
    """``cells`` with the subjects of one split: the whole part of the share, and one
    more for the largest claims that have room, until the target is reached; if claims
    with room run out, the others with the most room left take the rest."""
    whole = F.floor(F.col("_n") * target / total).cast("long")
    c = (cells.withColumn("_whole", F.expr("0L") + whole)
         .withColumn("_full", (room < whole + 1).cast("int")).withColumn("_claim", -claim))
    c = with_position(c, ["_full", "_claim", *keys], pos_col="_place")
    rest = target - c.agg(F.sum("_whole").alias("s")).scalar()
    return c.withColumn(name, F.col("_whole") + (F.col("_place") < rest).cast("long")).drop("_whole", "_full", "_claim", "_place")


def stratum_sizes(subjects: DataFrame, strata: Sequence[str], train: float, val: float) -> DataFrame:
    """Per stratum: (strata..., n, train, val, test)."""
    keys = list(strata)
    cells = materialize(subjects.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")))
    total = cells.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("s")).scalar()
    n_val, n_test = _targets(total, train, val)
    n = F.col("_n")
    first = _claimed(cells, keys, n, (n * n_val) % total, n_val, total, "val")
    # what the shares of val and test leave over together: train is off by as little as may be
    left = (n * n_val) % total + (n * n_test) % total - (F.col("val") - F.floor(n * n_val / total)) * total
    both = _claimed(materialize(first), keys, n - F.col("val"), left, n_test, total, "test")
    return both.select(*keys, n.alias("n"), (n - F.col("val") - F.col("test")).alias("train"), "val", "test")


def assign_stratified(df: DataFrame, strata: Sequence[str], train: float, val: float, seed: int = DEFAULT_SEED,
                      key: str = "ptid") -> DataFrame:
    """One row per subject (``key``, strata..., ``split``).  Sizes over all are those of
    ``assign_splits``.  In a stratum, val has its exact share rounded up or down; test
    too; train has the rest, so it is less than two subjects off its share.  Which
    subjects: the order of their seeded hash, as in ``assign_splits``.

    ``df`` holds a subject's strata in each of its rows; of several values the least
    counts.  Null is a stratum like any other; null subjects take no place.  A stratum
    of a third of all subjects is spread over its positions."""
    check_fractions(train, val)
    keys = list(strata)
    subjects = df.filter(F.col(key).isNotNull()).groupBy(key).agg(*[F.min(k).alias(k) for k in keys])
    subjects = materialize(subjects.withColumn("_h", subject_hash(key, seed)))
    sizes = stratum_sizes(subjects, keys, train, val).select(*[F.col(k).alias(f"_s_{k}") for k in keys], "train", "val")
    ranked = with_position(subjects, ["_h", key], keys, pos_col="_place")
    same = [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys]
    on = same[0]
    for s in same[1:]:
        on = on & s
    split = (F.when(F.col("_place") < F.col("train"), F.lit("train"))
             .when(F.col("_place") < F.col("train") + F.col("val"), F.lit("val")).otherwise(F.lit("test")))
    return ranked.join(sizes, on).select(key, *keys, split.alias("split"))


def stratum_gaps(assigned: DataFrame, strata: Sequence[str], split_col: str = "split") -> DataFrame:
    """Per stratum and split: (strata..., split, n, gap), the gap being the subjects
    above (or below) the share that the split has over all.  Splits that a stratum
    lacks count with n = 0."""
    keys = list(strata)
    each = materialize(assigned.groupBy(*keys, split_col).agg(F.count(F.lit(1)).alias("n")))
    of_split = each.groupBy(split_col).agg(F.sum("n").alias("s"))
    of_split = of_split.agg(F.sort_array(F.collect_list(F.struct(split_col, "s"))).alias("a")).scalar()
    total = each.agg(F.sum("n").alias("t")).scalar()
    have = each.groupBy(*keys).agg(F.sum("n").alias("m"), F.map_from_entries(F.collect_list(F.struct(split_col, "n"))).alias("by"))
    rows = have.select(*keys, "m", "by", F.explode(of_split).alias("o"))
    n = F.coalesce(F.try_element_at("by", F.col(f"o.{split_col}")), F.lit(0).cast("long"))
    return rows.select(*keys, F.col(f"o.{split_col}").alias(split_col), n.alias("n"),
                       (n - F.col("m") * F.col("o.s") / total).alias("gap"))
