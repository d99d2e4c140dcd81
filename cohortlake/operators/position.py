"""Row positions in a total order, globally or within groups (W2), and
ordered running aggregates (W8), without a single-task window.

One lazy, value-based method for every size.  A quantile sketch (the rows of smallest
hash, which merges by keeping the smallest again) cuts the order of (group, order
columns) into bins of about equally many rows, whatever the values: an outlier moves
no end, and rows that share a value are parted by the columns after it.  A row finds
its bin by binary search over the ends.  Rows are counted per (group, bin); summing
those counts over the bins before gives what precedes each bin.  That number enters the
bin as one marker row, ahead of the bin's own rows, so one running sum per (group, bin)
yields positions: one shuffle of the rows, on (group, bin), and no join.  A group
smaller than a bin lies in one or two of them; only bins in which a group goes on have a
marker, so there are no more markers than bins.  A hot group is spread over its bins.

``order_cols`` must be a total order inside a group (add a unique
tie-breaker), otherwise positions among ties are arbitrary.  Bins are cut by the order
columns given by name before the first given as an expression.  The input is read three
times (sketch, counts, rows) and must give the same rows each time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BIN, _MARK, _W = "_bin", "_mark", "_w"
#: Bins per shuffle partition of the session, and rows of the sketch per bin.
BINS_PER_PARTITION, SKETCH_PER_BIN = 16, 16


def _cols(cols) -> list:
    if cols is None:
        return []
    if isinstance(cols, (str, Column)):
        return [cols]
    return list(cols)


def _names(cols) -> list[str]:
    return [c for c in cols if isinstance(c, str)]


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.MapType, T.VariantType))


def _bin_ends(df: DataFrame, key: Column, hashed: Sequence[str], n: int) -> DataFrame:
    """One row, one column: the lower ends of bins 1 to n-1, in order."""
    sketch = (df.select(key.alias("key"), F.xxhash64(*hashed).alias("h")).orderBy("h").limit(n * SKETCH_PER_BIN)
              .agg(F.sort_array(F.collect_list("key")).alias("s")))
    count = F.size("s")
    at = F.transform(F.sequence(F.lit(1), F.lit(max(n - 1, 1))), lambda i: F.floor(i * count / n).cast("int"))
    return sketch.select(F.when(count > 0, F.array_distinct(F.transform(at, lambda i: F.get("s", i)))).alias("ends"))


def _with_bin(df: DataFrame, order_cols: Sequence, n: int | None, groups: Sequence[str] = ()) -> DataFrame:
    """``df`` with the number of its bin, 0 to n-1, in the order of (groups, order columns)."""
    order = _cols(order_cols)
    if not isinstance(order[0], str):
        raise TypeError("the first order column must be given by its name (ascending)")
    n = n or BINS_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = order[:next((i for i, c in enumerate(order) if not isinstance(c, str)), len(order))]
    keys = list(dict.fromkeys([*groups, *named]))
    key = F.struct(*keys)
    # rows of equal key are told apart by the others, or they would crowd the sketch
    hashed = keys if len(named) == len(order) else [f.name for f in df.schema.fields if not _has_map(f.dataType)]
    both = df.withColumn("_ends", _bin_ends(df, key, hashed, n).scalar()).withColumn("_key", key)
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(max(n - 1, 1).bit_length()))])
    at = F.aggregate(steps, F.lit(0), lambda low, step: F.when(
        F.get("_ends", low + step - 1) <= F.col("_key"), low + step).otherwise(low))
    return both.withColumn(_BIN, at).drop("_ends", "_key")


def _frames(groups: list[str], order_cols: Sequence):
    """(bins before this one in the group, this bin up to the current row)."""
    bins = Window.partitionBy(*(groups or [F.lit(0)])).orderBy(_BIN)
    rows = Window.partitionBy(*groups, _BIN).orderBy(F.desc(_MARK), *_cols(order_cols))
    return (bins.rowsBetween(Window.unboundedPreceding, -1),
            rows.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def _marked(rows: DataFrame, marks: DataFrame) -> DataFrame:
    return (rows.withColumn(_MARK, F.lit(False))
            .unionByName(marks.withColumn(_MARK, F.lit(True)), allowMissingColumns=True))


def with_position(df: DataFrame, order_cols: Sequence, group_cols: Sequence = (),
                  pos_col: str = "pos", total_col: str | None = None,
                  num_partitions: int | None = None) -> DataFrame:
    """Add ``pos_col``: 0-based position (bigint) in ``order_cols`` order,
    inside ``group_cols`` groups when given, else over the whole table.

    ``total_col`` (global form only) adds the table's row count to every row.
    ``num_partitions``: bins over the whole order.
    NULL is a group like any other; an empty table stays empty.
    """
    groups = _names(_cols(group_cols))
    if groups and total_col:
        raise ValueError("total_col is only supported for the global position")
    rows = _with_bin(df, order_cols, num_partitions, groups)
    before, upto = _frames(groups, order_cols)
    counts = rows.groupBy(*groups, _BIN).agg(F.count(F.lit(1)).alias("_cnt"))
    total = [F.sum("_cnt").over(Window.partitionBy(F.lit(0))).alias("_total")] if total_col else []
    marks = counts.select(*groups, _BIN, F.sum("_cnt").over(before).alias(_W), *total)
    if not total:
        marks = marks.filter(F.col(_W).isNotNull())
    extra = [(F.sum(_W).over(upto) - 1).alias(pos_col)]
    if total_col:
        extra.append(F.first("_total", ignorenulls=True).over(upto).alias(total_col))
    out = _marked(rows.withColumn(_W, F.lit(1).cast("long")), marks)
    return out.select(*df.columns, *extra, _MARK).where(~F.col(_MARK)).drop(_MARK)


def with_hash_position(df: DataFrame, hash_col: str, tie_cols: Sequence[str] = (),
                       pos_col: str = "pos", total_col: str | None = None,
                       prefix_len: int = 3) -> DataFrame:
    """Global position in (``hash_col``, ``tie_cols``) order when ``hash_col``
    is a uniformly distributed hex digest (md5 and the like).

    Rows are bucketed by the first ``prefix_len`` hex digits (16**prefix_len
    buckets, 4096 by default).  Bucket order is digest order, so a row's
    position is the number of rows in earlier buckets (from the per-bucket
    counts: at most 16**prefix_len rows, broadcast with that bound) plus its
    rank inside its bucket.  Buckets are even for distinct keys, so no task
    holds a hot bucket; everything is value-based, so no checkpoint is
    needed."""
    bucket = F.substring(F.col(hash_col), 1, prefix_len)
    b = df.withColumn("_bucket", bucket)
    counts = b.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = counts.select(
        "_bucket",
        (F.sum("_cnt").over(Window.orderBy("_bucket")) - F.col("_cnt")).alias("_off"),
        F.sum("_cnt").over(Window.partitionBy(F.lit(0))).alias("_total"))
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(hash_col, *tie_cols)) - 1
    ranked = b.withColumn("_rank", rank)
    joined = ranked.join(F.broadcast(offsets), "_bucket", "left")
    extra = [(F.col("_off") + F.col("_rank")).cast("long").alias(pos_col)]
    if total_col:
        extra.append(F.col("_total").alias(total_col))
    return joined.select(*df.columns, *extra)


def running_max(df: DataFrame, value_col: str, order_cols: Sequence, group_cols: Sequence,
                out_col: str = "running_max", num_partitions: int | None = None) -> DataFrame:
    """Highest ``value_col`` seen so far in ``order_cols`` order per group (W8):
    a bin's marker row carries the highest value of the bins before it."""
    groups = _names(_cols(group_cols))
    rows = _with_bin(df, order_cols, num_partitions, groups)
    before, upto = _frames(groups, order_cols)
    highest = rows.groupBy(*groups, _BIN).agg(F.max(value_col).alias("_high"))
    marks = highest.select(*groups, _BIN, F.max("_high").over(before).alias(_W)).filter(F.col(_W).isNotNull())
    out = _marked(rows.withColumn(_W, F.col(value_col)), marks)
    return (out.select(*df.columns, F.max(_W).over(upto).alias(out_col), _MARK)
            .where(~F.col(_MARK)).drop(_MARK))


def first_k_per_group(df: DataFrame, group_cols: Sequence, order_cols: Sequence, k: int,
                      rank_col: str | None = None) -> DataFrame:
    """Rows ranked 1..k per group.  ``row_number() <= k`` lets Spark put a
    partial WindowGroupLimit before the shuffle, so a hot group sends at most
    k rows per map task.  Spark does so for k up to the session's
    ``spark.sql.optimizer.windowGroupLimitThreshold`` (``get_spark`` sets it)."""
    rn = F.row_number().over(Window.partitionBy(*_cols(group_cols)).orderBy(*_cols(order_cols)))
    name = rank_col or "_rank"
    out = df.withColumn(name, rn).filter(F.col(name) <= k)
    return out if rank_col else out.drop(name)


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = "n") -> DataFrame:
    """Keys occurring more than once, with their counts (J5's evidence)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
            .filter(F.col(count_col) > 1))


def assert_unique(df: DataFrame, keys: Sequence[str], side: str = "") -> DataFrame:
    """Raise if ``keys`` repeat in ``df`` (join ``validate='1:1'``/``'m:1'``)."""
    if not duplicate_keys(df, keys).isEmpty():
        raise ValueError(f"keys {list(keys)} are not unique{' on the ' + side + ' side' if side else ''}")
    return df
