"""Streaming meetings: the rows of a key are held by one task while others pass by."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def meet(holders: DataFrame, visitors: DataFrame, work: Callable[[pa.Table, pa.Table], Iterator[pa.Table]],
         schema: str, each: int) -> DataFrame:
    """``work(held, passing)`` for the holders of each (key, salt) and slices of at
    most ``each`` of its visitors.  Both sides have longs ``key`` and ``salt``; columns
    that one side lacks are null there.  A task holds one key's holders and one
    slice, however many visitors there are; salts deal a key to several tasks."""
    def run(batches):
        held, key, keep = [], None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            keys = np.stack([t.column(n).to_numpy().astype(np.int64) for n in ("key", "salt", "kind")], 1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                part, now = t.slice(a, b - a), tuple(keys[a, :2].tolist())
                if now != key:
                    held, key, keep = [], now, None
                if keys[a, 2] == 0:
                    held.append(part)
                    continue
                if held:
                    keep, held = pa.concat_tables(held), []
                if keep is None:
                    continue
                for i in range(0, len(part), each):
                    for out in work(keep, part.slice(i, each)):
                        yield from out.to_batches()

    both = (holders.withColumn("kind", F.lit(0)).unionByName(visitors.withColumn("kind", F.lit(1)), allowMissingColumns=True))
    return both.repartition("key", "salt").sortWithinPartitions("key", "salt", "kind").mapInArrow(run, schema)


class Once:
    """What ``make`` builds of the holders, kept while the holders are the same."""

    def __init__(self, make):
        self.make, self.of, self.value = make, None, None

    def __call__(self, table):
        if table is not self.of:
            self.of, self.value = table, self.make(table)
        return self.value
