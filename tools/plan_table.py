"""Per-query plan statistics from the executed (adaptive) plans.

    python tools/plan_table.py [sf_dir]

Prints a markdown table: shuffle exchanges, single-partition exchanges,
broadcast exchanges, join kinds, partial top-k, cached inputs and Python in
tasks, after running each query once into the noop sink.  Operators inside
cached relations are not counted (they ran when the cache was filled).
"""

from __future__ import annotations

import os
import sys
import tempfile

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)


def _operators(qe) -> list[tuple[str, str]]:
    """(node name, one-line description) of every operator this query runs.
    Cached relations are fields of their scans, not children, so their plans
    (which ran when the cache was filled) are not included."""
    out = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        out.append((name, node.simpleString(200)))
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(qe.executedPlan())
    return out


def main(argv: list[str]) -> None:
    from cohortlake.queries import QUERIES
    from cohortlake.session import get_spark
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark(8, extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp")})
    print("| query | shuffles | single-partition | broadcasts | SMJ | BHJ | partial top-k | cached input | Python in tasks |")
    print("|---|---|---|---|---|---|---|---|---|")
    for name, fn in QUERIES.items():
        df = fn(spark, sf)
        df.write.format("noop").mode("overwrite").save()
        ops = _operators(df._jdf.queryExecution())
        names = [n for n, _ in ops]
        shuffles = [d for n, d in ops if n == "Exchange"]
        single = [d for d in shuffles if "SinglePartition" in d]
        print(f"| `{name}` | {len(shuffles)} | {len(single)} | {names.count('BroadcastExchange')} | "
              f"{names.count('SortMergeJoin')} | {names.count('BroadcastHashJoin')} | "
              f"{names.count('WindowGroupLimit')} | {'yes' if 'InMemoryTableScan' in names else ''} | "
              f"{'yes' if any('MapInArrow' in n for n in names) else ''} |")
        spark.catalog.clearCache()


if __name__ == "__main__":
    main(sys.argv)
