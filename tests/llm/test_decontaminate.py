"""Windows that many items share, and very long texts."""

import resource

from cohortlake.llm import arrays, decontaminate
from pyspark.sql import functions as F


def test_shared_windows_are_one_row(spark):
    """300 documents and 300 items with one passage: rows by documents plus items."""
    passage = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(i, f"own{i} {passage} end{i}") for i in range(300)], "doc_id long, text string")
    items = spark.createDataFrame([(f"i{i:03}", f"q{i} {passage}") for i in range(300)], "item_id string, text string")
    seen = []
    real = decontaminate.stored

    def counted(df, name, *more):
        out = real(df, name, *more)
        seen.append((name, out.count()))
        return out

    decontaminate.stored = counted
    try:
        rows = decontaminate.contamination(docs, items, window=10).collect()
    finally:
        decontaminate.stored = real
    assert all(r["n_hit"] == 12 and r["n_items"] == 300 and r["items"] == sorted(r["items"]) for r in rows) and len(rows) == 300
    sizes = dict(seen)
    assert sizes["prefixes"] == 303 and sizes["places"] <= 600 and sizes["hits"] == 300


def test_a_long_text_with_a_one_word_item(spark):
    """More symbols than a chunk, every other word hit."""
    text = "the cat " * 150_000
    assert len(text) > 2 * arrays.CHUNK
    docs = spark.createDataFrame([(1, text), (2, "no such word"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([("a", "The"), ("b", "cat the cat"), ("c", None), (None, "word")], "item_id string, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in decontaminate.contamination(docs, items).collect()}
    assert got == {1: (300_000, 300_000, ["a", "b"]), 2: (3, 1, []), 3: (0, 0, [])}


def test_rows_of_places_are_small():
    import numpy as np
    import pyarrow as pa
    bits = np.full(decontaminate.FILTER_BITS // 8, 255, np.uint8)      # everything is a candidate
    run = decontaminate._places(bits, 10)
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1], pa.int64()), "copy": pa.array([1], pa.int64()), "text": ["ab cd " * 100_000]})
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    most = max(b.nbytes for b in run([batch]))
    assert most < 4 << 20 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 400 << 10
