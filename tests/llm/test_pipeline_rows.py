"""The whole pipeline on rows that are not as they should be."""

import os

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, `row` int, copy string, fp long, kept boolean, "
          "tags map<string,string>, parts array<struct<a:int>>, path string, pii string")


def rows():
    prose = ["the quick brown fox jumps over the lazy dog while the cat sleeps in the warm afternoon sun by the old mill",
             "call me at (212) 555-7713 or write to jane.doe@example.org before the end of the month please and thank you",
             "a benchmark question that nobody should ever have seen before it was asked in the exam of that year"]
    out = [(i, prose[i % 3] + f" number {i} " + " ".join(f"w{i * 31 + j}" for j in range(40))) for i in range(30)]
    out += [(100, None), (101, ""), (102, " \n"), (None, prose[0]), (None, None), (103, out[0][1]), (103, out[0][1]), (103, out[1][1]),
            (104, "word " * 50_000)]
    return [(d, t, "en", "src" if d is None or d % 2 else None, None if t is None else len(t), 1, "c", 2, None, {"k": "v"}, [(1,)], "p", "x")
            for d, t in out]


def write(spark, folder, docs):
    docs.write.parquet(os.path.join(folder, "documents.parquet"))
    spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(os.path.join(folder, "labels.parquet"))
    spark.createDataFrame([("b1", "that nobody should ever have seen before it was asked in the exam"), ("b2", None)],
                          "item_id string, text string").write.parquet(os.path.join(folder, "benchmark.parquet"))


@pytest.fixture()
def unjudged(monkeypatch):
    """The classifier's own verdicts are tested elsewhere: here it keeps all."""
    stages = [(n, f if n != "quality classifier" else lambda spark, docs, sf: docs) for n, f in corpus_pipeline.STAGES]
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages)


def test_all_stages(spark, tmp_dir, unjudged):
    write(spark, tmp_dir, spark.createDataFrame(rows(), SCHEMA))
    got = corpus_pipeline.run(spark, tmp_dir).collect()
    ids = [r["doc_id"] for r in got]
    # near copies and passages of the benchmark are gone, all else is there once
    assert sorted(i for i in ids if i is not None and i < 100) == [i for i in range(30) if i % 3 != 2]
    assert ids.count(None) == 2 and 104 in ids and len([i for i in ids if i in (100, 101, 102)]) == 1
    assert 103 not in ids
    texts = {r["doc_id"]: bytes(r["decoded"]).decode() for r in got}
    assert "555-7713" not in texts[1] and "jane.doe" not in texts[1] and texts[0] == rows()[0][1]


def test_the_classifier_takes_such_rows(spark, tmp_dir):
    write(spark, tmp_dir, spark.createDataFrame(rows(), SCHEMA))
    docs = corpus_pipeline.table(spark, tmp_dir, "documents")
    out = corpus_pipeline.quality(spark, docs, tmp_dir)
    assert out.columns == docs.columns and out.count() <= docs.count()


def test_no_documents(spark, tmp_dir):
    write(spark, tmp_dir, spark.createDataFrame([], SCHEMA))
    assert corpus_pipeline.run(spark, tmp_dir).count() == 0
