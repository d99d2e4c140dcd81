"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir), calls one operator over all rows that its
predecessor kept, and returns a DataFrame that is written and read again for the
next one.  All but the last return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlake.llm.common import stored, table


def _matching(docs, chosen):
    """Rows of ``docs`` whose (doc_id, text) has a row in ``chosen`` (doc_id, copy)."""
    same = F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.xxhash64("d.text") == F.col("c.copy"))
    return docs.alias("d").join(chosen.distinct().alias("c"), same, "left_semi")


def quality(spark, docs, sf_dir):
    """Documents that the classifier rejects go."""
    from cohortlake.llm.quality import classify
    judged = classify(docs, table(spark, sf_dir, "labels"))
    return _matching(docs, judged.where("kept").select("doc_id", "copy"))


def near_dedup(spark, docs, sf_dir):
    """One row of each group of near copies stays: the one of smallest doc_id, then
    text hash, then hash of all columns.  A doc_id with several texts keeps each
    text that is the first of its group; documents without a doc_id can't be told
    apart and stay."""
    from cohortlake.llm.simhash import first_copies, row_hash
    same = ((F.col("d.doc_id") == F.col("c.doc_id")) & (F.xxhash64("d.text") == F.col("c.copy"))
            & (row_hash(docs, "d.") == F.col("c.row")))
    first = first_copies(docs, shingle=4, bits=4)
    kept = docs.alias("d").join(first.alias("c"), same, "left_semi")
    once = kept.withColumn("_row", row_hash(docs)).dropDuplicates(["doc_id", "_row"]).drop("_row")  # rows that repeat whole
    return once.unionByName(docs.where("doc_id is null"))


def decontaminate(spark, docs, sf_dir):
    """Documents in which a window of a benchmark item occurs go."""
    from cohortlake.llm.decontaminate import contamination
    found = contamination(docs, table(spark, sf_dir, "benchmark"), window=10)
    return _matching(docs, found.where("NOT contaminated").select("doc_id", "copy"))


def pseudonymize(spark, docs, sf_dir):
    """Personal data becomes pseudonyms of the same format."""
    from cohortlake.llm.pii import pseudonymize as replace
    return replace(docs).select(*docs.columns)


def encode(spark, docs, sf_dir):
    """Token ids of every document, and the bytes they decode to."""
    import public_tokenizers

    from cohortlake.llm.bpe import encode as bpe
    from cohortlake.llm.bpe import read_ranks
    return bpe(docs, read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN)


STAGES = [("quality classifier", quality), ("SimHash near-dedup", near_dedup), ("benchmark decontamination", decontaminate),
          ("PII", pseudonymize), ("byte-level BPE encoding and decoding", encode)]

#: The classifier, the fingerprints and the pseudonyms have no SQL form.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
