"""License scans with a positional rare-token index.

The index has, for each license template, its words of highest IDF (by document
counts over all documents) with their places in the template.  A document looks
up its own postings of those words; postings that put a template at the same
start are intersected, and an alignment counts only if the template's mandatory
key phrase stands at its place.  DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases that always count: label, words.
BASE = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]
#: Templates: label, words, key phrase.
TEMPLATES = [
    ("mit", "released under the mit license", "mit license"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software", "free of charge"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "general public license version 2"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "general public license version 3"),
    ("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software released into the public domain"),
]
#: Index words a template, words kept around a posting, share of index weight that makes a label.
RARE, AROUND, ENOUGH = 4, 24, 0.6


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def _entries() -> list[tuple[int, str, list[str], list[str], bool]]:
    """(number, label, words, key phrase, whether it is a base phrase)."""
    rows = [(label, phrase, phrase, True) for label, phrase in BASE] + [(*t, False) for t in TEMPLATES]
    return [(i, label, words.split(), key.split(), base) for i, (label, words, key, base) in enumerate(rows)]


def _at(words: list[str], key: list[str]) -> int:
    return next(i for i in range(len(words)) if words[i:i + len(key)] == key)


def document_counts(docs: DataFrame, text: str = "text") -> tuple[int, dict[str, int]]:
    """Number of documents, and of documents that have each template word (as
    many rows as the templates have words)."""
    vocabulary = sorted({w for e in _entries() for w in e[2]})
    found = docs.select(F.explode(F.concat(
        F.array(F.lit("")), F.array_intersect(words_of(F.col(text)), F.array(*map(F.lit, vocabulary))))).alias("w"))
    counts = {r["w"]: r["n"] for r in found.groupBy("w").agg(F.count("*").alias("n")).collect()}
    return counts.pop("", 0), counts


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, found)
    for every row of ``docs``.

    Words are runs of digits, a-z and non-ASCII characters after A-Z are
    lower-cased.  n_base counts the places of base phrases, first_word and
    last_word their least and greatest start (null: none); found lists the
    template alignments (label, start, score), score is the best one's share of
    index weight.  Null and empty texts have no words; rows that repeat get equal
    results; other columns are not read; an empty table gives an empty result."""
    spark = docs.sparkSession
    total, counts = document_counts(docs, text)
    idf = {w: math.log((total + 1) / (counts.get(w, 0) + 1)) + 1 for e in _entries() for w in e[2]}
    index, weight = [], {}
    for number, label, words, key, base in _entries():
        places = {w: i for i, w in reversed(list(enumerate(words)))}
        rare = sorted(places, key=lambda w: (-idf[w], w))[:1 if base else RARE]
        weight[number] = sum(idf[w] for w in rare)
        index += [(w, number, label, places[w], idf[w], key, _at(words, key), base) for w in rare]
    index = spark.createDataFrame(
        [(*r, weight[r[1]]) for r in index],
        "token string, number int, label string, offset int, idf double, key array<string>, key_at int, base boolean, weight double")
    tokens = F.array(*[F.lit(w) for w in sorted({r["token"] for r in index.select("token").collect()})])
    near = F.transform("words", lambda w, i: F.when(F.array_contains(tokens, w), F.struct(
        i.alias("at"), w.alias("token"), F.greatest(i - AROUND, F.lit(0)).alias("from"),
        F.slice("words", F.greatest(i - AROUND, F.lit(0)) + 1, F.lit(2 * AROUND + 1)).alias("around"))))
    rows = stored(
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text).cast("string")).alias("copy"),
                    words_of(F.col(text)).alias("words"))
        .select("doc_id", "copy", F.size("words").cast("long").alias("n_words"),
                F.when(F.arrays_overlap("words", tokens), F.filter(near, lambda x: x.isNotNull())).alias("postings")),
        "postings")
    start = (F.col("at") - F.col("offset")).alias("start")
    aligned = (rows.select("doc_id", "copy", F.explode("postings").alias("p")).select("doc_id", "copy", "p.*").distinct()
               .join(F.broadcast(index), "token")
               .groupBy("doc_id", "copy", "number", start, "label", "base", "key", "key_at", "weight")
               .agg(F.sum("idf").alias("got"), F.min(F.struct("from", "around")).alias("c")))
    place = F.col("start") + F.col("key_at")
    aligned = (aligned.where((place >= F.col("c.from")) & (F.slice("c.around", F.greatest(place - F.col("c.from") + 1, F.lit(1)), F.size("key")) == F.col("key")))
               .withColumn("score", F.least(F.col("got") / F.col("weight"), F.lit(1.0))))
    is_base, enough = F.col("base"), ~F.col("base") & (F.col("score") >= ENOUGH)
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    hits = aligned.groupBy("doc_id", "copy").agg(
        F.count_if(is_base).alias("n_base"), F.min(F.when(is_base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(is_base, F.col("start"))).cast("long").alias("last_word"),
        joined(F.when(is_base, F.col("label"))).alias("base_labels"),
        joined(F.when(is_base | enough, F.col("label"))).alias("labels"),
        F.max(F.when(enough, F.col("score"))).alias("score"),
        F.array_sort(F.collect_set(F.when(enough, F.struct("label", F.col("start").cast("long").alias("start"), "score")))).alias("found"))
    same = F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("d.copy") == F.col("h.copy"))
    return (rows.alias("d").join(hits.alias("h"), same, "left")
            .select("d.doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
                    F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
                    F.coalesce("score", F.lit(0.0)).alias("score"), "found"))
