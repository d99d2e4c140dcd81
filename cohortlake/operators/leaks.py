"""D2 in free text: identifying values of any file found inside other elements, such as
comments and private tags, which the header edit leaves as they are.

An index of words finds the candidates.  An identifying value stands in a text only where
its words do, one after the other, so each value is looked up by the hash of its words (the
first ``WORDS`` of them) and a text sends the hashes of its runs of as many words as some
value has, without the text.  Values without a letter or digit are looked up by their first
n-gram.  Candidates are then searched for the whole value.  Nothing is broadcast, and no
file, text or value meets all others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.operators.deid import IDENTIFYING_KEYWORDS
from cohortlake.session import materialize

#: Characters of an n-gram; shorter values are not looked for.  Words of a value's key at most.
GRAM, WORDS = 4, 8


def _grams(text: Column, n: int) -> Column:
    return F.when(F.length(text) >= n, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(text) - (n - 1), F.lit(1))), lambda i: F.substring(text, i, F.lit(n)))))


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _key(found: Column, n: int) -> Column:
    """The hash that a value is looked up by."""
    words = _words(found)
    return F.when(F.size(words) > 0, F.xxhash64(F.slice(words, 1, WORDS))).otherwise(F.xxhash64(F.substring(found, 1, n)))


def _text_keys(text: Column, sizes: Column, n: int) -> Column:
    """The distinct hashes of a text's runs of ``sizes`` words, and for size 0 those of
    the n-grams between its words."""
    words = F.col("_words")
    runs = F.flatten(F.transform(F.filter(sizes, lambda k: (k > 0) & (k <= F.size(words))), lambda k: F.transform(
        F.sequence(F.lit(1), F.size(words) - k + 1), lambda i: F.xxhash64(F.slice(words, i, k)))))
    between = F.regexp_extract_all(text, F.lit(r"[^\p{L}\p{N}]{%d,}" % n), F.lit(0))
    grams = F.when(F.array_contains(sizes, 0), F.transform(F.flatten(F.transform(between, lambda x: _grams(x, n))), lambda g: F.xxhash64(g)))
    return F.array_distinct(F.concat(runs, F.coalesce(grams, F.array().cast("array<bigint>"))))


def identifying_values(elements: DataFrame, keywords: Sequence[str] = tuple(IDENTIFYING_KEYWORDS), parts: bool = True) -> DataFrame:
    """(file_path, keyword, value) of each file's top-level identifying elements, in lower
    case; with ``parts`` also the pieces of a name (cut at ``^``, commas and blanks)."""
    value = F.lower(F.trim("value"))
    found = elements.filter((F.col("depth") == 0) & F.col("keyword").isin(*keywords) & F.col("value").isNotNull())
    pieces = F.array_union(F.array(value), F.split(value, r"[\^,\s]+")) if parts else F.array(value)
    return found.select("file_path", "keyword", F.explode(pieces).alias("value")).filter("value <> ''").distinct()


def identifiers_in_text(elements: DataFrame, values: DataFrame | None = None, own_only: bool = False,
                        keywords: Sequence[str] = tuple(IDENTIFYING_KEYWORDS), gram: int = GRAM) -> DataFrame:
    """(file_path, elem_pos, keyword, value, found, found_keyword, owner): each element
    other than the identifying ones whose text holds an identifying value, as a whole
    word (no letter or digit before or after it), whatever the case.

    ``values(file_path, keyword, value)`` are those to look for (by default
    ``identifying_values``); ``own_only`` keeps each file's own.  Values shorter than
    ``gram`` are not looked for."""
    values = identifying_values(elements, keywords) if values is None else values
    wanted = materialize(values.select(F.col("file_path").alias("owner"), F.col("keyword").alias("found_keyword"),
                                       F.lower("value").alias("found")).filter(F.length("found") >= gram).distinct())
    asked = wanted.select("found").distinct().select("found", _key(F.col("found"), gram).alias("g"))
    sizes = wanted.agg(F.collect_set(F.least(F.size(_words(F.col("found"))), F.lit(WORDS)))).scalar()
    texts = elements.filter(F.col("value").isNotNull() & ~((F.col("depth") == 0) & F.coalesce(F.col("keyword").isin(*keywords), F.lit(False))))
    texts = texts.select("file_path", "elem_pos", "keyword", "value", F.lower("value").alias("_text"),
                         F.xxhash64("file_path", "elem_pos", "keyword", "value").alias("_id"))
    # only hashes meet; a text that has a value's words is then fetched, and searched
    keys = (texts.select("_id", "_text", _words(F.col("_text")).alias("_words")).withColumn("_sizes", sizes)
            .select("_id", F.explode(_text_keys(F.col("_text"), F.col("_sizes"), gram)).alias("g")))
    near = keys.join(asked, "g").select("_id", "found").distinct()
    pattern = F.concat(F.lit(r"(?<![\p{L}\p{N}])\Q"), F.replace(F.col("found"), F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E(?![\p{L}\p{N}])"))
    hits = (texts.join(near, "_id").filter(F.contains("_text", "found")).filter(F.rlike("_text", pattern))
            .drop("_id", "_text").distinct())
    whose = hits.join(wanted.withColumn("file_path", F.col("owner")), ["found", "file_path"]) if own_only else hits.join(wanted, "found")
    return whose.select("file_path", "elem_pos", "keyword", "value", "found", "found_keyword", "owner")
