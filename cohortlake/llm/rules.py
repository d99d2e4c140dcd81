"""Quality rules as learned decision lists.

Base statistics of a text are DataFrame expressions.  Sequential covering learns
an ordered list of rules for bad documents from labelled statistics: a rule
grows by the threshold that raises its FOIL gain most, is pruned on held-out
rows while its precision there doesn't fall, and what it covers is set aside
before the next one.  The list becomes one ordered Spark conditional.

Learning reads a bounded sample of labelled rows (``sample``), counted by Spark
in cells of binned statistics; only those counts reach the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Thresholds of each statistic (the learner's candidate cuts).
CUTS = {
    "repeat_share": [0.05, 0.1, 0.2, 0.3, 0.5],
    "symbol_share": [0.005, 0.01, 0.02, 0.05, 0.1],
    "upper_share": [0.1, 0.2, 0.4, 0.6],
    "dup_line_share": [0.1, 0.3, 0.5],
    "mean_word": [3.0, 4.0, 8.0, 12.0],
    "n_words": [10, 20, 50, 100],
}
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_upper) of
    every row.  Repeated three-word windows are found by sorting the window
    hashes of a document; a text is never split over rows."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    without = lambda chars: F.char_length("body") - F.char_length(F.translate("body", chars, ""))
    lines = F.filter(F.split("body", "\n"), lambda x: F.char_length(F.translate(x, SPACES, "")) > 0)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), body.alias("body"))
    rows = rows.select(
        "doc_id", F.regexp_extract_all("body", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)).alias("words"),
        F.char_length(F.translate("body", SPACES, "")).cast("long").alias("word_chars"),
        without("#*$%&|<>").cast("long").alias("n_symbols"), without(UPPER).cast("long").alias("n_upper"),
        lines.alias("lines"))
    window = F.when(F.size("words") >= 3, F.transform(F.sequence(F.lit(0), F.size("words") - 3), lambda i: F.xxhash64(
        F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)))).otherwise(F.array().cast("array<long>"))
    rows = rows.select("doc_id", F.size("words").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_upper",
                       (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), window.alias("h"))
    # only documents in which a window repeats are sorted
    ordered = F.when(F.size(F.array_distinct("h")) < F.size("h"), F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
    rows = rows.select("*", ordered.alias("s")).drop("h")
    twice = F.transform("s", lambda x, j: F.when(
        (x["h"] == F.get("s", j - 1)["h"]) | (x["h"] == F.get("s", j + 1)["h"]), x["i"]))
    rows = rows.select("*", F.sort_array(F.filter(twice, lambda x: x.isNotNull())).alias("at")).drop("s")
    gaps = F.transform("at", lambda p, j: F.least(F.lit(3), F.coalesce(F.get("at", j + 1) - p, F.lit(3))))
    total = F.aggregate(gaps, F.lit(0), lambda acc, x: acc + x)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       F.coalesce(total, F.lit(0)).cast("long").alias("n_repeat_words"), "n_upper")


def features() -> dict[str, Column]:
    """The learner's statistics, by the base ones."""
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {"repeat_share": share("n_repeat_words", "n_words"), "symbol_share": share("n_symbols", "word_chars"),
            "upper_share": share("n_upper", "word_chars"), "dup_line_share": share("n_dup_lines", "n_words") * 10,
            "mean_word": share("word_chars", "n_words"), "n_words": F.col("n_words").cast("double")}


Condition = tuple[str, float, bool]  # statistic, threshold, at least (else below)


def _bin(name: str) -> Column:
    """How many thresholds the statistic reaches."""
    value = features()[name]
    return sum((F.when(value >= c, 1).otherwise(0) for c in CUTS[name]), F.lit(0)).alias(name)


def cells(stats: DataFrame, labels: DataFrame, sample: int, doc_id: str = "doc_id", label: str = "quality") -> list:
    """Counts of good and bad sampled rows by binned statistics, in two halves (grow
    and prune).  The sample is the ``sample`` labelled documents of least hash."""
    known = (labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
             .groupBy(F.col(doc_id).cast("long").alias("doc_id")).agg(F.min(label).alias("good"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    half = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(3)) == 0
    return (stats.join(known, "doc_id").select(*[_bin(n) for n in CUTS], half.alias("held"), "good")
            .groupBy(*CUTS, "held").agg(F.count_if(F.col("good") == 0).alias("bad"), F.count_if(F.col("good") != 0).alias("fine"))
            .collect())


def learn(rows: list, most_rules: int = 8, most_conditions: int = 3, precision: float = 0.9, least: int = 5) -> list[list[Condition]]:
    """Ordered rules for bad documents, each a conjunction of thresholds."""
    grow = [r for r in rows if not r["held"]]
    prune = [r for r in rows if r["held"]]
    conditions = [(n, i, up) for n in CUTS for i in range(1, len(CUTS[n]) + 1) for up in (True, False)]
    holds = lambda r, c: (r[c[0]] >= c[1]) == c[2]
    counts = lambda some: (sum(r["bad"] for r in some), sum(r["fine"] for r in some))
    right = lambda bad, fine: (bad + 1) / (bad + fine + 2)
    out = []
    for _ in range(most_rules):
        rule, left = [], grow
        while len(rule) < most_conditions:
            b0, f0 = counts(left)
            if not b0 or not f0:
                break
            best = (0.0, None)
            for c in conditions:
                b, f = counts([r for r in left if holds(r, c)])
                if b >= least and (gain := b * (math.log2(b / (b + f)) - math.log2(b0 / (b0 + f0)))) > best[0]:
                    best = (gain, c)
            if best[1] is None:
                break
            rule.append(best[1])
            left = [r for r in left if holds(r, best[1])]
        check = lambda cs: right(*counts([r for r in prune if all(holds(r, c) for c in cs)]))
        while len(rule) > 1 and (b := max(((check([x for x in rule if x != c]), c) for c in rule), key=lambda x: x[0]))[0] >= check(rule):
            rule.remove(b[1])
        covered = [r for r in grow if all(holds(r, c) for c in rule)]
        bad, fine = counts(covered)
        if not rule or bad < least or right(bad, fine) < precision:
            break
        out.append([(n, float(CUTS[n][i - 1]), up) for n, i, up in rule])
        grow = [r for r in grow if not all(holds(r, c) for c in rule)]
        prune = [r for r in prune if not all(holds(r, c) for c in rule)]
    return out


def verdict(rules: list[list[Condition]]) -> Column:
    """The number of the first rule that fires (from 1), else 0."""
    own, out = features(), None
    for i, rule in enumerate(rules, 1):
        fires = F.lit(True)
        for name, cut, up in rule:
            fires = fires & ((own[name] >= cut) if up else (own[name] < cut))
        out = F.when(fires, i) if out is None else out.when(fires, i)
    return F.lit(0) if out is None else out.otherwise(0)


def apply_rules(docs: DataFrame, labels: DataFrame, sample: int = 20_000, doc_id: str = "doc_id",
                text: str = "text", label: str = "quality") -> DataFrame:
    """Statistics of every row of ``docs`` with base_failed, rule (the learned rule
    that fires, 0: none) and kept.

    ``labels`` (1 good, 0 bad; null labels and ids are left out, the worst of
    repeated ones counts) need not cover all documents; at most ``sample`` are read.
    Null and empty texts have no words and fail the base test; rows that repeat
    get equal results; other columns are not read; without labels no rule is
    learned and kept is the base test's; an empty table gives an empty result."""
    stats = statistics(docs, doc_id, text)
    wanted = F.broadcast(_sampled(labels, sample, doc_id, label))
    rules = learn(cells(statistics(docs.join(wanted, F.col(doc_id).cast("long") == wanted["__id"], "left_semi"), doc_id, text),
                        labels, sample, doc_id, label))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (stats.withColumn("base_failed", failed).withColumn("rule", verdict(rules))
            .withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0)))


def _sampled(labels: DataFrame, sample: int, doc_id: str, label: str) -> DataFrame:
    """The sampled ids: at most ``sample`` rows, so they may be broadcast."""
    return (labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
            .select(F.col(doc_id).cast("long").alias("__id")).distinct()
            .orderBy(F.xxhash64("__id"), "__id").limit(sample))
