"""Quality classifier with hierarchical empirical Bayes.

A document's evidence is a naive Bayes log odds over its distinct words and
binned statistics, learned from a bounded sample of labelled documents; one for
low quality and one for toxicity.  Most words only vary around the class rate;
how many tell more, and whether a word is one of those, follows from the counts
of all words, so no least count is asked of a word.  Hosts and paths (a host's sections) get a
posterior rate of bad documents from the evidence of all their documents,
through grouped aggregation: a path's rate shrinks toward its host's, a host's
toward the global rate, the more so the fewer documents there are.  How much is
estimated from the spread between sites.  A document is judged by its own
evidence with its path's rate as the prior.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.llm import arrays as A
from cohortlake.llm.common import ready, stored

#: Words are hashed to so many features.  A word that tells nothing varies around
#: the class rate like a beta distribution of strength SPREAD (copies make rates of
#: rare words differ more than chance does); one that tells something has any rate
#: (Jeffreys prior).  A feature counts BOUND at most.
DIMENSION, SPREAD, JEFFREYS, BOUND = 1 << 20, 8.0, 0.5, 6.0
MARKS = np.zeros(256, bool)
MARKS[[ord(c) for c in "#*$%&|<>!"]] = True
CAPITAL = np.zeros(256, bool)
CAPITAL[0x41:0x5B] = True
LETTER = A.ALNUM.copy()
LETTER[0x30:0x3A] = False


def _share(sums: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return (sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(np.diff(offsets), 1)


def features(column):
    """(first row, offsets, features): the distinct features of each document."""
    data, offsets = A.text_bytes(column)
    for i, j in A.chunks(offsets):
        raw, at = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        lower = A.LOWER[raw]
        starts, ends, words = A.word_spans(lower, at, LETTER)
        h = A.span_hash(A.prefix_sums(A.BYTE_VALUE[lower]), starts, ends) % np.uint64(DIMENSION - 4096)
        doc = np.repeat(np.arange(j - i), np.diff(words))
        pair = np.unique(doc.astype(np.uint64) << np.uint64(32) | h)
        doc, h = (pair >> np.uint64(32)).astype(np.int64), (pair & np.uint64(0xFFFFFFFF)).astype(np.int64)
        count = lambda mask: np.append(0, np.cumsum(mask[raw], dtype=np.int64))
        distinct = np.bincount(doc, minlength=j - i) / np.maximum(np.diff(words), 1)
        stats = [_share(count(MARKS), at), _share(count(CAPITAL), at), distinct, np.diff(words) / 1e4]
        cuts = [(.002, .005, .01, .02, .05, .1), (.02, .05, .1, .2, .4), (.1, .2, .3, .4, .6, .8), (.001, .003, .005, .01, .05)]
        extra = np.stack([DIMENSION - 4096 + 64 * k + np.searchsorted(c, s) for k, (s, c) in enumerate(zip(stats, cuts))], 1)
        doc = np.concatenate([doc, np.repeat(np.arange(j - i), extra.shape[1])])
        h = np.concatenate([h, extra.ravel()])
        order = np.argsort(doc, kind="stable")
        yield i, np.searchsorted(doc[order], np.arange(j - i + 1)), h[order]


def _log_beta(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.array([math.lgamma(x) + math.lgamma(y) - math.lgamma(x + y) for x, y in zip(a.tolist(), b.tolist())])


def _digamma(x: np.ndarray) -> np.ndarray:
    low = sum(1 / (x + k) for k in range(6))
    x = x + 6
    return np.log(x) - 1 / (2 * x) - 1 / (12 * x ** 2) + 1 / (120 * x ** 4) - low


def shrunk_odds(bad: np.ndarray, fine: np.ndarray, all_bad: int, all_fine: int) -> np.ndarray:
    """Each feature's log odds over those of the class, from its numbers of bad and
    fine documents: the mean under the Jeffreys prior, times the probability
    that the feature tells something.  The share of features that do is found by
    expectation maximization over all of them."""
    pair, of, n = np.unique(np.stack([bad, fine]), axis=1, return_inverse=True, return_counts=True)
    b, f, of = pair[0].astype(float), pair[1].astype(float), of.ravel()
    rate = (all_bad + .5) / (all_bad + all_fine + 1)
    u, v = np.full(len(b), SPREAD * rate), np.full(len(b), SPREAD * (1 - rate))
    j = np.full(len(b), JEFFREYS)
    nothing = _log_beta(u + b, v + f) - _log_beta(u, v)
    something = _log_beta(j + b, j + f) - _log_beta(j, j)
    ratio, share = np.exp(np.clip(nothing - something, -500, 500)), 1e-3
    for _ in range(60):
        chance = 1 / (1 + ratio * (1 - share) / share)
        share = min(max(float((chance * n).sum()) / max(len(of), 1), 1e-6), .5)
    odds = chance * (_digamma(j + b) - _digamma(j + f) - math.log(rate / (1 - rate)))
    return np.clip(odds, -BOUND, BOUND)[of]


def train(docs: DataFrame, labels: DataFrame, sample: int, doc_id: str, text: str, targets: dict[str, Column]):
    """Weights (target, feature) and prior log odds of each target, from the
    ``sample`` labelled documents of least hash."""
    known = (labels.where(F.col(doc_id).isNotNull())
             .groupBy(F.col(doc_id).cast("long").alias("id")).agg(*[F.max(c.cast("int")).alias(n) for n, c in targets.items()])
             .orderBy(F.xxhash64("id"), "id").limit(sample))
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text")).join(F.broadcast(known), "id")

    def emit(batches):
        for batch in batches:
            for i, at, h in features(batch.column(0)):
                doc = np.repeat(np.arange(len(at) - 1), np.diff(at)) + i
                values, place = np.unique(h, return_inverse=True)
                out = [pa.array(values)]
                for c in batch.columns[1:]:
                    is_bad = c.fill_null(-1).to_numpy(zero_copy_only=False)[doc]
                    out += [pa.array(np.bincount(place, is_bad == x, len(values)).astype(np.int64)) for x in (1, 0)]
                # the number of documents stands under feature -1
                ends = [pa.array([-1])] + [pa.array([int((c.fill_null(-1).to_numpy(zero_copy_only=False)[i:i + len(at) - 1] == x).sum())])
                                           for c in batch.columns[1:] for x in (1, 0)]
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([a, b]) for a, b in zip(out, ends)], names)

    names = ["feature", *[f"{n}_{x}" for n in targets for x in ("bad", "fine")]]
    counts = (rows.select("text", *targets).mapInArrow(emit, ", ".join(f"{n} long" for n in names))
              .groupBy("feature").agg(*[F.sum(n).alias(n) for n in names[1:]])
              .toArrow())  # at most DIMENSION + 1 rows
    feature = counts.column("feature").to_numpy()
    weights, priors = np.zeros((len(targets), DIMENSION), np.float32), []
    for k, n in enumerate(targets):
        bad, fine = counts.column(f"{n}_bad").to_numpy(), counts.column(f"{n}_fine").to_numpy()
        at = np.flatnonzero(feature == -1)
        all_bad, all_fine = (int(bad[at].sum()), int(fine[at].sum()))
        seen = (feature >= 0) & (bad + fine > 1)  # one document tells nothing
        weights[k, feature[seen]] = shrunk_odds(bad[seen], fine[seen], all_bad, all_fine)
        # one document in a hundred is taken to be bad before any label is seen
        priors.append(math.log((all_bad + .01) / (all_fine + .99)))
    return weights, priors


def evidence(docs: DataFrame, weights: np.ndarray, names: list[str], text: str, keep: dict[str, Column]) -> DataFrame:
    """The kept columns and the log odds of every row for each target."""
    def run(batches):
        for batch in batches:
            out = np.zeros((len(names), batch.num_rows))
            for i, at, h in features(batch.column(0)):
                for k in range(len(names)):
                    total = np.append(0, np.cumsum(weights[k, h], dtype=np.float64))
                    out[k, i:i + len(at) - 1] = np.round(total[at[1:]] - total[at[:-1]], 4)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *map(pa.array, out)], columns)

    columns = [*keep, *names]
    rows = docs.select(F.col(text).cast("string").alias("text"), *[c.alias(n) for n, c in keep.items()])
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:]] + [f"`{n}` double" for n in names])
    return rows.mapInArrow(run, schema)


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _strength(sites: DataFrame, name: str, mean: float) -> float:
    """How many documents' worth of trust the level above has: the beta-binomial
    method of moments over site rates (2 to 10,000)."""
    n, spread, within = sites.agg(
        F.count_if(F.col("n") > 1), F.avg(F.when(F.col("n") > 1, F.pow(F.col(name) / F.col("n") - mean, 2))),
        F.avg(F.when(F.col("n") > 1, 1 / F.col("n")))).first()
    if not n:
        return 50.0
    top = mean * (1 - mean)
    excess = (spread - top * within) / max(top * (1 - within), 1e-9)
    return float(min(max(1 / max(excess, 1e-9) - 1, 2.0), 10_000.0))


def classify(docs: DataFrame, labels: DataFrame, sample: int = 20_000, threshold: float = 0.5, doc_id: str = "doc_id",
             text: str = "text", host: Column | None = None, path: Column | None = None) -> DataFrame:
    """(doc_id, copy, host, path, low_quality, toxic, path_low_quality, path_toxic, kept)
    for every row of ``docs``: posterior probabilities, and whether both are below
    ``threshold``.  path_* are the rates of the document's path and host as the other
    documents there make them.

    ``labels``: (doc_id, quality, toxic), 1 or 0 (null: not known); the worst of
    repeated ones counts; at most ``sample`` documents are read for training, all
    for everything else.  Host and path default to ``source`` and source with
    ``lang``; a null host or path is a site of its own.  copy is a hash of the
    text.  Null and empty texts have only their statistics as evidence; rows that
    repeat get equal results; other columns are not read; without labels nothing
    is rejected; an empty table gives an empty result."""
    ready(docs.sparkSession)
    column = lambda name: F.col(name).cast("string") if name in docs.columns else F.lit(None).cast("string")
    host = column("source") if host is None else host
    path = F.concat_ws("/", F.coalesce(column("source"), F.lit("?")), F.coalesce(column("lang"), F.lit("?"))) if path is None else path
    names = ["low_quality", "toxic"]
    weights, priors = train(docs, labels, sample, doc_id, text, {"low_quality": F.col("quality") == 0, "toxic": F.col("toxic") == 1})
    rows = stored(evidence(docs, weights, names, text, {
        "doc_id": F.col(doc_id).cast("long"), "copy": F.xxhash64(F.col(text).cast("string")),
        "host": F.coalesce(host, F.lit("")), "path": F.coalesce(path, F.lit(""))}), "evidence")
    chance = {n: _sigmoid(F.col(n) + F.lit(p)) for n, p in zip(names, priors)}
    paths = stored(rows.groupBy("host", "path").agg(F.count("*").alias("n"), *[F.sum(chance[n]).alias(n) for n in names]), "paths")
    hosts = stored(paths.groupBy("host").agg(F.sum("n").alias("n"), *[F.sum(n).alias(n) for n in names]), "hosts")
    total = hosts.agg(F.sum("n"), *[F.sum(n) for n in names]).first()
    site = paths.join(hosts.select("host", F.col("n").alias("host_n"), *[F.col(n).alias(f"host_{n}") for n in names]), "host")
    out = rows.join(site.select("host", "path", "n", "host_n", *[F.col(n).alias(f"path_{n}") for n in names], *[f"host_{n}" for n in names]),
                    ["host", "path"])
    for k, n in enumerate(names):
        mean = min(max((total[k + 1] or 0) / max(total[0] or 0, 1), 1e-4), 1 - 1e-4)
        by_host, by_path = _strength(hosts, n, mean), _strength(paths, n, mean)
        # what the others of the site say: a document's own evidence counts once
        others = lambda c: F.greatest(F.col(c) - chance[n], F.lit(0.0))  # noqa: B023, E731
        above = (others(f"host_{n}") + by_host * mean) / (F.col("host_n") - 1 + by_host)
        out = out.withColumn(f"path_{n}", (others(f"path_{n}") + by_path * above) / (F.col("n") - 1 + by_path))
    for n in names:
        out = out.withColumn(n, _sigmoid(F.col(n) + _logit(F.greatest(F.least(F.col(f"path_{n}"), F.lit(1 - 1e-6)), F.lit(1e-6)))))
    kept = (F.col("low_quality") < threshold) & (F.col("toxic") < threshold)
    return out.select("doc_id", "copy", "host", "path", *names, *[f"path_{n}" for n in names], kept.alias("kept"))
