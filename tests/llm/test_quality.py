"""Site rates against a computation by hand, each document's own evidence left out."""

import math

import pytest
from cohortlake.llm import quality

NAMES = ["low_quality", "toxic"]
PRIORS = [-1.0, -3.0]
SCHEMA = "doc_id long, copy long, host string, path string, low_quality double, toxic double"


def sigmoid(x):
    return 1 / (1 + math.exp(-x))


def sites():
    """(host, path, evidence): a lone document, a bad path, a good host."""
    out = [("lone", "lone/x", (0.5, 4.0)), ("mixed", "mixed/bad", (3.0, 2.0))]
    out += [("mixed", "mixed/bad", (3.0 + i / 10, 1.0)) for i in range(8)] + [("mixed", "mixed/good", (-3.0, -2.0))] * 9
    out += [("good", f"good/{i % 3}", (-4.0 + i / 20, -5.0)) for i in range(30)]
    return out


def by_hand(rows, k):
    chance = [sigmoid(e[k] + PRIORS[k]) for _, _, e in rows]
    mean = min(max(sum(chance) / len(rows), 1e-4), 1 - 1e-4)

    def strength(key):
        groups = {}
        for r, c in zip(rows, chance):
            groups.setdefault(key(r), []).append(c)
        some = [g for g in groups.values() if len(g) > 1]
        spread = sum((sum(g) / len(g) - mean) ** 2 for g in some) / len(some)
        within = sum(1 / len(g) for g in some) / len(some)
        top = mean * (1 - mean)
        excess = (spread - top * within) / max(top * (1 - within), 1e-9)
        return min(max(1 / max(excess, 1e-9) - 1, 2.0), 10_000.0)

    by_host, by_path = strength(lambda r: r[0]), strength(lambda r: r[:2])
    out = []
    for i, (host, path, e) in enumerate(rows):
        hosts = [c for j, (r, c) in enumerate(zip(rows, chance)) if r[0] == host and j != i]
        paths = [c for j, (r, c) in enumerate(zip(rows, chance)) if r[:2] == (host, path) and j != i]
        above = (sum(hosts) + by_host * mean) / (len(hosts) + by_host)
        rate = (sum(paths) + by_path * above) / (len(paths) + by_path)
        out.append((rate, sigmoid(e[k] + math.log(rate / (1 - rate)))))
    return out


@pytest.fixture()
def judged(spark, monkeypatch):
    rows = sites()
    table = spark.createDataFrame([(i, i, h, p, *e) for i, (h, p, e) in enumerate(rows)], SCHEMA)
    monkeypatch.setattr(quality, "train", lambda *a, **k: (None, PRIORS))
    monkeypatch.setattr(quality, "evidence", lambda *a, **k: table)
    docs = spark.createDataFrame([(1, "x", "s", "en")], "doc_id long, text string, source string, lang string")
    return rows, {r["doc_id"]: r for r in quality.classify(docs, docs).collect()}


def test_posteriors_by_hand(judged):
    rows, got = judged
    for k, name in enumerate(NAMES):
        for i, (rate, posterior) in enumerate(by_hand(rows, k)):
            assert got[i][f"path_{name}"] == pytest.approx(rate, abs=1e-9) and got[i][name] == pytest.approx(posterior, abs=1e-9)


def test_a_lone_document_is_judged_by_its_own_evidence_once(judged):
    """Its path says nothing beyond the mean, so the posterior is that of the mean."""
    rows, got = judged
    chance = [sigmoid(e[1] + PRIORS[1]) for _, _, e in rows]
    mean = sum(chance) / len(rows)
    assert got[0]["path_toxic"] == pytest.approx(mean, abs=1e-9)
    assert got[0]["toxic"] == pytest.approx(sigmoid(4.0 + math.log(mean / (1 - mean))), abs=1e-9)
