"""The Jaccard join against brute force: families of near copies, exact copies,
short, blank, null and very long texts, and clashing column names."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from cohortlake.llm import arrays, jaccard

SCHEMA = "doc_id long, text string, n int, a string, key int, leader int"


def tokens(text, gram=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(w) < gram:
        return frozenset([" ".join(w)] if w else [])
    return frozenset(" ".join(w[i:i + gram]) for i in range(len(w) - gram + 1))


def by_force(rows, percent=90):
    sets = [tokens(t) for _, t in rows]
    lead = list(range(len(rows)))

    def top(i):
        while lead[i] != i:
            i = lead[i]
        return i

    for i, s in enumerate(sets):
        for j in range(i):
            if s and sets[j] and 100 * len(s & sets[j]) >= percent * len(s | sets[j]):
                lead[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return sorted(((d, len(s), least.get(top(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(11)
    words = [f"w{i}" for i in range(60)] + ["é", "ß", "The", "the"]
    prose = lambda n: [r.choice(words) for _ in range(n)]
    out, passage = [], prose(60)
    for f in range(12):
        base = prose(r.choice([11, 14, 30, 80, 200]))
        for _ in range(r.choice([1, 2, 5, 40])):
            t = list(base)
            for _ in range(r.randrange(3)):
                t[r.randrange(len(t))] = r.choice(words)
            out.append(" ".join(t + prose(r.randrange(3))))
    drift = prose(150)                              # a chain: neighbours are similar, its ends are not
    for i in range(30):
        drift = drift[2:] + prose(2)
        out.append(" ".join(drift))
    out += [" ".join(passage + prose(n)) for n in (5, 5, 6, 40, 60)]
    out += [" ".join(prose(n)) for n in (0, 1, 2, 3, 4, 9, 10, 11) for _ in range(3)]
    out += ["one two", "ONE\ttwo", "one two three", "a a a a a a", "a a a", "A A", None, "", " \n ", "\x0b"]
    out += out[:20]
    ids = list(range(len(out)))
    r.shuffle(ids)
    return [*zip(ids, out), (None, out[0]), (None, "alone in the wide world"), (3, out[5]), (-4, out[9])]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA)


def result(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("group,slots,visitors,common", [(128, 1 << 18, 4096, 4), (3, 4, 2, 1), (1, 1 << 18, 4096, 20), (5, 64, 9, 2)])
def test_against_brute_force(spark, rows, group, slots, visitors, common):
    got = jaccard.similar_components(frame(spark, rows), group=group, slots=slots, visitors=visitors, common=common)
    assert result(got) == by_force(rows)


@pytest.mark.parametrize("percent", [40, 75, 99, 100])
def test_other_similarities(spark, rows, percent):
    some = rows[::2]
    assert result(jaccard.similar_components(frame(spark, some), percent=percent)) == by_force(some, percent)


def test_long_texts(spark):
    """Texts of more symbols than a chunk of the helpers, and than a group's tokens."""
    r = random.Random(2)
    long = [str(r.randrange(10 ** 6)) for _ in range(300_000)]
    near = [w if i % 100 else "x" for i, w in enumerate(long)]
    assert len(" ".join(long)) > arrays.CHUNK and len(long) > jaccard.GROUP_TOKENS
    rows = [(7, " ".join(long)), (5, " ".join(near)), (9, " ".join(long[:200_000])), (4, "short text of five words")]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar_components(frame(spark, rows)).collect()}
    assert got == {i: (len(tokens(t)), {7: 5, 5: 5}.get(i, i)) for i, t in rows}


def test_no_rows(spark):
    assert result(jaccard.similar_components(frame(spark, []))) == []


def test_tokens_of_a_batch_are_those_of_each_text():
    texts = ["a b c a b c", None, "", "x y", "x y z", "A b C", "z"]
    values, at = jaccard.token_sets(pa.array(texts), 3)
    assert np.diff(at).tolist() == [len(tokens(t)) for t in texts]
    for i, t in enumerate(texts):
        one, _ = jaccard.token_sets(pa.array([t], pa.string()), 3)
        assert values[at[i]:at[i + 1]].tolist() == one.tolist()
