"""The exactly defined columns of the license scan and the quality rules, by brute force."""

import random
import re

import pytest
from cohortlake.llm import licenses, rules

BASE = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}
SCHEMA = "doc_id long, text string, label string, words int"


def texts():
    r = random.Random(8)
    parts = ["MIT License", "the mit", "license", "Apache  License,", "APACHE", "GNU General Public License", "general public", "é", "a-b", "x1", "#", "*%",
             "\n", "same line\n", "same line\n", "word word word"]
    out = [" ".join(r.choice(parts) for _ in range(r.randrange(0, 60))) for _ in range(120)]
    return [*out, *out[:5], None, "", " \n\t", "mit license mit license", "Mit License", "mitlicense", "general public license " * 40, "w " * 60, "a b c " * 30]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(texts())] + [(3, "mit license", "x", 1), (None, "apache license", "x", 1)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def licence_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found = [(i, label) for label, phrase in BASE.items() for i in range(len(words))
             if words[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in found]
    return len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))


def test_license_base(docs):
    rows, df = docs
    got = sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])
                  for r in licenses.scan(df).collect()), key=repr)
    assert got == sorted(((i, *licence_base(t)) for i, t, *_ in rows), key=repr)


def quality_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    many = {w for w in windows if windows.count(w) > 1}
    hit = {j for i, w in enumerate(windows) if w in many for j in range(i, i + 3)}
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), failed


def test_quality_base(spark, docs):
    rows, df = docs
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = rules.apply_rules(df, labels).collect()
    assert sorted(((r["doc_id"], *[r[n] for n in names]) for r in got), key=repr) == sorted(((i, *quality_base(t)) for i, t, *_ in rows), key=repr)
    assert not [r for r in got if r["base_failed"] and r["kept"]]
