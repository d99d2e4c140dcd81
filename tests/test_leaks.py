"""Identifying values in free text against a search of every text for every value."""

import random
import re

import pytest

from cohortlake.operators import leaks

SCHEMA = "file_path string, elem_pos array<int>, depth int, tag string, vr string, keyword string, value string"


def rows():
    r = random.Random(6)
    names = [f"{r.choice(['Doe', 'Roe', 'Müller', 'O.Neil+'])}^{r.choice(['Jane', 'John', 'Zoë'])}{i}" for i in range(40)]
    out = []
    for i, name in enumerate(names):
        f = f"f{i}"
        out += [(f, [0], 0, "(0010,0010)", "PN", "PatientName", name), (f, [1], 0, "(0010,0020)", "LO", "PatientID", str(1000 + 37 * i)),
                (f, [2], 0, "(0020,4000)", "LT", "ImageComments", r.choice(["fine", f"of {names[i].upper()}, {r.choice(names)}",
                                                                             f"id{1000 + 37 * i} id {1000 + 37 * r.randrange(40)}."])),
                (f, [3], 0, "(0009,1001)", "UN", None, r.choice([None, "", names[i].split("^")[1], f"x{names[i]}", "ab"])),
                (f, [4, 0, 0], 1, "(0010,0020)", "LO", "PatientID", str(1000 + 37 * i))]
    return out


def by_force(data, own_only=False):
    known = ("PatientName", "PatientID")
    wanted = set()
    for f, _, d, _, _, k, v in data:
        if d == 0 and k in known and v:
            wanted |= {(f, k, x) for x in [v.lower(), *re.split(r"[\^,\s]+", v.lower())] if len(x) >= 4}
    out = set()
    for f, pos, d, _, _, k, v in data:
        if v and not (d == 0 and k in known):
            for owner, key, x in wanted:
                if (owner == f or not own_only) and re.search(r"(?<![^\W_])" + re.escape(x) + r"(?![^\W_])", v.lower()):
                    out.add((f, tuple(pos), x, key, owner))
    return out


@pytest.mark.parametrize("own_only", [False, True])
def test_all_found(spark, own_only):
    data = rows()
    got = leaks.identifiers_in_text(spark.createDataFrame(data, SCHEMA), own_only=own_only, keywords=["PatientName", "PatientID"])
    want = by_force(data, own_only)
    assert len(want) > 30
    assert {(r["file_path"], tuple(r["elem_pos"]), r["found"], r["found_keyword"], r["owner"]) for r in got.collect()} == want


def test_given_values_and_no_rows(spark):
    df = spark.createDataFrame([("f", [0], 0, "t", "LT", "ImageComments", "a\\Eb (c*d) 77"), ("g", [0], 0, "t", "LT", None, None)], SCHEMA)
    values = spark.createDataFrame([("x", "k", "a\\Eb"), ("x", "k", "(c*d)"), ("x", "k", "none of it"), ("x", "k", "77")],
                                   "file_path string, keyword string, value string")
    got = leaks.identifiers_in_text(df, values)
    assert {(r["found"], r["owner"]) for r in got.collect()} == {("a\\eb", "x"), ("(c*d)", "x")}
    assert leaks.identifiers_in_text(df.limit(0)).count() == 0


def test_texts_are_not_kept_per_word(spark, monkeypatch):
    """Texts meet values by hashes; nothing is kept that has a text for each of its words."""
    text = " ".join(f"w{i}" for i in range(400)) + " Doe Jane"
    kept, real = [], leaks.materialize
    monkeypatch.setattr(leaks, "materialize", lambda df: (kept.append(df), real(df))[1])
    df = spark.createDataFrame([("f", [0], 0, "t", "PN", "PatientName", "Doe Jane"), ("f", [1], 0, "t", "LT", "ImageComments", text)], SCHEMA)
    got = leaks.identifiers_in_text(df, keywords=["PatientName"])
    assert {r["found"] for r in got.collect()} == {"doe jane", "jane"}
    assert all("_text" not in df.columns for df in kept)


def test_values_of_many_words_or_none(spark):
    long = " ".join(f"n{i}" for i in range(12))
    data = [("f", [0], 0, "t", "LT", None, f"of {long}, and {long}x"), ("g", [0], 0, "t", "LT", None, f"x{long}"),
            ("h", [0], 0, "t", "LT", None, "a *+*+*\n b"), ("i", [0], 0, "t", "LT", None, "a*+*+* b"), ("j", [0], 0, "t", "LT", None, "n0-n1")]
    values = spark.createDataFrame([("x", "k", v) for v in (long, "*+*+", "+*+*", "n0 n1")], "file_path string, keyword string, value string")
    got = leaks.identifiers_in_text(spark.createDataFrame(data, SCHEMA), values)
    want = {(f, v) for f, *_, t in data for v in (long, "*+*+", "+*+*", "n0 n1")
            if re.search(r"(?<![^\W_])" + re.escape(v) + r"(?![^\W_])", t)}
    assert {(r["file_path"], r["found"]) for r in got.collect()} == want and len(want) > 3
