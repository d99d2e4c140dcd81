"""Record trees from nested elements and from linked offsets against recursion."""

import random

import pytest

from cohortlake.operators import elements, records

TYPES = ["PATIENT", "STUDY", "SERIES", "IMAGE"]


def grow(r, level=0):
    """A tree as nested lists of (type, children)."""
    return [(r.choice(TYPES[min(level, 2):]), grow(r, level + 1) if level < 3 and r.random() < 0.7 else [])
            for _ in range(r.randrange(1, 9))]


def told(tree, level=0):
    """The listing, by recursion."""
    out, images = [], 0
    for kind, below in tree:
        if kind == "IMAGE":
            images += 1
            if images < 5:
                out.append("  " * level + "|-IMAGE")
            elif images == 5:
                out += ["  " * level + "|-(...)", "  " * level + "Ignoring the remaining images..."]
        else:
            out.append("  " * level + "|-" + kind)
            out += told(below, level + 1)
    return out


def as_elements(tree, path, at=(1,)):
    rows = [(path, list(at), "(0004,1220)", None)]
    for i, (kind, below) in enumerate(tree):
        item = [*at, i]
        rows.append((path, [*item, 0], "(0004,1430)", kind))
        if kind == "IMAGE":
            rows.append((path, [*item, 3], "(0004,1500)", f"D\\I{i}"))
        if below:
            rows += as_elements(below, path, (*item, 7))
        rows += [(path, [*item, 9], "(0088,0200)", None), (path, [*item, 9, 0, 1], "(0004,1430)", "DECOY"),
                 (path, [*item, 9, 0, 2], "(0004,1220)", None), (path, [*item, 9, 0, 2, 0, 0], "(0004,1430)", "DECOY")]
    return rows


def as_offsets(tree, path, r):
    rows, used = [], set()

    def fresh():
        while (x := r.randrange(1, 10 ** 6)) in used:
            pass
        used.add(x)
        return x

    def lay(level):
        own = [fresh() for _ in level]
        for i, (kind, below) in enumerate(level):
            first = lay(below) if below else 0
            rows.append((path, own[i], own[i + 1] if i + 1 < len(own) else 0, first, kind, None))
        return own[0]

    lay(tree)
    r.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def trees():
    r = random.Random(4)
    return {f"f{i}": grow(r) for i in range(12)} | {"long": [("IMAGE", [])] * 70 + [("PATIENT", [("STUDY", [("IMAGE", [("SERIES", [])])])])]}


def listing(df):
    out = {}
    for r in elements.tree_listing(df).orderBy("dicomdir_path", "sort_key", "line").collect():
        out.setdefault(r["dicomdir_path"], []).append(r["text"])
    return out


def test_nested_records(spark, trees):
    rows = [x for p, t in trees.items() for x in as_elements(t, p)]
    df = spark.createDataFrame(rows, "file_path string, elem_pos array<int>, tag string, value string")
    got = records.records_from_elements(df)
    assert listing(got) == {p: told(t) for p, t in trees.items()}
    assert all(r["referenced_file_id"] == ["D", f"I{r['pos'] - 1}"]
               for r in got.filter("record_type = 'IMAGE'").collect())
    assert records.records_from_elements(df.limit(0)).count() == 0


OFFSETS = ("dicomdir_path string, offset long, next_offset long, lower_offset long, record_type string, "
           "referenced_file_id array<string>")


def test_linked_records(spark, trees):
    r = random.Random(9)
    rows = [x for p, t in trees.items() for x in as_offsets(t, p, r)]
    got = records.records_from_offsets(spark.createDataFrame(rows, OFFSETS))
    assert listing(got) == {p: told(t) for p, t in trees.items()}
    assert records.records_from_offsets(spark.createDataFrame([], OFFSETS)).count() == 0


def test_circles_and_double_links(spark):
    rows = [("a", 1, 2, 0, "PATIENT", None), ("a", 2, 0, 9, "PATIENT", None),        # 9 does not exist
            ("a", 5, 6, 0, "LOOP", None), ("a", 6, 5, 0, "LOOP", None),               # siblings in a circle
            ("a", 7, 0, 8, "UP", None), ("a", 8, 0, 7, "UP", None),                   # each the other's parent
            ("b", None, 1, 0, "NONE", None), ("b", 1, 3, 0, "X", None), ("b", 1, 3, 0, "X", None), ("b", 2, 3, 0, "Y", None), ("b", 3, None, None, "Z", None)]
    got = records.records_from_offsets(spark.createDataFrame(rows, OFFSETS))
    assert sorted((r["dicomdir_path"], r["parent_pos"], r["pos"], r["record_type"]) for r in got.collect()) == [
        ("a", [], 1, "PATIENT"), ("a", [], 2, "PATIENT"), ("b", [], 1, "X"), ("b", [], 1, "Y"), ("b", [], 2, "Z")]


def test_index_lines_are_numbered_in_one_pass(spark, tmp_dir):
    """Orders and lines are read once each, and numbered from 0 in key order."""
    from cohortlake.sources import demo
    spark.createDataFrame([(7, 1), (3, 1), (5, 1), (4, 2), (9, None)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_dir}/orders.parquet")
    spark.createDataFrame([(7, 2), (7, 1), (4, 3), (9, 1), (9, 5)], "l_orderkey long, l_linenumber int").write.parquet(f"{tmp_dir}/lineitem.parquet")
    lines = demo._index_lines(spark, tmp_dir)
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2
    got = {(r["o_orderkey"], r["study"], r["l_linenumber"], r["image"]) for r in lines.collect()}
    assert got == {(3, 0, None, None), (5, 1, None, None), (7, 2, 1, 0), (7, 2, 2, 1), (4, 0, 3, 0), (9, 0, 1, 0), (9, 0, 5, 1)}


def odd_links(r, files=6, n=60):
    """Rows with links to anywhere: circles, double and missing links, repeated and null offsets."""
    def some():
        return r.choice([None, 0, r.randrange(1, n), r.randrange(1, n), r.randrange(1, n)])

    return [(f"f{r.randrange(files)}" if r.random() < 0.98 else None, some(), some(), some() if r.random() < 0.4 else 0, r.choice(TYPES), None)
            for _ in range(files * n)]


@pytest.mark.parametrize("most", [0, 45, 200_000])
def test_files_linked_in_a_task_and_by_joins_are_alike(spark, trees, monkeypatch, most):
    """Files in tasks, files by joins, and some of both: the rows of the joins alone."""
    r = random.Random(11)
    rows = [x for p, t in trees.items() for x in as_offsets(t, p, r)] + odd_links(r)
    flat = spark.createDataFrame(rows, OFFSETS)
    show = lambda df: sorted((x["dicomdir_path"], x["parent_pos"], x["pos"], x["record_type"]) for x in df.collect())
    ways, real = [], records._linked_by_joins
    monkeypatch.setattr(records, "_linked_by_joins", lambda rec: (ways.append(rec.select("dicomdir_path").distinct().count()), real(rec))[1])
    monkeypatch.setattr(records, "FILE_RECORDS", 0)
    want = show(records.records_from_offsets(flat))
    monkeypatch.setattr(records, "FILE_RECORDS", most)
    assert show(records.records_from_offsets(flat)) == want and len(want) > 100
    all_files = ways.pop(0)
    assert ways == ([] if most == 200_000 else ways) and (not ways or (ways[0] == all_files) == (most == 0))


def test_whole_files_of_many_batches(trees, monkeypatch):
    """Files are linked whole however the rows are batched, and long paths in pieces."""
    import pyarrow as pa
    r = random.Random(5)
    schema = pa.schema([("dicomdir_path", pa.string()), ("id", pa.int64()), ("next", pa.int64()), ("lower", pa.int64()),
                        ("record_type", pa.string()), ("referenced_file_id", pa.list_(pa.string()))])
    rows = sorted((p, i, n or None, b or None, k, None) for p, t in trees.items() for p, i, n, b, k, _ in as_offsets(t, p, r))
    rows += [("z", i, None, i + 1 if i < 50 else None, "SERIES", ["A", "B"]) for i in range(1, 51)]       # one below the other
    table = pa.Table.from_pylist([dict(zip(schema.names, x)) for x in rows], schema=schema)
    whole = [x for b in records._link_files(iter(table.to_batches())) for x in b.to_pylist()]
    assert len(whole) == len(rows) and whole[-1]["parent_pos"] == [1] * 49 and whole[-1]["referenced_file_id"] == ["A", "B"]
    monkeypatch.setattr(records, "FILE_RECORDS", 40)
    monkeypatch.setattr(records, "PATH_NUMBERS", 30)
    for size in (1, 7, 41):
        got = [x for b in records._link_files(iter(table.to_batches(max_chunksize=size))) for x in b.to_pylist()]
        assert got == whole


def test_linking_leaves_only_the_records(spark, trees, monkeypatch):
    """What is written on the way is removed: neither the rows nor a round of pointers stay on disk."""
    import os
    made, real = [], records.shared_dir
    monkeypatch.setattr(records, "shared_dir", lambda *a: (made.append(real(*a)), made[-1])[1])
    monkeypatch.setattr("cohortlake.session.shared_dir", lambda *a: (made.append(real(*a)), made[-1])[1])
    r = random.Random(2)
    flat = spark.createDataFrame([x for p, t in trees.items() for x in as_offsets(t, p, r)], OFFSETS)
    for most, kept in ((200_000, ["large-files", "records"]), (0, ["large-files", "linked-records", "record-paths", "records", "siblings"])):
        made.clear()
        monkeypatch.setattr(records, "FILE_RECORDS", most)
        assert records.records_from_offsets(flat).count() > 100
        assert sorted(os.path.basename(p).rpartition("-")[0] for p in made if os.path.exists(p)) == kept


def test_offsets_of_lines_in_one_pass(spark, tmp_dir):
    """Orders and lines are read once each; repeated and null keys give the records they gave."""
    from cohortlake.sources import demo
    spark.createDataFrame([(7, 1), (3, 1), (5, 1), (5, 1), (4, 2), (9, None), (None, 1)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_dir}/orders.parquet")
    spark.createDataFrame([(7, 2), (7, 1), (5, 3), (9, 1), (9, 5), (None, 1)], "l_orderkey long, l_linenumber int").write.parquet(f"{tmp_dir}/lineitem.parquet")
    flat = demo.index_offsets(spark, tmp_dir)
    assert flat._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2
    s = lambda i: i * 4096 + 2
    got = sorted(((p or "", o, n, w, k) for p, o, n, w, k, _ in flat.collect()), key=lambda x: x[:2])
    assert got == [("", 1, None, 2, "PATIENT"), ("index/1", 1, None, 2, "PATIENT"), ("index/1", s(0), s(1), None, "STUDY"),
                   ("index/1", s(1), s(2), None, "STUDY"), ("index/1", s(2), s(3), s(2) + 1, "STUDY"), ("index/1", s(2) + 1, None, None, "IMAGE"),
                   ("index/1", s(3), s(4), s(3) + 1, "STUDY"), ("index/1", s(3) + 1, None, None, "IMAGE"),
                   ("index/1", s(4), None, s(4) + 1, "STUDY"), ("index/1", s(4) + 1, s(4) + 2, None, "IMAGE"),
                   ("index/1", s(4) + 2, None, None, "PRESENTATION"), ("index/2", 1, None, 2, "PATIENT"), ("index/2", s(0), None, None, "STUDY")]
