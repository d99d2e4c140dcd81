"""The executors' walk against ``os.walk``: empty folders, links, several rounds and roots."""

import os

import pytest
from pyspark.sql import functions as F

from cohortlake.sources import listing, walk


def build(root, n=60):
    for i in range(n):
        d = os.path.join(root, f"a{i % 4}", f"b{i % 7}", *(["deep"] * (i % 5)))
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, f"f{i}.dcm"), "wb") as f:
            f.write(b"x" * i)
    for e in ("empty", "a0/none/none", "a1/.hidden"):
        os.makedirs(os.path.join(root, e))
    open(os.path.join(root, "a1/.hidden/_x"), "w").close()
    open(os.path.join(root, "a b é.txt"), "w").close()
    return root


def by_os(root):
    out = set()
    for at, folders, files in os.walk(root):
        rel = os.path.relpath(at, root)
        join = lambda n: n if rel == "." else f"{rel}/{n}"
        out |= {(join(d), "dir", None) for d in folders}
        out |= {(join(f), "file", os.path.getsize(os.path.join(at, f))) for f in files}
    return out


def rows(df):
    return {(r["rel"], r["kind"], r["size"]) for r in df.collect()}


@pytest.mark.parametrize("share", [1, 3, 2000])
def test_same_entries_as_os_walk(spark, tmp_dir, share):
    build(tmp_dir)
    got = walk.tree_entries(spark, tmp_dir, folders_per_task=share)
    assert rows(got) == by_os(tmp_dir)
    assert got.count() == len(by_os(tmp_dir))
    assert {r["root"] for r in got.collect()} == {"file:" + tmp_dir}


def test_roots_of_all_kinds(spark, tmp_dir):
    root = build(os.path.join(tmp_dir, "t"), 5)
    one = os.path.join(root, "a b é.txt")
    gone = os.path.join(tmp_dir, "gone")
    got = walk.walk(spark, [root, one, gone, os.path.join(root, "empty")])
    kinds = {(r["path"], r["kind"]) for r in got.filter(F.col("kind") == "missing").collect()}
    assert kinds == {("file:" + gone, "missing")}
    assert got.filter((F.col("root") == "file:" + one) & (F.col("kind") == "file")).count() == 1
    files, missing = listing.list_roots(spark, [root, gone])
    assert missing == [gone] and files.count() == sum(k == "file" for _, k, _ in by_os(root))
    assert walk.walk(spark, []).count() == 0


def test_links_are_not_entered(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/real")
    open(f"{tmp_dir}/real/f", "w").close()
    os.symlink(tmp_dir, f"{tmp_dir}/real/up")               # would never end
    os.symlink(f"{tmp_dir}/real/f", f"{tmp_dir}/to_file")
    os.symlink(f"{tmp_dir}/nowhere", f"{tmp_dir}/broken")
    got = {(r["rel"], r["kind"]) for r in walk.tree_entries(spark, tmp_dir).collect()}
    assert got == {("real", "dir"), ("real/f", "file"), ("real/up", "dir"), ("to_file", "file"), ("broken", "other")}


def test_a_folder_that_cannot_be_listed_is_reported(spark, tmp_dir, monkeypatch):
    os.makedirs(f"{tmp_dir}/ok")
    import pyarrow as pa
    run = walk._lister(10)
    batch = pa.RecordBatch.from_pylist([{"path": f"file:{tmp_dir}/none", "kind": "todo", "root": "r"},
                                        {"path": f"file:{tmp_dir}", "kind": "todo", "root": "r"}])
    out = [r for b in run([batch]) for r in b.to_pylist()]
    assert [(r["kind"], r["error"] is not None) for r in out] == [("error", True), ("dir", False)]


def test_empty_session_folders_count(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/sub-01/ses-M000/anat")
    os.makedirs(f"{tmp_dir}/sub-02/ses-M000")
    open(f"{tmp_dir}/sub-02/ses-M000/notes.txt", "w").close()
    entries = walk.tree_entries(spark, tmp_dir)
    assert [tuple(r) for r in listing.session_folders(entries).collect()] == [("sub-01", "ses-M000", "anat")]
    assert sorted(r[0] for r in listing.top_level_folders(entries).collect()) == ["sub-01", "sub-02"]


def test_no_folder_waits_twice(spark, tmp_dir, monkeypatch):
    """Tasks grow with the folders to list: each is put off once at most."""
    for i in range(40):
        os.makedirs(f"{tmp_dir}/t/a{i}/b/c")
    seen, real = [], walk.shared_dir
    monkeypatch.setattr(walk, "shared_dir", lambda *a: (seen.append(real(*a)), seen[-1])[1])
    assert walk.walk(spark, f"{tmp_dir}/t", folders_per_task=1).count() == 120
    left = spark.read.parquet(seen[0]).where("kind = 'todo'")
    assert left.count() == left.select("path").distinct().count() == 120


def test_a_tree_in_portions(spark, tmp_dir, monkeypatch):
    """The same entries as those of the tree written at once; no more than a portion stands."""
    from cohortlake.sources import demo
    entries = spark.range(0, 600, 1, 2).selectExpr(
        "concat('p', id % 3, '/', id % 11, if(id % 4 = 0, concat('/S', id), concat('/f', id))) AS rel",
        "if(id % 4 = 0, 'dir', 'file') AS kind", "if(id % 4 = 0, null, id % 7) AS size")
    more = spark.createDataFrame([("top", "file", 3), ("p0/0/S0/in", "file", 1), ("p0/0/S0/in", "file", 1)], entries.schema)
    entries = entries.unionByName(more)
    whole = f"{tmp_dir}/whole"
    demo.write_tree(entries, whole)
    out, stood = f"{tmp_dir}/out", []

    def read():
        stood.append(sum(len(f) for _, _, f in os.walk(out)))
        return walk.tree_entries(spark, out)

    got = walk.each_folder_once(demo.tree_in_portions(entries, out, read, portion=100))
    assert rows(got) == by_os(whole) and got.count() == len(by_os(whole))
    assert len(stood) == 7 and max(stood) < 300 and not os.path.exists(out)


def test_queries_leave_no_tree(spark, tmp_dir, monkeypatch):
    """Disk stays bounded: what is written is removed once it has been read."""
    from cohortlake import queries
    from cohortlake.sources import demo
    made, real = [], demo.write_tree
    monkeypatch.setattr(demo, "write_tree", lambda e, out: (made.append((out, e.count())), real(e, out))[1])
    monkeypatch.setattr(demo, "PORTION", 50)
    (spark.range(300).selectExpr("id AS o_orderkey", "id % 20 AS o_custkey", "'F' AS o_orderstatus", "timestamp'2001-01-01' AS o_orderdate",
                                 "'5-LOW' AS o_orderpriority").write.parquet(f"{tmp_dir}/orders.parquet"))
    for name in ("tree_walk", "check_manifest_job", "bids_tree_get"):
        made.clear()
        assert queries.QUERIES[name](spark, tmp_dir).count() > 0
        assert len(made) > 1 and max(n for _, n in made) < 150
        assert not any(os.path.exists(out) for out, _ in made)


def test_portions_are_made_of_those_before(spark, tmp_dir, monkeypatch):
    """A removed tree's files and folders make up the next one; contents are those of the new
    entries, and nothing is left at the end."""
    from cohortlake.sources import demo
    schema = "rel string, kind string, content string"
    first = spark.createDataFrame([(f"a{i % 2}/b{i % 5}/f{i}", "file", "old and long " * (i % 3)) for i in range(60)]
                                  + [(f"a0/b{i}/empty", "dir", None) for i in range(5)], schema)
    then = spark.createDataFrame([(f"a1/c{i % 3}/g{i}", "file", f"new {i}" * (i % 2)) for i in range(50)]
                                 + [("a1/c0/none", "dir", None)], schema)
    out, pool = f"{tmp_dir}/t", f"{tmp_dir}/t.pool"
    inode = lambda top: {os.stat(os.path.join(at, x)).st_ino for at, _, files in os.walk(top) for x in files}
    demo.write_tree(first, out)
    before = inode(out)
    demo.remove_tree(first, out, keep=True)
    assert not os.path.exists(out) and inode(pool) == before
    demo.write_tree(then, out)
    # a task that finds all lots taken makes its files anew
    assert inode(out) & before and len(inode(out)) == 50 and inode(f"{pool}/file") == before - inode(out)
    got = {os.path.relpath(os.path.join(at, x), out): open(os.path.join(at, x)).read() for at, _, files in os.walk(out) for x in files}
    assert got == {r["rel"]: r["content"] for r in then.where("kind = 'file'").collect()}
    assert os.listdir(f"{out}/a1/c0/none") == [] and sorted(os.listdir(f"{out}/a1")) == ["c0", "c1", "c2"]
    demo.remove_tree(then, out)
    assert not os.path.exists(out) and not os.path.exists(pool)


def test_a_pool_gives_no_file_twice(tmp_dir):
    """A file that a lost task had linked but not unlinked is not written as two; folders are shared by tasks."""
    from cohortlake.sources import demo
    pool, out = f"{tmp_dir}/pool", f"{tmp_dir}/out"
    os.makedirs(f"{tmp_dir}/old/d")
    for n in "ab":
        with open(f"{tmp_dir}/old/d/{n}", "w") as f:
            f.write(n * 9)
    os.link(f"{tmp_dir}/old/d/a", f"{tmp_dir}/old/d/again")
    p = demo._Pool(pool)
    p.put_tree(f"{tmp_dir}/old")
    one, two = demo._Pool(pool), demo._Pool(pool)
    for task, n in ((one, "x"), (two, "y"), (one, "z"), (one, "x")):
        task.folder(f"{out}/s")
        task.file(f"{out}/s/{n}", n.encode())
    for task in (one, two):
        task.close()
    assert {n: open(f"{out}/s/{n}").read() for n in os.listdir(f"{out}/s")} == {"x": "x", "y": "y", "z": "z"}
    assert len({os.stat(f"{out}/s/{n}").st_ino for n in "xyz"}) == 3


@pytest.mark.parametrize("name", ["check_manifest_job", "tree_walk", "bids_tree_get"])
def test_queries_keep_a_portion_for_the_next(spark, tmp_dir, monkeypatch, name):
    """Every portion but the first is made of the one before, as far as that goes."""
    from cohortlake import queries
    from cohortlake.sources import demo
    count = lambda top: sum(len(files) for _, _, files in os.walk(top))
    kept, stood, real = [], [], demo.write_tree

    def write(entries, out):
        kept.append(count(f"{out}.pool"))
        real(entries, out)
        stood.append(count(out))

    monkeypatch.setattr(demo, "write_tree", write)
    monkeypatch.setattr(demo, "PORTION", 100)
    (spark.range(300).selectExpr("id AS o_orderkey", "id % 20 AS o_custkey", "'F' AS o_orderstatus", "timestamp'2001-01-01' AS o_orderdate",
                                 "'5-LOW' AS o_orderpriority").write.parquet(f"{tmp_dir}/orders.parquet"))
    assert queries.QUERIES[name](spark, tmp_dir).count() > 0
    assert len(kept) > 2 and kept[0] == 0 and all(kept[1:]) and kept[-1] < sum(stood[:-1])


def test_tasks_make_shared_folders_once(tmp_dir):
    """Tasks that make the same folders of old ones at the same time put none in another's place."""
    from concurrent.futures import ThreadPoolExecutor

    from cohortlake.sources import demo
    for i in range(300):
        os.makedirs(f"{tmp_dir}/old/{i}")
    demo._Pool(f"{tmp_dir}/pool").put_tree(f"{tmp_dir}/old")
    pools = [demo._Pool(f"{tmp_dir}/pool") for _ in range(8)]

    def task(i):
        for k in range(60):
            pools[i].folder(f"{tmp_dir}/out/a{k}/b")
            pools[i].file(f"{tmp_dir}/out/a{k}/b/f{i}", b"x" * k)
        pools[i].close()

    with ThreadPoolExecutor(8) as threads:
        list(threads.map(task, range(8)))
    assert {tuple(sorted(os.listdir(f"{tmp_dir}/out/a{k}/b"))) for k in range(60)} == {tuple(f"f{i}" for i in range(8))}
