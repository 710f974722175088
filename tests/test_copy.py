import hashlib
import os

import pytest

from tessera.operators.copy import copy_summary, copy_tree
from tessera.sources.files import list_tree
from conftest import write


def sha(p):
    return hashlib.sha256(open(p, "rb").read()).hexdigest()


def _tree(tmp):
    src, dst = f"{tmp}/src", f"{tmp}/dst"
    write(f"{src}/a/b/x.txt", "hello\n")
    write(f"{src}/a/y y.txt", "y" * 70000)
    write(f"{src}/zero.txt", "")
    os.makedirs(f"{src}/empty")
    os.symlink(f"{src}/a/y y.txt", f"{src}/link.txt")
    write(f"{dst}/src/a/y y.txt", "old")
    write(f"{dst}/src/zero.txt", "")
    write(f"{dst}/only.txt", "keep")
    return src, dst


def test_listing(spark, tmp):
    src, _ = _tree(tmp)
    rows = {r.uri[len(tmp):]: (r.file_type, r.len) for r in list_tree(spark, src, tasks=3).collect()}
    assert rows == {"/src": ("dir", 0), "/src/a": ("dir", 0), "/src/a/b": ("dir", 0),
                    "/src/a/b/x.txt": ("file", 6), "/src/a/y y.txt": ("file", 70000),
                    "/src/zero.txt": ("file", 0), "/src/empty": ("dir", 0)}


def test_copy_tree(spark, tmp):
    src, dst = _tree(tmp)
    status = copy_tree(spark, src, dst, tasks=3)
    acts = {r.dest[len(dst):]: (r.action, r.ok) for r in status.collect()}
    assert acts == {"/src": ("exists", True), "/src/a": ("exists", True), "/src/a/b": ("mkdir", True),
                    "/src/empty": ("mkdir", True), "/src/a/b/x.txt": ("create", True),
                    "/src/a/y y.txt": ("replace", True), "/src/zero.txt": ("replace", True)}
    for rel in ("a/b/x.txt", "a/y y.txt", "zero.txt"):
        assert sha(f"{src}/{rel}") == sha(f"{dst}/src/{rel}")
    assert os.path.isdir(f"{dst}/src/empty") and not os.path.exists(f"{dst}/src/link.txt")
    assert open(f"{dst}/only.txt").read() == "keep"
    assert not [f for f in os.listdir(f"{dst}/src/a") if f.startswith(".tessera.")]
    summary = {(r.action, r.ok): r.entries for r in copy_summary(status).collect()}
    assert summary[("create", True)] == 1


def test_missing_destination_parent(spark, tmp):
    src, _ = _tree(tmp)
    with pytest.raises(RuntimeError, match="failed"):
        copy_tree(spark, src, f"{tmp}/no/such/dest", tasks=2)
    status = copy_tree(spark, src, f"{tmp}/no/such/dest", tasks=2, ignore_errors=True)
    assert status.where("ok").count() == 0


def test_balanced_copy_tasks(spark, tmp):
    from pyspark.sql import functions as F
    from tessera.operators.copy import balanced_file_tasks
    sizes = [5, 5, 5, 5, 30, 1, 1, 1]
    for i, n in enumerate(sizes):
        write(f"{tmp}/src/f{i}.bin", "x" * n)
    files = spark.createDataFrame(
        [(f"{tmp}/src/f{i}.bin", f"{tmp}/dst/src/f{i}.bin", n, "create") for i, n in enumerate(sizes)],
        "src_uri string, dest string, src_len long, action string")
    placed = balanced_file_tasks(files, task_bytes=10, groups=2).withColumn("task", F.spark_partition_id())
    per_task = {}
    for r in placed.collect():
        per_task.setdefault(r.task, []).append(r.src_len)
    assert sorted(n for v in per_task.values() for n in v) == sorted(sizes)
    # every task holds at most task_bytes, except a single larger file alone
    # at the end of its batch
    for v in per_task.values():
        assert sum(v) - max(v) < 10
    os.makedirs(f"{tmp}/dst")
    status = copy_tree(spark, f"{tmp}/src", f"{tmp}/dst", tasks=2, task_bytes=10)
    assert status.where("ok").count() == len(sizes) + 1
    for i in range(len(sizes)):
        assert sha(f"{tmp}/src/f{i}.bin") == sha(f"{tmp}/dst/src/f{i}.bin")


def test_relative_paths_are_qualified(spark, tmp, monkeypatch):
    write(f"{tmp}/rel/src/a.txt", "a")
    os.makedirs(f"{tmp}/rel/dst")
    monkeypatch.chdir(f"{tmp}/rel")
    status = copy_tree(spark, "src", "dst", tasks=2)
    assert all(r.dest.startswith(f"{tmp}/rel/dst/src") for r in status.collect())
    assert open(f"{tmp}/rel/dst/src/a.txt").read() == "a"
    from tessera.operators.manifest import with_parent_chains
    chains = {r.uri[len(tmp):]: r.parents for r in with_parent_chains(list_tree(spark, "src"), f"{tmp}/rel/src").collect()}
    assert chains["/rel/src/a.txt"] == [f"{tmp}/rel/src"]


def test_sweep_removes_only_this_runs_leftovers(spark, tmp):
    import pyarrow as pa
    from tessera.operators.copy import TEMP_PREFIX, _sweep_fn
    write(f"{tmp}/d/{TEMP_PREFIX}run1.77.a.txt", "partial")
    write(f"{tmp}/d/{TEMP_PREFIX}run2.5.a.txt", "other job")
    write(f"{tmp}/d/a.txt", "done")
    batch = pa.RecordBatch.from_arrays([pa.array([f"{tmp}/d", f"{tmp}/missing"])], names=["folder"])
    out = list(_sweep_fn("run1")([batch]))[0].to_pydict()
    assert out["removed"] == [1, 0]
    assert sorted(os.listdir(f"{tmp}/d")) == sorted([f"{TEMP_PREFIX}run2.5.a.txt", "a.txt"])


def test_listing_budget_gives_same_manifest(spark, tmp):
    src, _ = _tree(tmp)
    for i in range(5):
        write(f"{src}/deep/l1/l2/l3/f{i}.txt", "x" * i)
    full = sorted(tuple(r) for r in list_tree(spark, src, tasks=3).select("uri", "len", "file_type").collect())
    small = sorted(tuple(r) for r in list_tree(spark, src, tasks=3, budget=1).select("uri", "len", "file_type").collect())
    assert full == small and len(full) == len(set(full))


def test_balanced_copy_of_folders_only(spark, tmp):
    os.makedirs(f"{tmp}/src/a/b")
    os.makedirs(f"{tmp}/dst")
    status = copy_tree(spark, f"{tmp}/src", f"{tmp}/dst", tasks=2, task_bytes=10)
    assert sorted(r.action for r in status.collect()) == ["mkdir", "mkdir", "mkdir"]
    assert os.path.isdir(f"{tmp}/dst/src/a/b")


def test_copy_single_file(spark, tmp):
    write(f"{tmp}/one.txt", "single")
    os.makedirs(f"{tmp}/dst")
    status = copy_tree(spark, f"{tmp}/one.txt", f"{tmp}/dst", tasks=2)
    assert [(r.action, r.ok) for r in status.collect()] == [("create", True)]
    assert open(f"{tmp}/dst/one.txt").read() == "single"


def test_listing_has_no_level_limit(spark, tmp):
    import pytest
    from tessera.sources.files import list_tree
    deep = f"{tmp}/t"
    for i in range(12):
        deep += f"/d{i}"
    write(f"{deep}/leaf.txt", "x")
    assert list_tree(spark, f"{tmp}/t", budget=1).count() == 14
    with pytest.raises(ValueError):
        list_tree(spark, f"{tmp}/t", budget=0)


def test_paths_belong_to_the_default_file_system(spark):
    import pytest
    from tessera.functions.files import qualify
    conf = spark._jsc.hadoopConfiguration()
    old = conf.get("fs.defaultFS")
    try:
        conf.set("fs.defaultFS", "hdfs://nn:8020")
        assert qualify("/data/in", spark) == "hdfs://nn:8020/data/in"
        assert qualify("hdfs:/x", spark) == "hdfs://nn:8020/x"
        assert qualify("file:/x", spark) == "file:/x"
        with pytest.raises(ValueError):
            qualify("rel/x", spark)
        with pytest.raises(ValueError):
            qualify("s3:/x", spark)
    finally:
        conf.set("fs.defaultFS", old)
    assert qualify("/data/in", spark) == "/data/in"


def test_status_rows_leave_in_bounded_batches(tmp):
    import pyarrow as pa
    from tessera.operators import copy as cp
    n = cp.STATUS_ROWS * 2 + 5
    work = pa.RecordBatch.from_pylist([{"src_uri": f"{tmp}/no{i}", "dest": f"{tmp}/to/x{i}", "src_len": 0,
                                        "action": "create"} for i in range(n)])
    sizes = [b.num_rows for b in cp._copy_batches([work], "a")]
    assert max(sizes) <= cp.STATUS_ROWS and sum(sizes) == n


def test_replacing_needs_a_known_file_system(tmp):
    import pyarrow.fs as pafs
    import pytest
    from tessera.operators.copy import move_over
    os.makedirs(f"{tmp}/m")
    write(f"{tmp}/m/a", "new")
    write(f"{tmp}/m/b", "old")
    other = pafs.SubTreeFileSystem(f"{tmp}/m", pafs.LocalFileSystem())
    with pytest.raises(OSError, match="not supported"):
        move_over(other, "a", "b")
    move_over(pafs.LocalFileSystem(), f"{tmp}/m/a", f"{tmp}/m/b")
    assert open(f"{tmp}/m/b").read() == "new"
