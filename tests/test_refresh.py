"""A stored listing brought up to date equals a full listing."""

import os
import shutil

import pytest

from conftest import write
from tessera.sources import files as S


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture()
def tree(spark, tmp):
    for p in ("a/1", "a/2", "b/c/3", "b/c/d/4", "b/5", "e/f/6", "g h/7"):
        write(f"{tmp}/t/{p}", p)
    os.makedirs(f"{tmp}/t/empty")
    S.list_tree(spark, f"{tmp}/t").write.parquet(f"{tmp}/stored")
    for d, _, _ in os.walk(f"{tmp}/t"):     # a later tick of the clock
        assert os.stat(d).st_mtime_ns
    return f"{tmp}/t"


def _check(spark, tmp, tree, **kw):
    stored = spark.read.parquet(f"{tmp}/stored")
    for budget in (1, 10_000):
        assert _rows(S.refresh_tree(spark, tree, stored, tasks=3, budget=budget, **kw)) == _rows(S.list_tree(spark, tree))


def test_nothing_changed_lists_nothing(spark, tmp, tree, monkeypatch):
    want = _rows(S.list_tree(spark, tree))
    monkeypatch.setattr(S, "_list_fn", lambda batches: (1 / 0 for b in batches if b.num_rows))
    monkeypatch.setattr(S, "_walk_fn", lambda budget: lambda batches: (1 / 0 for b in batches if b.num_rows))
    got = S.refresh_tree(spark, tree, spark.read.parquet(f"{tmp}/stored"))
    assert _rows(got) == want


def test_added_removed_renamed(spark, tmp, tree):
    write(f"{tree}/a/new", "n")
    os.remove(f"{tree}/b/c/d/4")
    os.rename(f"{tree}/e", f"{tree}/z")
    shutil.rmtree(f"{tree}/g h")
    write(f"{tree}/empty/x/y/8", "8")
    _check(spark, tmp, tree)


def test_a_folder_that_became_something_else(spark, tmp, tree):
    shutil.rmtree(f"{tree}/a")
    write(f"{tree}/a", "now a file")
    os.makedirs(f"{tmp}/elsewhere/d")
    write(f"{tmp}/elsewhere/d/9", "9")
    shutil.rmtree(f"{tree}/b/c")
    os.symlink(f"{tmp}/elsewhere", f"{tree}/b/c")   # b/c/d is still there, but behind a link
    os.remove(f"{tree}/b/5")
    os.makedirs(f"{tree}/b/5/6")
    _check(spark, tmp, tree)


def test_files_rewritten_in_place(spark, tmp, tree):
    before = os.stat(f"{tree}/a").st_mtime_ns
    with open(f"{tree}/a/1", "a") as f:
        f.write("more")
    assert os.stat(f"{tree}/a").st_mtime_ns == before
    _check(spark, tmp, tree, check_files=True)
    unseen = {r.uri: r.len for r in S.refresh_tree(spark, tree, spark.read.parquet(f"{tmp}/stored")).collect()}
    assert unseen[f"{tree}/a/1"] == 3


def test_nothing_stored_and_root_gone(spark, tmp, tree):
    none = spark.createDataFrame([], S.ENTRY_SCHEMA)
    assert _rows(S.refresh_tree(spark, tree, none)) == _rows(S.list_tree(spark, tree))
    stored = spark.read.parquet(f"{tmp}/stored")
    shutil.rmtree(tree)
    with pytest.raises(FileNotFoundError):
        S.refresh_tree(spark, tree, stored)
    write(tree, "a file now")
    assert [(r.uri, r.file_type) for r in S.refresh_tree(spark, tree, stored).collect()] == [(tree, "file")]
