"""The bucketed cell table against ``put_cells``."""

import os
import random

import pytest

from tessera.operators import cell_buckets as B
from tessera.operators.cells import CELL_SCHEMA, put_cells


def _cells(spark, rows):
    return spark.createDataFrame(rows, CELL_SCHEMA)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _puts(seed, n, keys=40):
    deal = random.Random(seed)
    key = lambda: None if deal.random() < .05 else f"k{deal.randint(0, keys)}"
    return [(key(), "f", deal.choice(["a", "b", None]), deal.choice(["x", "y", "z", None]),
             deal.choice([None, 1, 2, 3])) for _ in range(n)]


def test_puts_equal_put_cells(spark, tmp):
    batches = [_puts(k, n) for k, n in enumerate((300, 20, 5, 200))]
    path = f"{tmp}/t"
    first = put_cells(_cells(spark, []), _cells(spark, batches[0]))
    assert B.create(_cells(spark, batches[0]), path, buckets=8) == 0
    state = first
    assert _rows(B.read(spark, path)) == _rows(state)
    for version, batch in enumerate(batches[1:], 1):
        state = put_cells(state, _cells(spark, batch)).checkpoint()
        assert B.put(_cells(spark, batch), path) == version
        assert _rows(B.read(spark, path)) == _rows(state)
    assert _rows(B.read(spark, path, version=0)) == _rows(first)


def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names
            if f.startswith("part-")}


def test_untouched_buckets_keep_their_files(spark, tmp):
    path = f"{tmp}/t"
    B.create(_cells(spark, [(f"k{i}", "f", "q", "v", 1) for i in range(200)]), path, buckets=16)
    before, where = _files(f"{path}/data"), {r.bucket: r.folder for r in B.manifest(spark, path).collect()}
    B.put(_cells(spark, [("k7", "f", "q", "new", 2), ("k7", "f", "q", "newer", 3)]), path)
    now = {r.bucket: r.folder for r in B.manifest(spark, path).collect()}
    moved = [b for b in where if b is not None and now[b] != where[b]]
    assert len(moved) == 1 and len(where) == 17 and set(now) == set(where)
    assert before.items() <= _files(f"{path}/data").items()
    got = B.get(spark.createDataFrame([("k7",), ("k9",), ("none",)], "row_key string"), path)
    assert _rows(got) == [("k7", "f", "q", "newer"), ("k9", "f", "q", "v")]
    plan = B.read(spark, path, only=B.manifest(spark, path).where(f"bucket = {moved[0]}"))
    assert len(plan.inputFiles()) == 1


def test_a_failed_put_changes_nothing(spark, tmp):
    path = f"{tmp}/t"
    B.create(_cells(spark, [("a", "f", "q", "v", 1)]), path, buckets=4)
    bad = _cells(spark, [("a", "f", "q", "w", 2)]).selectExpr(
        "row_key", "family", "qualifier", "raise_error('lost') AS value", "version")
    with pytest.raises(Exception, match="lost"):
        B.put(bad, path)
    assert _rows(B.read(spark, path)) == [("a", "f", "q", "v", 1)]
    os.makedirs(f"{path}/manifest/00000001")     # a manifest that was never committed
    assert _rows(B.read(spark, path)) == [("a", "f", "q", "v", 1)]
    assert B.put(_cells(spark, [("b", "f", "q", "w", 2)]), path) == 1
    assert len(_rows(B.read(spark, path))) == 2


def test_empty_tables_and_batches(spark, tmp):
    path = f"{tmp}/t"
    B.create(_cells(spark, []), path, buckets=4)
    assert B.read(spark, path).count() == 0
    B.put(_cells(spark, []), path)
    B.put(_cells(spark, [("a", None, None, None, None)]), path)
    assert _rows(B.read(spark, path)) == [("a", None, None, None, None)]
    with pytest.raises(FileExistsError):
        B.create(_cells(spark, []), path)
    with pytest.raises(FileNotFoundError):
        B.read(spark, f"{tmp}/none")
    with pytest.raises(FileNotFoundError):
        B.read(spark, path, version=9)


def test_old_versions_are_dropped(spark, tmp):
    path = f"{tmp}/t"
    B.create(_cells(spark, [(f"k{i}", "f", "q", "v", 1) for i in range(50)]), path, buckets=4)
    for v in range(2, 6):
        B.put(_cells(spark, [(f"k{v}", "f", "q", "w", v)]), path)
    want = _rows(B.read(spark, path))
    assert B.drop_old(spark, path) > 4
    assert _rows(B.read(spark, path)) == want
    with pytest.raises(FileNotFoundError):
        B.read(spark, path, version=0)
