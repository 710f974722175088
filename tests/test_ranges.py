"""Files merged in order and copied by ranges, and copies taken up again."""

import hashlib
import os
import random
import zlib

import pytest
from pyspark.sql import functions as F

from conftest import write
from tessera.__main__ import main
from tessera.operators import copy as C, ranges as R
from tessera.sinks.files import write_files
from tessera.sources.files import list_tree


def _blob(n, seed=1):
    return random.Random(seed).randbytes(n)


def _file(path, body):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(body)
    return path


@pytest.mark.parametrize("range_bytes", [1, 7, 1000, 1 << 20])
def test_merge_is_byte_for_byte_in_path_order(spark, tmp, range_bytes):
    bodies = {"b/2": b"two", "a": b"\xff\x00no line end", "b/1": b"", "b 3": b"x" * 50, "zé": b"\n\n", "c/d/e": b"1"}
    for name, body in bodies.items():
        _file(f"{tmp}/in/{name}", body)
    _file(f"{tmp}/out/all", b"older content that is longer than everything merged over it" * 9)
    places = R.merge_in_order(list_tree(spark, f"{tmp}/in"), f"{tmp}/out/all", range_bytes, tasks=3)
    names = sorted(bodies, key=lambda n: f"{tmp}/in/{n}".encode())
    assert open(f"{tmp}/out/all", "rb").read() == b"".join(bodies[n] for n in names)
    assert os.listdir(f"{tmp}/out") == ["all"]
    start, want = 0, []
    for n in names:
        want.append((f"{tmp}/in/{n}", start, len(bodies[n])))
        start += len(bodies[n])
    assert sorted(tuple(r) for r in places.collect()) == sorted(want)


def test_merge_of_nothing_is_an_empty_file(spark, tmp):
    os.makedirs(f"{tmp}/in")
    places = R.merge_in_order(list_tree(spark, f"{tmp}/in"), f"{tmp}/all")
    assert places.count() == 0 and open(f"{tmp}/all", "rb").read() == b""


def test_a_file_that_shrank_leaves_the_target_alone(spark, tmp):
    _file(f"{tmp}/in/a", b"12345")
    _file(f"{tmp}/all", b"before")
    listed = list_tree(spark, f"{tmp}/in").withColumn("len", F.when(F.col("file_type") == "file", 9).otherwise(0))
    with pytest.raises(RuntimeError, match="ends . bytes early"):
        R.merge_in_order(listed, f"{tmp}/all", 3)
    assert open(f"{tmp}/all", "rb").read() == b"before" and sorted(os.listdir(tmp)) == ["all", "in"]
    gone = listed.withColumn("uri", F.concat("uri", F.lit(".gone")))
    with pytest.raises(RuntimeError, match="FileNotFoundError"):
        R.merge_in_order(gone, f"{tmp}/all", 3)


def test_copy_by_ranges(spark, tmp):
    big, small = _blob(1_000_003), b"small"
    _file(f"{tmp}/big", big), _file(f"{tmp}/small", small), _file(f"{tmp}/none", b"")
    rows = [(f"{tmp}/{n}", f"{tmp}/to/{n}", len(b)) for n, b in (("big", big), ("small", small), ("none", b""))]
    os.makedirs(f"{tmp}/to")
    files = spark.createDataFrame(rows, "src_uri string, dest string, src_len long")
    got = R.copy_ranges(files, 100_000, tasks=4)
    assert sorted((os.path.basename(r.dest), r.length, r.ok) for r in got.collect()) == [
        ("big", 1_000_003, True), ("none", 0, True), ("small", 5, True)]
    assert [open(f"{tmp}/to/{n}", "rb").read() for n in ("big", "small", "none")] == [big, small, b""]
    assert sorted(os.listdir(f"{tmp}/to")) == ["big", "none", "small"]
    digests = R.range_digests(spark.createDataFrame([(f"{tmp}/to/big", 5, 999_000)], "uri string, start long, length long"))
    assert digests.first().sha256 == hashlib.sha256(big[5:999_005]).hexdigest()
    bad = spark.createDataFrame([(f"{tmp}/big", f"{tmp}/nowhere/big", len(big))], files.schema)
    got = R.copy_ranges(bad, 100_000, ignore_errors=True).collect()
    assert [(r.ok, "FileNotFoundError" in r.message) for r in got] == [(False, True)]


def test_a_retried_range_repeats_what_is_there(tmp):
    """A lost attempt that wrote half a range, then the retry, then a late twin."""
    body = _blob(5000)
    src, dest, run = _file(f"{tmp}/src", body), f"{tmp}/dest", "r1"
    tmp_file = R._temporary(dest, run)
    _file(tmp_file, b"")
    os.truncate(tmp_file, 5000)
    with open(tmp_file, "r+b") as f:
        f.seek(1000)
        f.write(body[1000:1500])
    for start, length in [(1000, 2000), (0, 1000), (3000, 2000), (1000, 2000)]:
        written, crc = R._write(src, start, dest, start, length, run)
        assert written == length and crc == zlib.crc32(body[start:start + length])
        assert R._crc_at(dest, start, length, run) == crc
    assert open(tmp_file, "rb").read() == body


def test_a_target_with_other_bytes_is_reported(tmp, monkeypatch):
    import pyarrow as pa
    src, dest = _file(f"{tmp}/src", b"x" * 10), f"{tmp}/dest"
    _file(R._temporary(dest, "r"), b"\0" * 10)
    monkeypatch.setattr(R, "_crc_at", lambda *a: 0)
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in ([src], [0], [dest], [0], [10])],
                                       names=["src", "src_start", "dest", "dest_start", "length"])
    row = next(R._write_fn("r")([batch])).to_pylist()[0]
    assert not row["ok"] and "other bytes" in row["message"]


def test_ranges_are_refused_where_they_cannot_be_written(spark):
    files = spark.createDataFrame([("s3://b/x", "s3://b/y", 5)], "src_uri string, dest string, src_len long")
    with pytest.raises(ValueError, match="local file systems and HDFS only"):
        R.copy_ranges(files)


def _tree(tmp):
    for k in range(12):
        write(f"{tmp}/src/d{k % 3}/f{k}", f"file {k} " * (k + 1))
    os.makedirs(f"{tmp}/dst")


def test_copy_tree_with_large_files(spark, tmp):
    _tree(tmp)
    _file(f"{tmp}/src/big", _blob(300_000))
    status = C.copy_tree(spark, f"{tmp}/src", f"{tmp}/dst", range_bytes=50_000)
    rows = {os.path.basename(r.uri): r for r in status.collect()}
    assert rows["big"].ok and rows["big"].bytes == 300_000 and rows["f3"].ok and len(rows) == 17
    assert open(f"{tmp}/dst/src/big", "rb").read() == _blob(300_000)


def test_a_broken_copy_is_taken_up(spark, tmp, monkeypatch):
    """The first run dies in the middle of its file step; the second copies
    what the journal has not, a third nothing, one after a change that file."""
    _tree(tmp)
    journal = f"{tmp}/journal"
    plan = lambda: C.copy_plan(
        C.with_parent_folders(list_tree(spark, f"{tmp}/src"), f"{tmp}/src"),
        list_tree(spark, f"{tmp}/dst"), f"{tmp}/src", f"{tmp}/dst", with_times=True)

    def dies_at(mark):
        copy_files = C._copy_files_fn

        def broken(run_id, journal=None, journal_rows=1):
            one = C._copy_one

            def copy(batches):
                def fail(src, dest, n, attempt):
                    if src.endswith(mark):
                        raise MemoryError("executor lost")
                    return one(src, dest, n, attempt)
                C._copy_one = fail
                try:
                    yield from copy_files(run_id, journal, journal_rows)(batches)
                finally:
                    C._copy_one = one
            return copy
        return broken

    monkeypatch.setattr(C, "_copy_files_fn", dies_at("f7"))
    with pytest.raises(Exception, match="executor lost"):
        C.run_copy(plan(), f"{tmp}/dst", tasks=1, journal=journal)
    monkeypatch.undo()
    noted = {os.path.basename(r.dest) for r in C.read_journal(spark, journal).collect()}
    assert noted and "f7" not in noted
    os.utime(f"{tmp}/src/d0/f0")
    write(f"{tmp}/src/d1/f1", "changed")

    def run(**kw):
        status = C.copy_tree(spark, f"{tmp}/src", f"{tmp}/dst", journal=journal, **kw).where("uri LIKE '%/f%'")
        return {os.path.basename(r.uri): r.action for r in status.collect()}

    second = run()
    assert {n for n, a in second.items() if a == "skip"} == noted - {"f0", "f1"} and len(second) == 12
    assert set(run().values()) == {"skip"}
    for k in range(12):
        assert open(f"{tmp}/dst/src/d{k % 3}/f{k}").read() == open(f"{tmp}/src/d{k % 3}/f{k}").read()
    write(f"{tmp}/dst/src/d2/f2", "spoiled, with another length than the source has")
    os.remove(f"{tmp}/dst/src/d2/f5")
    assert {n for n, a in run(range_bytes=20).items() if a != "skip"} == {"f2", "f5"}
    assert set(run(range_bytes=20).values()) == {"skip"}
    assert open(f"{tmp}/dst/src/d2/f2").read() == open(f"{tmp}/src/d2/f2").read()


def test_copy_command_takes_up(spark, tmp):
    _tree(tmp)
    args = ["copy", f"{tmp}/src", f"{tmp}/dst", "--journal", f"{tmp}/j", "--range-bytes", "40"]
    assert main(args) == 0 and main(args) == 0
    assert C.read_journal(spark, f"{tmp}/j").count() == 12
    assert open(f"{tmp}/dst/src/d2/f11").read() == "file 11 " * 12


def test_write_files(spark, tmp):
    rows = spark.createDataFrame([(f"{tmp}/w/a b/x", "é"), (f"{tmp}/w/y", None)], "path string, content string")
    write_files(rows)
    write_files(rows)
    assert open(f"{tmp}/w/a b/x", "rb").read() == "é".encode() and open(f"{tmp}/w/y", "rb").read() == b""
    assert sorted(os.listdir(f"{tmp}/w")) == ["a b", "y"]
