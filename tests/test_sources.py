from tessera.sources.text import read_headers, read_lines, read_whole_files
from tessera.sinks.text import compact_text
from conftest import write


def test_glob_and_lines(spark, tmp):
    write(f"{tmp}/logs/a.log", "1\n2\n")
    write(f"{tmp}/logs/b.log", "3\n")
    write(f"{tmp}/logs/c.txt", "9\n")
    assert sorted(r.value for r in read_lines(spark, f"{tmp}/logs/*.log").collect()) == ["1", "2", "3"]
    assert read_lines(spark, f"{tmp}/logs", glob_filter="*.txt").count() == 1


def test_whole_files_and_headers(spark, tmp):
    write(f"{tmp}/w/a.txt", "head a\nbody\n")
    write(f"{tmp}/w/b.txt", "   \nsecond\n")
    write(f"{tmp}/w/c.txt", "")
    write(f"{tmp}/w/d.txt", "only\r\nmore")
    whole = {r.path.rsplit("/", 1)[1]: r.value for r in read_whole_files(spark, f"{tmp}/w").collect()}
    assert whole["a.txt"] == "head a\nbody\n"
    from tessera.sources.files import list_tree
    paths = list_tree(spark, f"{tmp}/w").where("file_type = 'file'").select("uri")
    assert "c.txt" not in whole and whole["d.txt"] == "only\r\nmore"   # Spark skips empty files
    from tessera.sources.text import read_file_texts
    texts = {r.path.rsplit("/", 1)[1]: r.value for r in read_file_texts(paths, "uri").collect()}
    assert texts == {"a.txt": "head a\nbody\n", "b.txt": "   \nsecond\n", "c.txt": "", "d.txt": "only\r\nmore"}
    heads = {r.path.rsplit("/", 1)[1]: r.header for r in read_headers(paths, 'uri').collect()}
    assert heads == {"a.txt": "head a", "b.txt": None, "c.txt": None, "d.txt": "only"}


def test_compaction(spark, tmp):
    for i in range(5):
        write(f"{tmp}/parts/p{i}.txt", f"line {i}")      # no final newline
    write(f"{tmp}/merged/old.txt", "stale\n")
    compact_text(spark, f"{tmp}/parts/*.txt", f"{tmp}/merged", num_files=1)
    got = sorted(r.value for r in read_lines(spark, f"{tmp}/merged").collect())
    assert got == [f"line {i}" for i in range(5)]


def test_compaction_without_matches_leaves_target(spark, tmp):
    write(f"{tmp}/merged/old.txt", "keep\n")
    assert compact_text(spark, f"{tmp}/nothing/*.txt", f"{tmp}/merged") is False
    assert open(f"{tmp}/merged/old.txt").read() == "keep\n"


def test_files_are_sized_and_outputs_kept(spark, tmp):
    import pytest
    from pyspark.errors import AnalysisException
    from tessera.sinks.text import write_key_values
    for i in range(4):
        write(f"{tmp}/big/p{i}.txt", "x" * 99 + "\n")
    assert compact_text(spark, f"{tmp}/big/*.txt", f"{tmp}/out", file_bytes=200)
    assert len(spark.read.text(f"{tmp}/out").inputFiles()) == 2
    df = spark.createDataFrame([("k", 1)], "key string, v int")
    write_key_values(df, f"{tmp}/kv", "key", ["v"])
    with pytest.raises(AnalysisException):
        write_key_values(df, f"{tmp}/kv", "key", ["v"])


def test_bytes_that_are_not_text_fail(spark, tmp):
    import os
    import pytest
    from tessera.sources.text import read_file_texts
    os.makedirs(f"{tmp}/bad")
    with open(f"{tmp}/bad/a.txt", "wb") as f:
        f.write(b"\xff\xfe")
    paths = spark.createDataFrame([(f"{tmp}/bad/a.txt",)], "path string")
    with pytest.raises(Exception):
        read_file_texts(paths).collect()
    with pytest.raises(Exception):
        read_whole_files(spark, f"{tmp}/bad").collect()


def test_null_fields_keep_their_places(spark, tmp):
    from tessera.sinks.text import key_value_lines

    df = spark.createDataFrame([("k", 1, None, 3), (None, None, 2, 3)], "key string, a int, b int, c int")
    assert sorted(r.value for r in key_value_lines(df, "key", ["a", "b", "c"]).collect()) == ["\t 2 3", "k\t1  3"]


def test_compaction_refuses_its_own_sources(spark, tmp):
    import pytest

    from tessera.sinks.text import compact_text

    write(f"{tmp}/in/a.txt", "a\n")
    for target in (f"{tmp}/in", f"file://{tmp}/in", tmp):
        with pytest.raises(ValueError, match="choose another target"):
            compact_text(spark, f"{tmp}/in/*.txt", target)
    assert open(f"{tmp}/in/a.txt").read() == "a\n"
