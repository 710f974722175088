import pytest
from pyspark.sql import functions as F

from tessera.functions.paths import parent_chain, parent_path, rebase_path
from tessera.operators import manifest as mf

SCHEMA = mf.MANIFEST_SCHEMA


def _m(spark, rows):
    return spark.createDataFrame([(u, n, t, None) for u, n, t in rows], SCHEMA)


def test_rebase_keeps_source_name(spark):
    df = spark.createDataFrame([("/data/in",), ("/data/in/a.txt",), ("/data/in/x/b c.txt",)], "uri string")
    got = [r.d for r in df.select(rebase_path(F.col("uri"), "/data/in", "/bak/").alias("d")).collect()]
    assert got == ["/bak/in", "/bak/in/a.txt", "/bak/in/x/b c.txt"]
    root = spark.createDataFrame([("/a",)], "uri string")
    assert root.select(rebase_path(F.col("uri"), "/", "/bak").alias("d")).first().d == "/bak/a"


def test_outside_root_raises(spark):
    df = spark.createDataFrame([("/data/other/a.txt",)], "uri string")
    with pytest.raises(Exception, match="outside the source root"):
        df.select(rebase_path(F.col("uri"), "/data/in", "/bak")).collect()


def test_parent_chain_and_parent(spark):
    df = spark.createDataFrame([("/web/h/en/p.html",), ("/web",), ("/x",), ("/",)], "uri string")
    got = df.select(parent_chain(F.col("uri"), "/web").alias("c"), parent_path(F.col("uri")).alias("p")).collect()
    assert [r.c for r in got] == [["/web", "/web/h", "/web/h/en"], [], [], []]
    assert [r.p for r in got] == ["/web/h/en", "/", "/", None]


def test_parent_folders_and_sizes(spark):
    m = _m(spark, [("/r", 0, "dir"), ("/r/a/x.txt", 5, "file"), ("/r/a/y.txt", 7, "file"),
                   ("/r/b/z.txt", 1, "file"), ("/r/empty", 0, "dir")])
    tree = mf.with_parent_folders(m, "/r")
    assert sorted(r.uri for r in tree.where("file_type = 'dir'").collect()) == ["/r", "/r/a", "/r/b", "/r/empty"]
    sizes = {r.parent: (r.bytes, r.entries) for r in mf.folder_sizes(tree).collect()}
    assert sizes == {"/": (0, 1), "/r": (0, 3), "/r/a": (12, 2), "/r/b": (1, 1)}
    folders = spark.createDataFrame([("/r/a/",)], "folder string")
    assert sorted(r.uri for r in mf.file_sizes(tree, folders).collect()) == ["/r/a/x.txt", "/r/a/y.txt"]
    mixed = spark.createDataFrame([("/r/a",), ("/r/a/x.txt",), ("/r/b/z.txt",)], "folder string")
    assert sorted((r.uri, r.len) for r in mf.file_sizes(tree, mixed).collect()) == [
        ("/r/a/x.txt", 5), ("/r/a/y.txt", 7), ("/r/b/z.txt", 1)]


def test_plan_actions(spark):
    src = _m(spark, [("/s/src", 0, "dir"), ("/s/src/a", 3, "file"), ("/s/src/b", 4, "file"),
                     ("/s/src/d", 0, "dir"), ("/s/src/e", 0, "dir")])
    dst = _m(spark, [("/t", 0, "dir"), ("/t/src", 0, "dir"), ("/t/src/a", 9, "file"),
                     ("/t/src/only", 1, "file"), ("/t/src/e", 0, "dir")])
    plan = {r.dest: r.action for r in mf.copy_plan(src, dst, "/s/src", "/t").collect()}
    assert plan == {"/t": "keep", "/t/src": "exists", "/t/src/a": "replace", "/t/src/b": "create",
                    "/t/src/d": "mkdir", "/t/src/e": "exists", "/t/src/only": "keep"}
    assert mf.copy_work(mf.copy_plan(src, dst, "/s/src", "/t")).count() == 5


def test_names_siblings_times_match(spark):
    m = spark.createDataFrame([("/f/log-1.txt", 1, "file", "2024-01-02 00:00:00"),
                               ("/f/log-2.txt", 1, "file", "2024-01-01 00:00:00"),
                               ("/f/data.csv", 1, "file", "2024-01-03 00:00:00")],
                              "uri string, len long, file_type string, mtime string") \
        .withColumn("mtime", F.col("mtime").cast("timestamp"))
    assert mf.name_contains(m, "log*").count() == 2
    assert [r.uri for r in mf.name_contains(m, "log*", negate=True).collect()] == ["/f/data.csv"]
    assert sorted(r.uri for r in mf.siblings(m, "/f/log-1.txt").collect()) == ["/f/data.csv", "/f/log-2.txt"]
    assert [r.uri for r in mf.entry_times(m, "/f/").orderBy("mtime").collect()][0] == "/f/log-2.txt"
    assert mf.entry_times(m, "/other").count() == 0
    first = mf.first_entry_time(mf.with_parent(m)).first()
    assert first.parent == "/f" and str(first.first_time) == "2024-01-03 00:00:00"
    assert mf.any_match(m, r"log-2\.txt$").first().found is True
    assert mf.any_match(m, r"nothing").first().found is False


def test_group_positions_spread_a_hot_group(spark):
    from tessera.operators.ranking import group_positions
    rows = [("hot", f"n{i:04d}") for i in range(600)] + [("cold", "b"), ("cold", "a")]
    df = spark.createDataFrame(rows, "g string, o string")
    got = {(r.g, r.o): r.pos for r in group_positions(df, "g", "o", partitions=6).collect()}
    assert got[("hot", "n0000")] == 0 and got[("hot", "n0599")] == 599
    assert sorted(v for (g, _), v in got.items() if g == "hot") == list(range(600))
    assert got[("cold", "a")] == 0 and got[("cold", "b")] == 1


def test_name_lists_blocks(spark):
    rows = [(f"/d/f{i:02d}", 1, "file") for i in range(7)] + [("/e/x", 1, "file")]
    lists = {(r.parent, r.block): r.names for r in mf.name_lists(_m(spark, rows), block_size=3).collect()}
    assert lists == {("/d", 0): "f00,f01,f02", ("/d", 1): "f03,f04,f05", ("/d", 2): "f06", ("/e", 0): "x"}


def test_glob_to_regex_and_glob_entries(spark):
    import re
    from tessera.functions.paths import glob_to_regex
    cases = {
        "/d/*.txt": (["/d/a.txt", "/d/.txt"], ["/d/x/a.txt", "/d/a.txt2"]),
        "/d/part-?.csv": (["/d/part-1.csv"], ["/d/part-10.csv", "/d/part-/.csv"]),
        "/d/{a,b}/*": (["/d/a/x", "/d/b/y"], ["/d/c/x", "/d/a/x/y"]),
        "/d/[ab]x": (["/d/ax", "/d/bx"], ["/d/cx"]),
        "/d/[!ab]x": (["/d/cx"], ["/d/ax"]),
        "/d/a+b(1).txt": (["/d/a+b(1).txt"], ["/d/aab1.txt"]),
    }
    for pattern, (yes, no) in cases.items():
        rx = re.compile(glob_to_regex(pattern))
        assert all(rx.search(p) for p in yes), (pattern, yes)
        assert not any(rx.search(p) for p in no), (pattern, no)
    m = _m(spark, [("/d/a.txt", 1, "file"), ("/d/b.csv", 1, "file"), ("/d/x/c.txt", 1, "file")])
    assert sorted(r.uri for r in mf.glob_entries(m, "/d/*.txt").collect()) == ["/d/a.txt"]
    assert mf.any_glob_match(m, "/d/*/*.txt").first().found is True
    assert mf.any_glob_match(m, "/e/*").first().found is False


def test_listings_and_marks(spark):
    m = _m(spark, [("/f", 0, "dir"), ("/f/log-1.txt", 1, "file"), ("/f/log-2.txt", 2, "file"),
                   ("/f/data.csv", 3, "file"), ("/f/sub", 0, "dir"), ("/f/sub/log-3.txt", 4, "file"),
                   ("/logs", 0, "dir"), ("/logs/a.csv", 5, "file")])
    uris = lambda df: sorted(r.uri for r in df.collect())
    inside = mf.inside(m, "/f")
    assert uris(inside) == ["/f/data.csv", "/f/log-1.txt", "/f/log-2.txt", "/f/sub"]
    assert uris(mf.name_contains(inside, "log*", whole_path=True)) == ["/f/log-1.txt", "/f/log-2.txt"]
    assert uris(mf.name_contains(inside, "log*", negate=True, whole_path=True)) == ["/f/data.csv", "/f/sub"]
    # the mark is tested against the full path on request
    assert uris(mf.name_contains(mf.inside(m, "/logs"), "*log*", whole_path=True)) == ["/logs/a.csv"]
    assert uris(mf.name_contains(mf.inside(m, "/logs"), "*log*")) == []
    assert uris(mf.siblings(m, "/f/log-1.txt")) == ["/f/data.csv", "/f/log-2.txt", "/f/sub"]


def test_path_sizes(spark):
    m = _m(spark, [("/r", 0, "dir"), ("/r/a/x.txt", 5, "file"), ("/r/a/y.txt", 7, "file"),
                   ("/r/a", 0, "dir"), ("/r/empty", 0, "dir")])
    paths = spark.createDataFrame([("/r/a",), ("/r/a/x.txt",), ("/r/empty",), ("/nope",)], "folder string")
    got = {r.path: (r.bytes, r.entries) for r in mf.path_sizes(m, paths).collect()}
    assert got == {"/r/a": (12, 2), "/r/a/x.txt": (5, 1), "/r/empty": (0, 0), "/nope": (0, 0)}


def test_path_first_times(spark):
    m = spark.createDataFrame([("/f", "dir", None), ("/f/b.txt", "file", "2024-01-02 00:00:00"),
                               ("/f/a.txt", "file", "2024-01-05 00:00:00"), ("/g", "dir", None)],
                              "uri string, file_type string, mtime string") \
        .select("uri", F.lit(1).cast("long").alias("len"), "file_type", F.col("mtime").cast("timestamp").alias("mtime"))
    paths = spark.createDataFrame([("/f",), ("/f/b.txt",), ("/g",)], "folder string")
    got = {r.path: (str(r.first_time) if r.first_time else None) for r in mf.path_first_times(m, paths).collect()}
    assert got == {"/f": "2024-01-05 00:00:00", "/f/b.txt": "2024-01-02 00:00:00", "/g": None}


def test_file_sizes_folders_only(spark):
    m = _m(spark, [("/r/a/x.txt", 5, "file"), ("/r/b.txt", 2, "file")])
    paths = spark.createDataFrame([("/r/a",), ("/r/b.txt",)], "folder string")
    assert sorted(r.uri for r in mf.file_sizes(m, paths, folders_only=True).collect()) == ["/r/a/x.txt"]
    assert sorted(r.uri for r in mf.file_sizes(m, paths).collect()) == ["/r/a/x.txt", "/r/b.txt"]
