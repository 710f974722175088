from tessera.operators.cells import CELL_SCHEMA, delete_rows, get_rows, put_cells


def _cells(spark, rows):
    return spark.createDataFrame(rows, CELL_SCHEMA)


def test_reference_sequence(spark):
    empty = _cells(spark, [])
    batch = _cells(spark, [
        ("Tom", "info", "student_id", "S-0001", 1),
        ("Tom", "info", "class", "1", 1),
        ("Tom", "score", "understanding", "75", 1),
        ("Tom", "score", "programming", "82", 1),
        ("Ann Lee", "info", "student_id", "S-0002", 2),
    ])
    table = put_cells(empty, batch)
    keys = spark.createDataFrame([("Ann Lee",)], "row_key string")
    got = [(r.qualifier, r.value) for r in get_rows(table, keys).collect()]
    assert got == [("student_id", "S-0002")]
    left = delete_rows(table, keys)
    assert sorted((r.row_key, r.qualifier) for r in left.collect()) == [
        ("Tom", "class"), ("Tom", "programming"), ("Tom", "student_id"), ("Tom", "understanding")]


def test_newest_version_wins(spark):
    base = _cells(spark, [("r", "f", "q", "old", 5), ("r", "f", "p", "keep", 9)])
    newer = _cells(spark, [("r", "f", "q", "new", 6), ("r", "f", "p", "stale", 3)])
    same = _cells(spark, [("r", "f", "q", "later batch", 6)])
    t = {(r.qualifier): (r.value, r.version) for r in put_cells(base, newer, same).collect()}
    assert t == {"q": ("later batch", 6), "p": ("keep", 9)}


def test_missing_and_empty_keys(spark):
    t = _cells(spark, [("a", "f", "q", "1", 1)])
    none = spark.createDataFrame([], "row_key string")
    missing = spark.createDataFrame([("zz",)], "row_key string")
    assert get_rows(t, none).count() == 0
    assert delete_rows(t, none).count() == 1
    assert get_rows(t, missing).count() == 0
    assert delete_rows(t, missing).count() == 1


def test_binary_values_round_trip(spark):
    from pyspark.sql import functions as F
    from tessera.functions import utf8_bytes, utf8_text
    t = _cells(spark, [("r", "f", "q", "véalue", 1)])
    as_bytes = t.withColumn("value", utf8_bytes(F.col("value")))
    newer = as_bytes.withColumn("version", F.lit(2).cast("long")).withColumn("value", utf8_bytes(F.lit("new")))
    out = put_cells(as_bytes, newer).withColumn("value", utf8_text(F.col("value")))
    assert [(r.value, r.version) for r in out.collect()] == [("new", 2)]
    assert utf8_text(utf8_bytes(F.lit("véalue"))) is not None
    assert t.select(utf8_text(utf8_bytes(F.col("value"))).alias("v")).first().v == "véalue"


def test_merge_matches_put(spark):
    import random
    rnd = random.Random(7)
    base_rows = [(f"r{rnd.randint(0, 9)}", "f", f"q{rnd.randint(0, 3)}", f"v{i}", rnd.randint(0, 5)) for i in range(60)]
    batch_rows = [(f"r{rnd.randint(0, 12)}", "f", f"q{rnd.randint(0, 4)}", f"w{i}", rnd.randint(0, 5)) for i in range(25)]
    table = put_cells(_cells(spark, []), _cells(spark, base_rows))
    batch = _cells(spark, batch_rows)
    want = sorted(tuple(r) for r in put_cells(table, batch).collect())
    from tessera.operators.cells import merge_cells
    assert sorted(tuple(r) for r in merge_cells(table, batch).collect()) == want


def test_merge_with_nulls_and_repeats_is_a_put(spark):
    from tessera.operators.cells import merge_cells
    table = _cells(spark, [("r", "f", "q", "old", None), ("r", None, "q", "a", 1), ("s", "f", "q", "x", 1),
                           ("s", "f", "q", "y", 2), (None, "f", "q", "n", 3)])
    batch = _cells(spark, [("r", "f", "q", "new", 5), ("r", None, "q", "b", 1), ("t", "f", "q", "z", None),
                           (None, "f", "q", "m", None)])
    got = {tuple(r)[:3]: tuple(r)[3:] for r in merge_cells(table, batch).collect()}
    assert got == {("r", "f", "q"): ("new", 5), ("r", None, "q"): ("b", 1), ("s", "f", "q"): ("y", 2),
                   ("t", "f", "q"): ("z", None), (None, "f", "q"): ("n", 3)}
    key = lambda r: str(tuple(r))
    assert sorted(merge_cells(table, batch).collect(), key=key) == sorted(put_cells(table, batch).collect(), key=key)
