import pyarrow as pa
from pyspark.sql import functions as F

from tessera.operators import text_index as ti

DOCS = [(0, "it is what it is"), (1, "what is it"), (2, "it is a banana")]


def _docs(spark, rows=DOCS):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_golden_index(spark):
    # expected sets from the reference's logged output
    got = {r.word: r.doc_ids for r in ti.posting_lists(_docs(spark)).collect()}
    assert got == {"banana": [2], "it": [0, 1, 2], "is": [0, 1, 2], "a": [2], "what": [0, 1]}


def test_golden_index_with_counts(spark):
    got = {r.word: [(p.doc_id, p.n) for p in r.postings]
           for r in ti.posting_lists_with_counts(_docs(spark)).collect()}
    assert got == {"banana": [(2, 1)], "it": [(0, 2), (1, 1), (2, 1)],
                   "is": [(0, 2), (1, 1), (2, 1)], "a": [(2, 1)], "what": [(0, 1), (1, 1)]}


def test_empty_words_are_kept(spark):
    docs = _docs(spark, [(0, ""), (1, "a  b"), (2, "c "), (3, None)])
    got = sorted((r.word, r.doc_id, r.n) for r in ti.term_counts(docs).collect())
    assert got == [("", 0, 1), ("", 1, 1), ("", 2, 1), ("a", 1, 1), ("b", 1, 1), ("c", 2, 1)]


def test_blocks_bound_list_length(spark):
    rows = [(i, "hot word") for i in range(25)]
    pl = ti.posting_lists(_docs(spark, rows), block_size=10).where(F.col("word") == "hot")
    blocks = {r.block: r.doc_ids for r in pl.collect()}
    assert blocks == {0: list(range(10)), 1: list(range(10, 20)), 2: list(range(20, 25))}
    neg = ti.posting_lists(_docs(spark, [(-1, "x"), (-10, "x"), (-11, "x")]), block_size=10)
    assert {r.block: r.doc_ids for r in neg.collect()} == {-1: [-10, -1], -2: [-11]}


def test_golden_with_text_ids_as_given(spark):
    docs = spark.createDataFrame([(str(i), t) for i, t in DOCS], "doc_id string, text string")
    got = {r.word: r.doc_ids for r in ti.posting_lists(docs).collect()}
    assert got == {"banana": ["2"], "it": ["0", "1", "2"], "is": ["0", "1", "2"], "a": ["2"], "what": ["0", "1"]}
    got = {r.word: [(p.doc_id, p.n) for p in r.postings] for r in ti.posting_lists_with_counts(docs).collect()}
    assert got["it"] == [("0", 2), ("1", 1), ("2", 1)] and got["what"] == [("0", 1), ("1", 1)]


def test_text_ids_blocked_by_sorted_number(spark):
    docs = spark.createDataFrame([(f"d{i:02d}", "w") for i in range(25)], "doc_id string, text string")
    blocks = {r.block: r.doc_ids for r in ti.posting_lists(docs, block_size=10).collect()}
    assert blocks == {0: [f"d{i:02d}" for i in range(10)], 1: [f"d{i:02d}" for i in range(10, 20)],
                      2: [f"d{i:02d}" for i in range(20, 25)]}


def test_repeated_ids_are_merged(spark):
    docs = _docs(spark, [(7, "a b"), (7, "a"), (3, "b")])
    got = {r.word: [(p.doc_id, p.n) for p in r.postings] for r in ti.posting_lists_with_counts(docs).collect()}
    assert got == {"a": [(7, 2)], "b": [(3, 1), (7, 1)]}
    assert {r.word: r.doc_ids for r in ti.posting_lists(docs).collect()} == {"a": [7], "b": [3, 7]}


def test_row_counts_need_no_shuffle(spark):
    docs = spark.range(0, 64, numPartitions=32).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("w"), (F.col("id") % 5).cast("string"), F.lit(" x")).alias("text"))
    plan = ti.row_term_counts(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_term_counts_sum_over_repeated_ids_and_skip_null_ids(spark):
    docs = _docs(spark, [(1, "a b"), (1, "a"), (None, "a")])
    assert sorted(tuple(r) for r in ti.term_counts(docs).collect()) == [("a", 1, 2), ("b", 1, 1)]
    assert {r.word: r.doc_ids for r in ti.posting_lists(docs).collect()} == {"a": [1], "b": [1]}
    text = docs.withColumn("doc_id", F.col("doc_id").cast("string"))
    assert {r.word: r.doc_ids for r in ti.posting_lists(text).collect()} == {"a": ["1"], "b": ["1"]}


def test_merge_and_render(spark):
    df = spark.createDataFrame([([0, 2], [1, 2])], "a array<long>, b array<long>")
    r = df.select(ti.render_ids(ti.merge_posting_lists(F.col("a"), F.col("b"))).alias("s")).first()
    assert r.s == "0,1,2"


def test_null_text_without_ansi(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.ansi.enabled", "spark.sql.legacy.sizeOfNull")}
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        spark.conf.set("spark.sql.legacy.sizeOfNull", "true")
        docs = _docs(spark, [(0, None), (1, "a a")])
        assert sorted(tuple(r) for r in ti.term_counts(docs).collect()) == [("a", 1, 2)]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_blocks_of_large_ids(spark):
    """Ids of hashes and counters near the ends of 64 bits: no block beyond its size."""
    ids = [9 * 10 ** 18 + i for i in range(300)] + [2 ** 63 - 1 - i for i in range(150)] + [-2 ** 63 + i for i in range(150)]
    docs = _docs(spark, [(i, "w") for i in ids])
    got = {r.block: r.doc_ids for r in ti.posting_lists(docs, block_size=100).collect()}
    want = {}
    for i in sorted(ids):
        want.setdefault(i // 100, []).append(i)
    assert got == want and max(map(len, got.values())) <= 100
    counted = {r.block: [p.doc_id for p in r.postings]
               for r in ti.posting_lists_with_counts(docs, block_size=100).collect()}
    assert counted == want


def test_separator_is_plain_text(spark):
    docs = _docs(spark, [(1, "a|b|a"), (2, "c.d")])
    assert sorted(tuple(r) for r in ti.term_counts(docs, sep="|").collect()) == [("a", 1, 2), ("b", 1, 1), ("c.d", 2, 1)]
    assert {r.word: r.doc_ids for r in ti.posting_lists(docs, sep=".").collect()} == {"a|b|a": [1], "c": [2], "d": [2]}


def test_hot_id_is_summed_before_it_moves(spark):
    docs = _docs(spark, [(7, "hot hot word")] * 500 + [(8, "hot")])
    lists = ti.posting_lists_with_counts(docs)
    assert {r.word: [tuple(p) for p in r.postings] for r in lists.collect()} == {
        "hot": [(7, 1000), (8, 1)], "word": [(7, 500)]}
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan


def test_id_types_are_kept(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "a")], "doc_id int, text string")
    assert ti.posting_lists(docs).schema["doc_ids"].dataType.simpleString() == "array<int>"
    assert dict(ti.posting_lists_with_counts(docs).dtypes)["postings"] == "array<struct<doc_id:int,n:bigint>>"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_term_counts_sum_words_as_they_come(spark):
    docs = _docs(spark)
    plan = _plan(ti.term_counts(docs))
    assert "lambda" not in plan and "partial_sum" in plan and "sort_array" not in plan


def test_row_counts_come_from_pieces_of_a_batch(spark, monkeypatch):
    """Counted batch by batch, not with lambdas word by word; pieces of any size give the same."""
    assert "lambda" not in _plan(ti.row_term_counts(_docs(spark)))
    rows = pa.record_batch([pa.array([5, 5, 6, 7]), pa.array(["b a b", "", "a", "  é"])], names=["doc_id", "text"])
    for size in (1, 4, 1 << 20):
        monkeypatch.setattr(ti, "CHUNK_BYTES", size)
        assert sum(p.num_rows for p in ti._chunks([rows, rows.slice(0, 0)])) == 4
    docs = _docs(spark, [(5, "b a b"), (5, ""), (6, "a"), (7, "  é"), (8, None), (None, "a")])
    assert sorted(tuple(r) for r in ti.row_term_counts(docs).collect()) == [
        ("", 5, 1), ("", 7, 2), ("a", 5, 1), ("a", 6, 1), ("b", 5, 2), ("é", 7, 1)]


def test_lists_are_cut_from_sorted_rows(spark):
    """Lists over many batches, and many in one, without an aggregate."""
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
        docs = _docs(spark, [(i, "hot hot " + f"w{i % 4}") for i in range(40)])
        for lists, column, of in ((ti.posting_lists, "doc_ids", lambda e: e), (ti.posting_lists_with_counts, "postings", tuple)):
            df = lists(docs, block_size=16)
            assert "ObjectHashAggregate" not in _plan(df)
            got = {(r.word, r.block): [of(e) for e in r[column]] for r in df.collect()}
            want = {}
            for i in range(40):
                for word, n in (("hot", 2), (f"w{i % 4}", 1)):
                    want.setdefault((word, i // 16), []).append(i if column == "doc_ids" else (i, n))
            assert got == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
