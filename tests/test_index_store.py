"""Merging stored indexes and the compact form of posting lists."""

import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tessera.operators import index_store as S, text_index as ti

SCHEMA = "doc_id long, text string"


def _docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _lists(df):
    return sorted((r.word, r.block, r.doc_ids) for r in df.collect())


def _counts(df):
    return sorted((r.word, r.block, [tuple(p) for p in r.postings]) for r in df.collect())


def _random_rows(seed, n, low=-500, high=500):
    deal = random.Random(seed)
    words = ["the", "of", "a", "", "rare1", "rare2", "x"]
    return [(deal.randint(low, high), " ".join(deal.choices(words, [9, 5, 3, 1, .1, .1, 1], k=deal.randint(1, 8))))
            for _ in range(n)] + [(None, "the"), (3, None)]


@pytest.mark.parametrize("sizes,block", [((10, 10), 10), ((7, 100), 10), ((3, 50, 1000), 64), ((1000, 5), 1)])
def test_merged_equals_rebuilt(spark, sizes, block):
    parts = [_random_rows(k, 120) for k in range(len(sizes))]
    frames, together = [_docs(spark, p) for p in parts], _docs(spark, sum(parts, []))
    for build, read in ((ti.posting_lists, _lists), (ti.posting_lists_with_counts, _counts)):
        merged = S.merge_indexes(*(build(f, block_size=s) for f, s in zip(frames, sizes)), block_size=block)
        assert read(merged) == read(build(together, block_size=block))
        assert merged.columns == build(together).columns and merged.schema.simpleString() == build(together).schema.simpleString()


def test_merge_of_one_and_of_empty_indexes(spark):
    docs, none = _docs(spark, [(1, "a b a"), (2 ** 62, "a"), (-2 ** 63, "a")]), _docs(spark, [])
    whole = ti.posting_lists_with_counts(docs, block_size=100)
    assert _counts(S.merge_indexes(whole, block_size=100)) == _counts(whole)
    assert _counts(S.merge_indexes(ti.posting_lists_with_counts(none), whole, block_size=100)) == _counts(whole)
    assert S.merge_indexes(ti.posting_lists(none), ti.posting_lists(none)).count() == 0


def test_merge_has_one_shuffle_and_reads_blocks(spark):
    a, b = (ti.posting_lists(_docs(spark, _random_rows(k, 50))).checkpoint() for k in (1, 2))
    plan = S.merge_indexes(a, b)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_what_cannot_be_merged(spark):
    docs = _docs(spark, [(1, "a")])
    text = docs.withColumn("doc_id", F.col("doc_id").cast("string"))
    with pytest.raises(ValueError, match="same form"):
        S.merge_indexes(ti.posting_lists(docs), ti.posting_lists_with_counts(docs))
    with pytest.raises(ValueError, match="integer ids"):
        S.merge_indexes(ti.posting_lists(text), ti.posting_lists(text))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2 ** 63 - 1) | st.integers(0, 300)))
def test_numbers_round_trip(values):
    data, starts = S.put_numbers(np.array(values, np.uint64))
    assert S.get_numbers(data.tobytes()).tolist() == values
    assert len(data) == sum(max(1, -(-v.bit_length() // 7)) for v in values)
    assert len(starts) == len(values)


def test_number_format():
    # fixed by the definition: seven bits a byte, low bits first, the eighth set but on the last
    assert S.put_numbers(np.array([0, 127, 128, 300]))[0].tolist() == [0, 127, 0x80, 1, 0xAC, 2]


def test_compact_and_back(spark):
    ids = sorted({random.Random(4).randint(-10 ** 6, 10 ** 6) for _ in range(3000)}) + [2 ** 63 - 1]
    docs = _docs(spark, [(i, "hot" if i % 5 else "hot odd") for i in ids] + [(5, "single")])
    for block in (50, 1000, 10 ** 7):
        lists = ti.posting_lists(docs, block_size=block).repartition(3)
        stored = S.compact(lists).checkpoint()
        assert _lists(S.expand(stored)) == _lists(lists)
        for r in stored.where("word = 'hot'").collect():
            assert len(r.skip_ids) == len(r.skip_at) == (r.n - 1) // S.SKIP
    assert S.expand(S.compact(ti.posting_lists(_docs(spark, [])))).count() == 0


def test_lookup_finds_what_is_there(spark):
    ids = sorted(random.Random(7).sample(range(-3000, 9000), 4000))
    docs = _docs(spark, [(i, "w" if i % 3 else "w v") for i in ids])
    stored = S.compact(ti.posting_lists(docs, block_size=2500))
    asked = [(w, i) for w in ("w", "v", "none") for i in range(-3010, 9010, 7)] + [("w", None), (None, 4), ("w", ids[0])]
    got = S.lookup(stored, spark.createDataFrame(asked, "word string, doc_id long"), 2500).collect()
    have = set(ids)
    want = lambda w, i: i in have and (w == "w" or w == "v" and i % 3 == 0)
    assert len(got) == len(asked)
    assert all(r.found == want(r.word, r.doc_id) for r in got)


def test_index_merge_command(spark, tmp):
    from tessera.__main__ import main

    rows = _random_rows(3, 80)
    _docs(spark, rows[:40]).write.parquet(f"{tmp}/a")
    _docs(spark, rows[40:]).write.parquet(f"{tmp}/b")
    assert main(["index", f"{tmp}/a", f"{tmp}/ia", "--counts", "--block-size", "100"]) == 0
    assert main(["index", f"{tmp}/b", f"{tmp}/ib", "--counts", "--block-size", "100", "--onto", f"{tmp}/ia"]) == 0
    want = ti.posting_lists_with_counts(_docs(spark, rows), block_size=100)
    assert _counts(spark.read.parquet(f"{tmp}/ib")) == _counts(want)


def test_lists_that_share_no_id_are_not_compared_entry_by_entry(spark):
    a = ti.posting_lists_with_counts(_docs(spark, [(1, "x y"), (3, "x")]))
    b = ti.posting_lists_with_counts(_docs(spark, [(2, "x x"), (3, "y x")]))
    merged = S.merge_indexes(a, b)
    assert "array_distinct(_all" in merged._jdf.queryExecution().optimizedPlan().toString()
    assert _counts(merged) == _counts(ti.posting_lists_with_counts(_docs(spark, [(1, "x y"), (2, "x x"), (3, "x"), (3, "y x")])))
