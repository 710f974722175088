"""Inverted index over documents split on single spaces.

Words come from ``split(text, ' ', -1)``: empty words from leading,
trailing or repeated spaces are kept, as with ``split(" ", -1)`` on the JVM.
Rows without an id belong to no document and are left out.

Plan shape:

* ``row_term_counts`` - ``(word, doc_id, n)`` per row.  The rows of a batch are
  split and counted together in Arrow, a few MB of text at a time: no shuffle.
  For a table with one row per document it equals ``term_counts``.
* ``term_counts`` - words summed by (word, document), for tables that may
  repeat an id: one shuffle, reduced map-side.
* ``posting_lists`` - distinct words per row, then one shuffle on ``(word,
  block)``; if ids repeat, into sets of ids, which drop them map-side.
* ``posting_lists_with_counts`` - row counts to their list by ``(word,
  block)``; if ids repeat, first summed by (word, document), in part in the map
  tasks, so a word in a million rows of one id reaches its list as one entry.

Where no (word, document) comes twice, the rows of a list are sorted side by
side and cut out of the batches (``_gathered``).

A posting list is cut into blocks of document ids ``[block * block_size,
(block + 1) * block_size)``, so one array never holds more than ``block_size``
entries, however common the word or repeated the id is.  Ids that are not
integers (text ids) are first numbered in sorted order
(``ranking.exclusive_prefix_sum``) and blocked by that number; lists are made
of the numbers, and a list's numbers become ids at its end.  ``sep`` is plain
text, not a pattern.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from tessera.operators.ranking import exclusive_prefix_sum

DEFAULT_BLOCK_SIZE = 100_000


def _is_integral(docs: DataFrame, doc_col: str) -> bool:
    return isinstance(docs.schema[doc_col].dataType,
                      (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


CHUNK_BYTES = 4 << 20  # texts that are counted at once


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in pieces of about ``CHUNK_BYTES`` of text."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64))
        piece = ends // CHUNK_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows] if len(ends) else []
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def row_term_counts(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text",
                    sep: str = " ") -> DataFrame:
    """``(word, doc_id, n)``: how often each word occurs in each row."""
    docs = docs.select(F.col(doc_col).alias("doc_id"), F.col(text_col).alias("text")).where(
        F.col("text").isNotNull() & F.col("doc_id").isNotNull())

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _chunks(batches):
            lists = pc.split_pattern(rows.column(1), sep)
            words = lists.flatten().dictionary_encode()
            row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            distinct = len(words.dictionary)
            pairs, n = np.unique(row * distinct + words.indices.to_numpy(), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [words.dictionary.take(pa.array(pairs % distinct)), rows.column(0).take(pa.array(pairs // distinct)),
                 pa.array(n, pa.int64())], names=["word", "doc_id", "n"])

    id_type = docs.schema["doc_id"].dataType
    return docs.mapInArrow(count, T.StructType([T.StructField("word", T.StringType()), T.StructField("doc_id", id_type),
                                                T.StructField("n", T.LongType())]))


def term_counts(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text",
                sep: str = " ") -> DataFrame:
    """``(word, doc_id, n)``: how often each word occurs in each document,
    over all rows with its id."""
    words = docs.where(F.col(text_col).isNotNull() & F.col(doc_col).isNotNull()).select(
        F.explode(F.split(F.col(text_col), re.escape(sep), -1)).alias("word"), F.col(doc_col).alias("doc_id"))
    return words.groupBy("word", "doc_id").agg(F.sum(F.lit(1).cast("long")).alias("n"))


def block_of(doc: F.Column, block_size: int) -> F.Column:
    """floor(doc / block_size) in integers: exact for negative ids and for ids
    beyond 2^53."""
    b = F.lit(block_size).cast("long")
    down = F.when((doc < 0) & (F.pmod(doc, b) != 0), F.lit(1)).otherwise(F.lit(0))
    return (F.call_function("div", doc, b) - down).cast("long")


NAME_BYTES = 64 << 20  # text ids and their numbers that are broadcast


def _keyed(docs: DataFrame, doc_col: str, text_col: str) -> tuple[DataFrame, DataFrame | None, bool]:
    """``(key, text)`` and the names of the keys.  ``key`` orders and blocks
    the documents: the id itself if it is an integer, else its number in the
    sorted distinct ids, by a distributed prefix sum; ``names`` then holds
    ``(key, name)``, checkpointed.  The third value says whether their counted
    bytes are few enough to broadcast - beyond that the texts are shuffled
    once to meet them."""
    rows = docs.select(F.col(doc_col).alias("_id"), F.col(text_col).alias("text")).where("_id IS NOT NULL")
    if _is_integral(docs, doc_col):
        return rows.select(F.col("_id").cast("long").alias("key"), "text"), None, False
    names = exclusive_prefix_sum(rows.select("_id").distinct(), "_id", F.lit(1).cast("long"), "key")
    names = names.select(F.col("key").cast("long").alias("key"), F.col("_id").alias("name")).checkpoint()
    size = names.agg(F.sum(F.octet_length(F.col("name").cast("string")) + 16)).first()[0] or 0
    few = size <= NAME_BYTES
    given = rows.join(F.broadcast(names) if few else names, F.col("_id") == F.col("name"))
    return given.select("key", "text"), names, few


def _named(lists: DataFrame, names: DataFrame, few: bool, block_size: int, column: str, name_of) -> DataFrame:
    """Keys of a block turned into the ids they stand for.  A block's names
    are one array of at most ``block_size`` entries; the keys of a block are
    consecutive, so a key's place in it is its number less the block's first."""
    of_block = names.groupBy(block_of(F.col("key"), block_size).alias("_b")).agg(
        F.sort_array(F.collect_list(F.struct("key", "name")))["name"].alias("_names"))
    if few:
        of_block = F.broadcast(of_block)
    joined = lists.join(of_block, F.col("block") == F.col("_b"))
    return joined.withColumn(column, F.transform(column, lambda e: name_of(
        e, lambda key: F.get(F.col("_names"), (key - F.col("block") * block_size).cast("int"))))).drop("_b", "_names")


def _repeats(rows: DataFrame) -> bool:
    """Whether a key has more than one row."""
    return not rows.groupBy("key").count().where("count > 1").isEmpty()


def _gathered(rows: DataFrame, column: str, kind: str) -> DataFrame:
    """``(word, block, column)`` of ``rows(word, key, [n,] block)``: the keys of
    each word and block as one sorted list, with their counts if there are any.
    Rows are dealt by word and block and sorted, so a list's rows lie side by
    side and are cut out as they come; a task holds one list at a time."""
    counted = "n" in rows.columns

    def lists(rows: pa.RecordBatch, starts: np.ndarray, size: int) -> pa.RecordBatch:
        keys = rows.column(2).slice(0, size)
        values = pa.StructArray.from_arrays([keys, rows.column(3).slice(0, size)], ["doc_id", "n"]) if counted else keys
        first = pa.array(starts)
        return pa.RecordBatch.from_arrays(
            [rows.column(0).take(first), rows.column(1).take(first),
             pa.ListArray.from_arrays(pa.array(np.append(starts, size), pa.int32()), values)], names=["word", "block", column])

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of one list, which may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            if held and all(batch.column(c)[-1] == held[0].column(c)[0] for c in (0, 1)):
                held.append(batch)
                continue
            whole = pa.Table.from_batches([*held, batch]).combine_chunks().to_batches()[0]
            word, block = whole.column(0), whole.column(1).to_numpy()
            other = pc.not_equal(word.slice(1), word.slice(0, len(word) - 1)).to_numpy(zero_copy_only=False)
            starts = np.append(0, np.flatnonzero(other | (np.diff(block) != 0)) + 1)
            if len(starts) > 1:
                yield lists(whole, starts[:-1], int(starts[-1]))
            held = [whole.slice(int(starts[-1]))]
        if held:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            yield lists(whole, np.zeros(1, np.int64), whole.num_rows)

    dealt = rows.select("word", "block", "key", *(["n"] if counted else [])).repartition("word", "block")
    return dealt.sortWithinPartitions("word", "block", "key").mapInArrow(cut, f"word string, block long, {column} {kind}")


def posting_lists(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text",
                  block_size: int = DEFAULT_BLOCK_SIZE, sep: str = " ") -> DataFrame:
    """``(word, block, doc_ids)``: sorted, distinct ids of documents holding
    the word, one row per block of ids."""
    rows, names, few = _keyed(docs, doc_col, text_col)
    words = rows.where(F.col("text").isNotNull()).select(
        "key", F.explode(F.array_distinct(F.split("text", re.escape(sep), -1))).alias("word"))
    blocks = words.withColumn("block", block_of(F.col("key"), block_size))
    if _repeats(rows):
        lists = blocks.groupBy("word", "block").agg(F.sort_array(F.collect_set("key")).alias("doc_ids"))
    else:
        lists = _gathered(blocks, "doc_ids", "array<long>")
    if names is not None:
        return _named(lists, names, few, block_size, "doc_ids", lambda e, name: name(e))
    return lists.withColumn("doc_ids", F.col("doc_ids").cast(T.ArrayType(docs.schema[doc_col].dataType)))


def posting_lists_with_counts(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text",
                              block_size: int = DEFAULT_BLOCK_SIZE, sep: str = " ") -> DataFrame:
    """``(word, block, postings)`` with ``postings`` an array of
    ``struct(doc_id, n)`` sorted by document id.

    Rows of one id are summed before they are dealt to their list, in part in
    the map tasks.  Where no id repeats there is nothing to sum, and the row
    counts go to their lists at once; a look at the ids alone tells."""
    rows, names, few = _keyed(docs, doc_col, text_col)
    counts = row_term_counts(rows, "key", "text", sep).withColumnRenamed("doc_id", "key")
    if _repeats(rows):
        counts = counts.groupBy("word", "key").agg(F.sum("n").alias("n"))
    lists = _gathered(counts.select("word", "key", "n", block_of(F.col("key"), block_size).alias("block")), "postings",
                      "array<struct<doc_id:long,n:long>>")
    if names is not None:
        return _named(lists, names, few, block_size, "postings", lambda e, name: F.struct(
            name(e["doc_id"]).alias("doc_id"), e["n"].alias("n")))
    id_type = docs.schema[doc_col].dataType
    return lists.withColumn("postings", F.col("postings").cast(f"array<struct<doc_id:{id_type.simpleString()},n:bigint>>"))


def merge_posting_lists(a: F.Column, b: F.Column) -> F.Column:
    """Set union of two stored posting lists, kept sorted."""
    return F.sort_array(F.array_union(a, b))


def render_ids(ids: F.Column) -> F.Column:
    """``[0, 1, 2]`` -> ``'0,1,2'`` (stable text form of a posting list)."""
    return F.array_join(ids.cast("array<string>"), ",")


def render_postings(postings: F.Column) -> F.Column:
    """``[(0, 2), (1, 1)]`` -> ``'0:2,1:1'``."""
    ids, counts = postings["doc_id"].cast("array<string>"), postings["n"].cast("array<string>")
    return F.array_join(F.zip_with(ids, counts, lambda doc, n: F.concat(doc, F.lit(":"), n)), ",")
